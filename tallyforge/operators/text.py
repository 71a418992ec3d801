"""Descriptors of text columns and the drift between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import quoted, ratio

# Patterns of words and links.
WORD_BREAK = r"\s+"
LINK = r"https?://|www\."


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def is_json(text: Column) -> Column:
    """The whole text is one JSON value; Spark's parser alone stops after the first one.

    Inside an array the text must be followed by a closing marker as second and last element.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"~end"]')))
    second = F.try_variant_get(wrapped, "$[1]", "string") == "~end"
    return F.when(text.isNotNull(), F.coalesce(second & F.try_variant_get(wrapped, "$[2]", "variant").isNull(), F.lit(False)))


def text_profile(df: DataFrame, column: str, key: Sequence[str], pattern: str | None = None,
                 exact: str | None = None) -> DataFrame:
    """Length, words, share of characters that are neither letters nor spaces, link, pattern, equality and JSON."""
    text = F.col(quoted(column))
    size = F.length(text)
    cols = [size.alias("text_length"), F.size(words(text)).alias("word_count"),
            (ratio(F.length(F.regexp_replace(text, r"[\p{L} ]", "")), size) * 100).alias("non_letter_percent"),
            text.rlike(LINK).alias("has_link"), is_json(text).alias("is_json")]
    if pattern is not None:
        cols.append(text.rlike(f"^(?:{pattern})").alias("matches"))
    if exact is not None:
        cols.append((text == exact).alias("is_exact"))
    return df.select(*key, *cols)


def out_of_vocabulary(df: DataFrame, column: str, key: str, vocabulary: DataFrame) -> DataFrame:
    """Percent of each text's words that the vocabulary (one column `word`) does not hold.

    The join is left to Spark: a vocabulary of measured small size is broadcast, and then only one
    pair of counts per text is shuffled; a large one meets the words by shuffle, hot ones split by
    the skew join.
    """
    said = df.select(key, F.explode(words(F.lower(F.col(quoted(column))))).alias("word"))
    known = vocabulary.select(F.col("word"), F.lit(True).alias("known")).distinct()
    missing = F.count_if(F.col("known").isNull())
    per = (said.join(known, "word", "left").groupBy(key)
           .agg((ratio(missing, F.count(F.lit(1))) * 100).alias("oov_percent")))
    return df.select(key).join(per, key, "left")


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays, computed in double."""
    def total(x):
        return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)

    def dot(x, y):
        return total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))
