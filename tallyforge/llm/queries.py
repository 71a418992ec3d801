"""The registered queries of the subpackage with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import (
    chat_format,
    decontaminate,
    hash_ring,
    importance,
    merkle,
    minmax_dedup,
    mixing,
    pii_crf,
    projected_nn,
    quality_vote,
    token_count,
    toxicity_pu,
    twins,
    url_automaton,
)
from tallyforge.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if twin:
            ORACLES[name] = twin
        return fn
    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_quality")
def quality(spark, sf):
    held_out = fold("doc_id", 4) == 2
    scored = quality_vote.vote_quality(table(spark, sf, "documents"), table(spark, sf, "labels").where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


URL_RULES = [
    url_automaton.Rule("block", "net", "/"), url_automaton.Rule("allow", "example.net", "/en/"),
    url_automaton.Rule("block", "example.com", "/de/"), url_automaton.Rule("allow", "org", "/fr/"),
    url_automaton.Rule("block", glob=".**casino-**"), url_automaton.Rule("block", glob=".*spam-*"),
    url_automaton.Rule("block", glob=".*spam-*/**"),
]


@query("op2_url_filter", r"""
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
ruled as (
  select *, case
    when ends_with('.' || host, '.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when ends_with('.' || host, '.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when ends_with('.' || host, '.org') and starts_with(path, '/fr/') then 'org/fr/'
    when ends_with('.' || host, '.net') and starts_with(path, '/') then 'net/' end as rule
  from parts)
select page_id, host, path, rule, case
    when rule in ('net/', 'example.com/de/') then 'block'
    when rule is not null then 'allow'
    when contains(host || path, 'casino-') or contains(host, 'spam-') then 'block'
    else 'allow' end as verdict
from ruled""")
def url_filter(spark, sf):
    return url_automaton.judge_urls(table(spark, sf, "pages"), URL_RULES)


@query("op3_personal_data")
def personal_data(spark, sf):
    return pii_crf.find_personal_data(table(spark, sf, "documents"), pii_crf.TAGGED)


@query("op4_token_count")
def token_lengths(spark, sf):
    import public_tokenizers

    return token_count.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_neighbours")
def neighbours(spark, sf):
    return projected_nn.nearest_neighbours(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op6_mixing")
def mixing_weights(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op7_toxicity")
def toxicity(spark, sf):
    held_out = fold("doc_id", 5) == 0
    confirmed, prior = toxicity_pu.confirmed_toxic(table(spark, sf, "labels"), held_out)
    scored = toxicity_pu.score_toxicity(table(spark, sf, "documents"), confirmed, prior, held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op8_sharding")
def sharding(spark, sf):
    return hash_ring.shard_documents(table(spark, sf, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_decontamination")
def decontamination(spark, sf):
    return decontaminate.find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op10_near_duplicates")
def near_duplicates(spark, sf):
    return minmax_dedup.near_duplicates(table(spark, sf, "documents"))


@query("op11_resampling", twins.RESAMPLING)
def resampling(spark, sf):
    return importance.importance_resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op12_chat_format", twins.FORMATTING)
def chat_formatting(spark, sf):
    import public_tokenizers

    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    staged = spark.range(2).select(F.lit(-1).cast("long"), "id", F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1),
                                   F.lit("</s>[INST] ok [/INST]"))
    return chat_format.read_back(chat_format.format_conversations(turns.union(staged), public_tokenizers.path("byte_bpe_50k.json")))


@query("op13_manifest", twins.MANIFEST)
def manifest(spark, sf):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    other = merkle.leaf_digest([F.translate(c, upper, lower) if c == "text" else F.col(c) for c in columns])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, other)
    made = merkle.merkle_manifest(table(spark, sf, "documents"), columns, extra={"tampered": tampered})
    folded = made.select("*", merkle.fold_path(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
