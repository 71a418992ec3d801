"""Near-duplicate groups by min-max hashing of word shingles, with every link confirmed on the full sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import LOWER, SpanHasher, as_rows, blocks, mix, packed, pick, stored, word_spans

#: Text that is shingled at once; hashing takes some twenty times as much memory.
SHINGLED_BYTES = 1 << 20
#: Sets of a bucket that are compared with as many others in one cell.
BLOCK_SETS = 256


@dataclass(frozen=True)
class Settings:
    """`bands` bands of `rows` signature values; two texts of similarity s share none with chance (1 - s^rows)^bands.

    With 44 bands of 5 values that is 7e-6 at 0.75. Half of the bands hold minima and half maxima, so 110 permutations serve
    220 values. `percent` is the least similarity; in each of `rounds` rounds a set is held against `tries` leaders at most.
    """

    words: int = 5
    percent: int = 75
    bands: int = 44
    rows: int = 5
    rounds: int = 2
    tries: int = 3
    seed: int = 17


class Shingler:
    """Distinct hashed shingles of every row of a block, sorted within the row."""

    def __init__(self, words: int) -> None:
        self.words, self.hasher = words, SpanHasher()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all rows end to end, and n + 1 bounds. A text with fewer words is one shingle; one without words has none."""
        n = len(offsets) - 1
        low = LOWER[data]
        starts, ends, owner = word_spans(low, offsets)
        word = self.hasher(low, starts, ends)
        per_row = np.bincount(owner, minlength=n)
        k = self.words
        width = len(word) - k + 1
        hashes, rows = [], []
        if width > 0:
            total = np.zeros(width, np.uint64)
            for j in range(k):
                total = total * np.uint64(0x9E3779B97F4A7C15) + word[j:j + width]
            whole = owner[:width] == owner[k - 1:]
            hashes.append(mix(total[whole]))
            rows.append(owner[:width][whole])
        short = np.flatnonzero((per_row > 0) & (per_row < k))
        if len(short):
            first = np.cumsum(per_row) - per_row
            total = per_row[short].astype(np.uint64)
            for j in range(k - 1):
                has = per_row[short] > j
                total[has] = total[has] * np.uint64(0x9E3779B97F4A7C15) + word[first[short[has]] + j]
            hashes.append(mix(total + np.uint64(1)))
            rows.append(short)
        if not hashes:
            return np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
        hashes, rows = np.concatenate(hashes), np.concatenate(rows)
        order = np.lexsort((hashes, rows))
        hashes, rows = hashes[order], rows[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        hashes, rows = hashes[fresh], rows[fresh]
        return hashes, np.searchsorted(rows, np.arange(n + 1))


def set_digests(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, the same for equal sets; 0 for empty ones."""
    out = []
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ np.uint64(salt)), out=total[1:])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def band_keys(hashes: np.ndarray, bounds: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sets x bands: one key per band from the minima, or the maxima, of `rows` permutations; and a bit of every such value, packed.

    No set may be empty.
    """
    rng = np.random.default_rng(s.seed)
    keys = np.zeros((len(bounds) - 1, s.bands), np.uint64)
    bits = np.zeros((len(bounds) - 1, -(-s.bands * s.rows // 64) * 64), bool)
    starts, place = bounds[:-1], 0
    for pair in range(0, s.bands, 2):
        for _ in range(s.rows):
            factor = np.uint64(int(rng.integers(1 << 62)) * 2 + 1)
            turned = (hashes ^ np.uint64(int(rng.integers(1 << 62)))) * factor
            for band, extreme in ((pair, np.minimum), (pair + 1, np.maximum)):
                if band < s.bands:
                    value = extreme.reduceat(turned, starts)
                    keys[:, band] = mix(keys[:, band] * np.uint64(0x9E3779B97F4A7C15) + value)
                    bits[:, place] = value >> np.uint64(32) & np.uint64(1)
                    place += 1
    return mix(keys + np.arange(s.bands, dtype=np.uint64)).view(np.int64), np.packbits(bits, axis=1).view(np.int64)


def plausible(left: Column, right: Column, s: Settings) -> Column:
    """Whether the packed bits of two sets differ in no more places than sets of the least similarity do, by seven deviations.

    Values of two sets agree with the chance of their similarity, and bits of other values in half of the cases. A pair of the least
    similarity fails this with a chance of about 1e-8, far below that of sharing no band.
    """
    values, miss = s.bands * s.rows, (1 - s.percent / 100) / 2
    most = values * miss + 7 * (values * miss * (1 - miss)) ** 0.5
    differ = F.lit(0)
    for i in range(-(-values // 64)):
        differ = differ + F.bit_count(left[i].bitwiseXOR(right[i]))
    return differ <= int(most)


def signatures(docs: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """Per document: id, a digest of its text, n_shingles, the two digests of its set, its band keys and bits (none for empty sets)."""

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(s.words)
        for whole in batches:
            for batch in blocks(whole, text, SHINGLED_BYTES):
                hashes, bounds = shingle(*packed(batch.column(text)))
                size = np.diff(bounds)
                filled = np.flatnonzero(size)
                h1, h2 = set_digests(hashes, bounds)
                found = band_keys(hashes, np.append(bounds[filled], len(hashes)), s) if len(filled) else (np.empty((0, 1), np.int64),) * 2
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum((size > 0) * values.shape[1])).astype(np.int32)),
                                                  pa.array(values.ravel())) for values in found]
                yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("digest"), pa.array(size), pa.array(h1), pa.array(h2), *lists],
                                                 names=["id", "digest", "n_shingles", "h1", "h2", "bands", "bits"])

    rows = pick(docs, key, text).select(key, text, F.xxhash64(text).alias("digest"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(signed, f"id {kind}, digest long, n_shingles long, h1 long, h2 long, bands array<long>, bits array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, s: Settings) -> DataFrame:
    """nid and sorted shingle hashes of the sets in `wanted` (nid, rep, h1, h2), recomputed from the texts of their documents."""

    def shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(s.words)
        for whole in batches:
            for batch in blocks(whole, text, SHINGLED_BYTES):
                hashes, bounds = shingle(*packed(batch.column(text)))
                h1, h2 = set_digests(hashes, bounds)
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), sets], names=["h1", "h2", "items"])

    holders = wanted.select(F.col("rep").alias("holder")).distinct()
    texts = pick(docs, key, text).join(holders, F.col(key).eqNullSafe(F.col("holder")), "left_semi")
    sets = texts.mapInArrow(shingled, "h1 long, h2 long, items array<long>")
    return wanted.select("nid", "h1", "h2").join(sets, ["h1", "h2"]).groupBy("nid").agg(F.first("items").alias("items"))


def components(links: DataFrame) -> DataFrame:
    """Per node of `links` (a, b) the smallest node it is connected to: id, component.

    Labels travel along links and then jump to the label of their label, so long chains shorten by halves.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("component"))
    labels = stored(labels, "labels")
    while True:
        offers = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("offer"))
        moved = labels.join(offers, "id").select("id", F.least("component", "offer").alias("component"), F.col("component").alias("before"))
        heads = moved.select(F.col("id").alias("component"), F.col("component").alias("head"))
        jumped = stored(moved.join(heads, "component").select("id", F.least("component", "head").alias("component"), "before"), "labels")
        labels = jumped.select("id", "component")
        if jumped.where(F.col("component") != F.col("before")).isEmpty():
            return labels


def similar_sizes(left: Column, right: Column, percent: int) -> Column:
    """Sets whose sizes differ too much cannot reach the similarity."""
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; no others leave the join."""
    left = sets.select(F.col("nid").alias("left"), F.col("items").alias("x"))
    right = sets.select(F.col("nid").alias("right"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    alike = both * 100 >= (F.size("x") + F.size("y") - both) * percent
    return pairs.join(left, F.col("a") == F.col("left")).join(right, (F.col("b") == F.col("right")) & alike).select("a", "b")


def merged(grouping: DataFrame | None, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """nid and component after links (a, b) between sets; `grouping` is what was known before, None if every set stood alone."""
    if grouping is None:
        grouping = nodes.select("nid", F.col("nid").alias("component"))
    else:
        side = grouping.select(F.col("nid").alias("a"), F.col("component").alias("ca"))
        other = grouping.select(F.col("nid").alias("b"), F.col("component").alias("cb"))
        links = links.join(side, "a").join(other, "b").where("ca != cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    renamed = components(links).select(F.col("id").alias("component"), F.col("component").alias("under"))
    return stored(grouping.join(renamed, "component", "left").select("nid", F.coalesce("under", "component").alias("component")),
                  "components")


def ordered_pair(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def open_links(entries: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) within buckets that join different components; of those from one set to one component a bucket gives one.

    `entries` has bucket, nid, n, component. Sets outside a bucket's most frequent component are held against all of the bucket, from
    the smaller number if both are such sets. Large buckets are cut into blocks on either side, so that a cell of two blocks
    holds a bounded number of sets, whatever the size of the bucket; only confirmed links become rows.
    """
    tally = entries.groupBy("bucket", "component").agg(F.count("*").alias("times"))
    mixed = tally.groupBy("bucket").agg(F.max_by("component", "times").alias("main"), F.sum("times").alias("all"),
                                        F.max("times").alias("most"), F.count("*").alias("kinds")).where("kinds > 1")

    def cut(count: Column) -> Column:
        return F.ceil(count / BLOCK_SETS).cast("int")

    def listed(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    marked = entries.join(mixed.select("bucket", "main", cut(F.col("all")).alias("wide"), cut(F.col("all") - F.col("most")).alias("high")), "bucket").select(
        "bucket", "nid", "n", "component", (F.col("component") != F.col("main")).alias("minor"), "wide", "high", F.xxhash64("nid").alias("deal"))
    row, column = F.pmod("deal", "high").cast("int"), F.pmod("deal", "wide").cast("int")
    asking = marked.where("minor").select("*", row.alias("row"), F.lit(True).alias("asks")).withColumn("column", listed(F.col("wide")))
    asked = marked.select("*", column.alias("column"), F.lit(False).alias("asks")).withColumn("row", listed(F.col("high")))
    cells = asking.unionByName(asked).select(F.xxhash64("bucket", "row", "column").alias("cell"), "asks", "nid", "n", "component", "minor")
    met = cells.join(sets, "nid").repartition("cell").sortWithinPartitions("cell")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if rest is None else pa.concat_tables([rest, rows])).combine_chunks()
            cell = rows.column("cell").to_numpy()
            edges = np.append(np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)) if len(cell) else [], len(cell)).astype(np.int64)
            for a, b in zip(edges[:-2], edges[1:-1]):
                yield from cell_links(rows.slice(a, b - a), s.percent)
            rest = rows.slice(edges[-2]) if len(edges) > 1 else None
        if rest is not None:
            yield from cell_links(rest, s.percent)

    return met.mapInArrow(compared, "a long, b long").distinct()


def cell_links(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Confirmed links between the asking and the asked sets of a cell, by marking one asking set at a time in the cell's shingles."""
    nid, n, component = (rows.column(c).to_numpy() for c in ("nid", "n", "component"))
    asks, minor = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "minor"))
    ask, be = np.flatnonzero(asks), np.flatnonzero(~asks)
    if not len(ask) or not len(be):
        return
    items = rows.column("items").combine_chunks()
    shingle = np.unique(np.asarray(items.flatten()), return_inverse=True)[1]
    ends = np.cumsum(n)
    starts = ends - n
    own = np.concatenate([shingle[starts[q]:ends[q]] for q in be])
    first = np.cumsum(n[be]) - n[be]
    mark = np.zeros(len(shingle), bool)
    for p in ask:
        fit = (component[be] != component[p]) & (~minor[be] | (nid[p] < nid[be])) & (
            np.minimum(n[be], n[p]) * 100 >= np.maximum(n[be], n[p]) * percent)
        if not fit.any():
            continue
        mark[shingle[starts[p]:ends[p]]] = True
        both = np.add.reduceat(mark[own], first, dtype=np.int64)
        mark[shingle[starts[p]:ends[p]]] = False
        good = np.flatnonzero(fit & (both * 100 >= (n[be] + n[p] - both) * percent))
        good = good[np.unique(component[be[good]], return_index=True)[1]]
        if len(good):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(good), nid[p])), pa.array(nid[be[good]])], names=["a", "b"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: key, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words at space and 9 to 13. A document's set holds its distinct five-word shingles, a
    shorter text is one shingle, and a text without words (null ones too) has an empty set and no links. Documents with equal sets
    are one class; classes are linked if their sets reach the similarity. component_id is the smallest key that links reach,
    kept tells whether that is the document's own. Repeated rows are equal and share their fate; a component without any key has
    a null component_id. An empty table gives no rows.

    Classes that share a band key meet in a bucket. Each bucket has one leader a round, drawn alike in all buckets, and a class is
    held against few leaders a round, so a crowd of near copies takes a few comparisons per member; links are contracted between
    rounds. Where a larger bucket still holds several components, the sets outside its main one are held against all of it. No pair
    is left out for the size of its bucket, and only confirmed links become rows.
    """
    found = grouped(docs, key, text, settings)
    return found.select(F.col("id").alias(key), "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, key: str, text: str, settings: Settings) -> DataFrame:
    """Per document: id, digest (of its text), n_shingles, component_id, kept."""
    s = settings
    signed = stored(signatures(docs, key, text, s), "signatures")
    classes = signed.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    classes = stored(classes.withColumn("nid", F.monotonically_increasing_id()), "classes")
    entries = classes.select("nid", "n", "bits", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    buckets = stored(entries.join(shared, "bucket"), "buckets")
    nodes = stored(buckets.select("nid").distinct(), "nodes")
    sets = stored(full_sets(docs, classes.join(nodes, "nid", "left_semi"), key, text, s), "sets")
    grouping = link_buckets(buckets, nodes, sets, s)

    labelled = classes.select("h1", "h2", "nid", "rep").join(grouping, "nid", "left").withColumn(
        "component", F.coalesce("component", "nid"))
    smallest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = stored(labelled.join(smallest, "component").select("h1", "h2", "component_id"), "class-components")
    rows = signed.select("id", "digest", "n_shingles", "h1", "h2")
    with_set = rows.where("n_shingles > 0").join(found, ["h1", "h2"]).select("id", "digest", "n_shingles", "component_id")
    without = rows.where("n_shingles = 0").select("id", "digest", "n_shingles", F.col("id").alias("component_id"))
    return with_set.union(without).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def link_buckets(buckets: DataFrame, nodes: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """nid and component of all sets in buckets (bucket, nid, n, bits, members).

    Buckets of two are tested outright. In each round every set has a fresh draw, the lowest draw of a bucket leads it, and a set
    is tested against a few leaders, those of most of its buckets first, that it is not connected to or was not tested against. The
    draws are the same in all buckets, so a crowd agrees on few leaders, and the pairs of a round are a small multiple of the sets.
    Links are contracted between rounds. What larger buckets then still keep apart is compared inside a join.
    """
    two = buckets.where("members = 2").groupBy("bucket").agg(
        F.min("nid").alias("p"), F.max("nid").alias("q"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.min_by("bits", "nid").alias("p_bits"), F.max_by("bits", "nid").alias("q_bits"))
    pairs = ordered_pair(two.where(similar_sizes(F.col("least"), F.col("most"), s.percent) & plausible(F.col("p_bits"), F.col("q_bits"), s)))
    crowded = buckets.where("members > 2")
    grouping, tested = nodes.select("nid", F.col("nid").alias("component")), None
    for turn in range(s.rounds):
        entries = crowded.join(grouping, "nid")
        draw = F.xxhash64(F.lit(s.seed + turn), "nid")
        leads = entries.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min(F.struct(draw.alias("draw"), F.col("nid").alias("lead"), F.col("n").alias("lead_n"), F.col("component").alias("of"),
                           F.col("bits").alias("bits"))).alias("head"))
        met = entries.join(leads.where("low < high").select("bucket", "head"), "bucket").where(
            (F.col("component") != F.col("head.of")) & similar_sizes(F.col("n"), F.col("head.lead_n"), s.percent)
            & plausible(F.col("bits"), F.col("head.bits"), s))
        met = met.groupBy("nid", F.col("head.lead").alias("lead")).agg(F.count(F.lit(1)).alias("times"), F.min("head.draw").alias("draw"))
        if tested is not None:
            known = tested.select(F.col("a").alias("nid"), F.col("b").alias("lead")).union(tested.select("b", "a"))
            met = met.join(known, ["nid", "lead"], "left_anti")
        # The leaders of most of a set's buckets are the likeliest to be similar.
        likeliest = Window.partitionBy("nid").orderBy(F.desc("times"), "draw", "lead")
        chosen = met.withColumn("nth", F.row_number().over(likeliest)).where(F.col("nth") <= s.tries).select(
            F.col("nid").alias("p"), F.col("lead").alias("q"))
        pairs = stored(ordered_pair(chosen if turn else chosen.union(pairs.select(F.col("a"), F.col("b")))), "pairs")
        if pairs.isEmpty():
            break
        links = stored(confirmed(pairs, sets, s.percent), "confirmed")
        tested = pairs if tested is None else tested.union(pairs)
        if not links.isEmpty():
            grouping = merged(grouping if turn else None, nodes, links)
    rest = crowded.join(grouping, "nid").select("bucket", "nid", "n", "component")
    links = stored(open_links(rest, sets, s), "confirmed")
    return grouping if links.isEmpty() else merged(grouping, nodes, links)


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents that stay, one per component, with all their columns; of repeated rows one stays."""
    kept = grouped(docs, key, text, settings).where("kept").select(F.col("id").alias("stays"), F.col("digest").alias("of")).distinct()
    whole = as_rows(docs, key, text).select(F.col(key).alias("id"), F.xxhash64(text).alias("digest"), "row")
    left = whole.join(kept, F.col("id").eqNullSafe(F.col("stays")) & (F.col("digest") == F.col("of")), "left_semi")
    return left.dropDuplicates(["id", "digest"]).select("row.*").toDF(*docs.columns)
