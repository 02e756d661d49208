"""MinHash near-duplicates: banded candidates, sequential Bayesian verification, exact check of the survivors.

1. A document is the set of its distinct 5-word shingles (64-bit hashes). Documents with one and the same set are a
   class; the class works on under its least document id, its members join again at the end.
2. A class has a signature of ``bands * rows`` minima. Classes that agree in all rows of a band are candidates.
   Each bucket links its members to one of them, the one of smallest hash, and components are taken; then every pair
   of a bucket whose ends lie in different components is compared as well, so no link between components is lost,
   and a bucket of n near copies costs n comparisons, not n * n. Before that, the members of such buckets are dealt
   anew by the rarest of the shingles in which they differ from one text of the family (a prefix filter, which is
   exact): texts that are alike, but not alike enough, mostly part there.
3. A candidate pair's signatures are compared in batches. After each batch the pair is dropped if the posterior
   probability that its similarity reaches the threshold, given the matches so far and a uniform prior, is under
   ``miss``. The least number of matches that survives is a table by batch, computed once.
4. Survivors are checked on the full shingle sets.

A link at the threshold escapes all bands with probability (1 - t**rows)**bands, 8e-6 at the defaults.
Null texts and texts without words have no shingles and link with nothing. Rows are numbered and compared as rows, so
repeated and null ids take part like others: a component's id is the least one in it, null where it has no other, and
rows that share the least id of their component are all marked as kept. ``drop_near_duplicates`` keeps one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.llm.graph import bucket_components, components
from dialoom.llm.storage import Scratch, free_name
from dialoom.llm.tokens import small_batches

SHINGLE, PERCENT, BANDS, ROWS, BATCH, MISS = 5, 85, 20, 5, 20, 1e-6
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each lower-cased word."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence if it is shorter."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    size = min(SHINGLE, n)
    acc = np.full(n - size + 1, n if n < SHINGLE else SHINGLE, np.uint64)
    for k in range(size):
        acc = mixed(acc * np.uint64(0x9E3779B97F4A7C15) + words[k : n - size + 1 + k])
    return np.unique(acc)


def hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    made = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return made[:count] | np.uint64(1), made[count:]


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least high half of a multiply-shift hash, for each of the family."""
    a, b = family
    out = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 512):
        low = (shingles[at : at + 512, None] * a + b).min(axis=0) >> np.uint64(32)
        out = np.minimum(out, low)
    return out.astype("<u4")


def tail(matches: int, n: int, threshold: float) -> float:
    """P(similarity >= threshold | matches of n, uniform prior): an incomplete beta function of whole parameters."""
    a, total = matches + 1, n + 1
    return sum(math.comb(total, j) * threshold**j * (1 - threshold) ** (total - j) for j in range(a))


def least_matches(count: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(compared, least matches that go on) after each batch."""
    out = []
    for n in range(batch, count + 1, batch):
        out.append((n, next((m for m in range(n + 1) if tail(m, n, threshold) >= miss), n + 1)))
    return out


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: int = BANDS * ROWS) -> DataFrame:
    """Per document: its id, number of shingles, set hash (null without shingles) and signature."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family(count)
        for batch in small_batches(batches):
            n, keys, signs = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                keys.append(f"{len(s):x}-{int(np.bitwise_xor.reduce(mixed(s))):016x}{int(np.add.reduce(mixed(s ^ _M2))):016x}" if len(s) else None)
                signs.append(signature(s, family).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(signs, pa.binary())], [id_col, "n_shingles", "set_key", "signature"])

    return docs.select(id_col, text_col).mapInArrow(sketch, f"`{id_col}` {kind}, n_shingles long, set_key string, signature binary")


def _bands(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, node) for each band of each class."""
    width = 4 * rows
    cuts = F.array(*(F.xxhash64(F.lit(b), F.substring("signature", b * width + 1, width)) for b in range(bands)))
    return classes.select("node", F.explode(cuts).alias("bucket"))


def _compare(pairs: DataFrame, classes: DataFrame, table: list[tuple[int, int]]) -> DataFrame:
    """Sequential verification of (a, b) by signatures."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([v.as_py() for v in batch.column(i)] for i in (2, 3))
            if not left:
                continue
            same = np.frombuffer(b"".join(left), "<u4").reshape(len(left), -1) == np.frombuffer(b"".join(right), "<u4").reshape(len(left), -1)
            live, matches, before = np.arange(len(left)), np.zeros(len(left), np.int64), 0
            for n, least in table:
                matches[live] += np.count_nonzero(same[live, before:n], axis=1)
                live, before = live[matches[live] >= least], n
            yield batch.take(pa.array(live)).select([0, 1])

    ends = classes.select("node", "signature")
    x = pairs.join(ends.withColumnsRenamed({"node": "b", "signature": "sb"}), "b")
    x = x.join(ends.withColumnsRenamed({"node": "a", "signature": "sa"}), "a").select("a", "b", "sa", "sb")
    return x.mapInArrow(compare, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), "<u8") for c in (2, 3))
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64())).select([0, 1])

    x = pairs.join(sets.withColumnsRenamed({"node": "b", "shingles": "sb"}), "b")
    x = x.join(sets.withColumnsRenamed({"node": "a", "shingles": "sa"}), "a").select("a", "b", "sa", "sb")
    return x.mapInArrow(verify, "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The shingle sets of the documents that are nodes: sets are made again only for documents in a candidate pair."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            made = [shingle_set(t).astype("<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "shingles"])

    wanted = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).join(nodes, "node", "left_semi")
    return wanted.mapInArrow(make, "node long, shingles binary").where("length(shingles) > 0").dropDuplicates(["node"])


def _difference_buckets(docs: DataFrame, torn: DataFrame, percent: int, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """(bucket, node) for the members of torn buckets (hub, node): every pair of a torn bucket that can be a link meets.

    Nodes joined by torn buckets are a cluster, with one reference text R. With D(x) the symmetric difference of x and R,
    that of x and y is D(x) less D(y) and the reverse, so x and y are a link just if D(x) and D(y) share
    ``(e(x) + e(y)) / 2`` elements, where ``e(x) = |D(x)| - c * |x|`` and ``c = (100 - percent) / (100 + percent)``. So
    a node lies under the rarest elements of D(x), as many as it can have besides that number, plus one, for each class
    of e (steps of a quarter) that is in its cluster; where the number is not above 0, under one bucket for all. Texts of
    one family that are alike but not alike enough share most of their shingles, but not what they lack or add.
    """
    c, grow = (100 - percent) / (100 + percent), 1.25

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, base = (np.frombuffer(batch.column(k)[i].as_buffer(), "<i8") for k in (2, 3))
                diff = np.setxor1d(own, base)
                n = len(diff) + 1
                columns = [pa.array(np.full(n, batch.column(k)[i].as_py(), np.int64)) for k in (0, 1)]
                element = pa.concat_arrays([pa.array(diff, pa.int64()), pa.nulls(1, pa.int64())])
                yield pa.RecordBatch.from_arrays([*columns, element, pa.array(np.full(n, len(diff), np.int64)), pa.array(np.full(n, len(diff) - c * len(own))), pa.array(np.full(n, c * len(base) + 1))], ["cluster", "node", "element", "d", "e", "low"])

    edges = scratch.save(torn.select("hub", "node").distinct(), "torn-edges")
    # a node goes with its least hub, which is joined with its other hubs: the graph is one of hubs alone
    least = scratch.save(edges.groupBy("node").agg(F.min("hub").alias("a")), "least-hubs")
    found = components(edges.join(least, "node").where("a <> hub").select("a", F.col("hub").alias("b")).distinct(), scratch)
    clusters = least.join(found.withColumnRenamed("node", "a"), "a", "left").select("node", F.coalesce("component", "a").alias("cluster"))
    votes = edges.join(clusters, "node").groupBy("cluster", F.col("hub").alias("a")).agg(F.count("*").alias("n"))
    refs = votes.groupBy("cluster").agg(F.max(F.struct("n", "a")).alias("m")).select("cluster", F.col("m.a").alias("ref"))
    members = scratch.save(clusters.join(refs, "cluster"), "members")
    sets = scratch.save(_sets(docs, members.select("node"), id_col, text_col).select("node", "shingles"), "torn-sets")
    x = members.join(sets, "node").join(sets.withColumnsRenamed({"node": "ref", "shingles": "base"}), "ref").select("cluster", "node", "shingles", "base")
    differences = scratch.save(x.mapInArrow(spread, "cluster long, node long, element long, d long, e double, low double"), "differences")
    scratch.drop(edges, least, members, sets)
    held = differences.withColumn("own", F.floor(F.log(F.col("e") + F.col("low") + 1e-9) / math.log(grow)).cast("int"))
    whole = held.where("element is null")
    # classes of e: a logarithm of the longest text's size at most
    present = scratch.save(whole.groupBy("cluster").agg(F.collect_set("own").alias("others")), "present")
    counts = scratch.save(held.where("element is not null").groupBy("cluster", "element").agg(F.count("*").alias("n")).where("n > 1"), "element-counts")
    node = W.partitionBy("cluster", "node")
    ranked = held.join(counts, ["cluster", "element"])
    ranked = ranked.withColumn("at", F.row_number().over(node.orderBy("n", "element")) + F.col("d") - F.count("*").over(node))
    most = F.col("e") + F.pow(F.lit(grow), F.col("other")) - F.col("low") - 1e-6
    pair = [F.least("own", "other"), F.greatest("own", "other")]
    ranked = ranked.join(present, "cluster").withColumn("other", F.explode("others")).where(F.col("at") <= F.col("d") - F.ceil(most / 2) + 1)
    whole = whole.join(present, "cluster").withColumn("other", F.explode("others")).where(most <= 0)
    out = ranked.select(F.xxhash64("cluster", "element", *pair).alias("bucket"), "node")
    out = scratch.save(out.unionByName(whole.select(F.xxhash64(F.lit("all"), "cluster", *pair).alias("bucket"), "node")).distinct(), "refined")
    scratch.drop(differences, present, counts)
    return out


def row_components(rows: DataFrame, rid: str, scratch: Scratch, percent: int = PERCENT, bands: int = BANDS, rows_per_band: int = ROWS, batch: int = BATCH, miss: float = MISS, text_col: str = "text") -> DataFrame:
    """(rid, n_shingles, component): ``rid`` is a long that numbers the rows, a component goes by the least of its own."""
    sketched = scratch.save(sketches(rows, rid, text_col, bands * rows_per_band), "sketches")
    classes = sketched.where("set_key is not null").groupBy("set_key").agg(F.min(rid).alias("node"), F.first("signature").alias("signature"))
    classes = scratch.save(classes, "classes")
    # signatures are kept once, with the classes
    sized = scratch.save(sketched.drop("signature"), "sized")
    scratch.drop(sketched)
    table = least_matches(bands * rows_per_band, batch, percent / 100, miss)

    links = lambda pairs: _linked(rows, pairs, classes, table, percent, scratch, rid, text_col)
    parted = lambda torn: _difference_buckets(rows, torn, percent, scratch, rid, text_col)
    found = bucket_components(_bands(classes, bands, rows_per_band), links, scratch, parted)
    by_class = classes.select("set_key", "node").join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    by_class = scratch.save(by_class, "components")
    out = sized.join(by_class, "set_key", "left")
    return out.select(F.col(rid).alias("rid"), "n_shingles", F.coalesce("component", rid).alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document row: id, n_shingles, component_id (the least id of the component) and kept (it is the row's own)."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rows = scratch.save(docs.select(F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text")), "rows")
    found = row_components(rows, "__row", scratch, text_col="__text", **options)
    named = scratch.save(rows.select("__row", "__id").join(found, F.col("__row") == F.col("rid")).drop("rid"), "named")
    least = named.groupBy("component").agg(F.min("__id").alias("component_id"))
    return named.join(least, "component").select(F.col("__id").alias(id_col), "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("__id")).alias("kept"))


def _linked(docs: DataFrame, pairs: DataFrame, classes: DataFrame, table: list[tuple[int, int]], percent: int, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    alive = scratch.save(_compare(pairs, classes, table), "alive")
    nodes = scratch.save(alive.select(F.col("a").alias("node")).union(alive.select("b")).distinct(), "nodes")
    sets = scratch.save(_sets(docs, nodes, id_col, text_col), "sets")
    links = scratch.save(_verify(alive, sets, percent), "links")
    scratch.drop(alive, nodes, sets)
    return links


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with their own columns, less all but one row of each component: that of the least id, null last."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    rid = free_name(docs, "__row")
    rows = scratch.save(docs.withColumn(rid, F.monotonically_increasing_id()), "rows")
    found = row_components(rows, rid, scratch, text_col=text_col, **options)
    named = scratch.save(rows.select(rid, F.col(id_col).alias("id")).join(found, F.col(rid) == F.col("rid")).select("rid", "id", "component"), "named")
    stays = named.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("least")).select(F.col("least.rid").alias("__stays"))
    return rows.join(stays, F.col(rid) == F.col("__stays"), "left_semi").drop(rid)


def op9_near_dedup(docs: DataFrame) -> DataFrame:
    """The contract's row per document, straight from ``near_duplicates``."""
    return near_duplicates(docs.select("doc_id", "text"))
