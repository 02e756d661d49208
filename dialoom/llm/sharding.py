"""K-d tree partitioning into shards of near-equal bytes, by DataFrame functions alone.

Each document is a point in metadata space (here: text size, document id, a hash of its source). The tree is built
from the root: a node that must hold k shards is split where its weight divides as floor(k/2) : k - floor(k/2),
along the dimension in which its points spread widest; a node of one shard is a leaf. Asking for a number of shards
sets the target bytes of a leaf to the total divided by it.

A split is a distributed weighted median: every open node's weights are summed in at most ``cells`` cells of its
dimension, in one job for all nodes; the driver picks the cell that holds the target and the next job looks inside
it, until a cell weighs less than ``tolerance`` of a leaf or holds one key. Coordinates are 31 bits wide and end in
31 bits of a row hash, so that ties (one size, source or copy that holds many rows) divide at the median too.

Only metadata is shuffled and kept, never text. The driver gets a bounded number of sums: nodes times cells.
Null texts weigh the fixed ``overhead`` alone. Repeated rows are placed each on its own. An empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dialoom.llm.storage import Scratch

BITS = 31
TOP = 1 << (2 * BITS)


class Node:
    """A split of the tree: the shards ``first`` .. ``first + count - 1`` are below it."""

    def __init__(self, first: int, count: int) -> None:
        self.first, self.count = first, count
        self.left: Node | None = None
        self.right: Node | None = None
        self.dim: str | None = None
        self.cut = 0

    def leaves(self) -> list[Node]:
        return [self] if self.left is None or self.right is None else self.left.leaves() + self.right.leaves()

    def column(self) -> Column:
        """The first shard of the leaf that a row falls in."""
        if self.left is None or self.right is None:
            return F.lit(self.first)
        return F.when(F.col(self.dim) < self.cut, self.left.column()).otherwise(self.right.column())


def _scaled(points: DataFrame, dims: list[str]) -> DataFrame:
    """Dimensions as long keys: 31 bits of the value between its least and greatest, then 31 bits of row hash."""
    ends = points.agg(*(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))).first()
    out = {}
    for i, d in enumerate(dims):
        lo, hi = float(ends[f"lo_{d}"] or 0), float(ends[f"hi_{d}"] or 0)
        share = (F.coalesce(F.col(d).cast("double"), F.lit(lo)) - lo) / ((hi - lo) or 1.0)
        value = F.least((share * (1 << BITS)).cast("long"), F.lit((1 << BITS) - 1))
        out[f"__{d}"] = F.shiftleft(value, BITS) + F.pmod(F.xxhash64("__tie", F.lit(i)), F.lit(1 << BITS))
    return points.withColumns(out)


def _split(points: DataFrame, nodes: list[Node], leaf: Column, dims: list[str], size: str, cells: int, tolerance: float) -> None:
    """Cut each of the nodes, all in the same jobs."""
    keys = [f"__{d}" for d in dims]
    stats = points.groupBy(leaf.alias("leaf")).agg(F.sum(size).alias("w"), *(f(k).alias(f"{n}{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max)))).collect()
    by = {r.leaf: r for r in stats}
    search = {}
    for node in nodes:
        r = by.get(node.first)
        if r is None:
            node.dim, node.cut = keys[0], 0
            continue
        node.dim = max(keys, key=lambda k: r[f"hi{k}"] - r[f"lo{k}"])
        search[node.first] = {"node": node, "lo": r[f"lo{node.dim}"], "hi": r[f"hi{node.dim}"] + 1, "goal": r.w * (node.count // 2) / node.count, "near": tolerance * r.w / node.count}
    while search:
        picked = F.lit(None).cast("int")
        for first, s in search.items():
            step = max(1, -(-(s["hi"] - s["lo"]) // cells))
            s["step"] = step
            key = F.col(s["node"].dim)
            inside = (leaf == first) & (key >= s["lo"]) & (key < s["hi"])
            picked = F.when(inside, F.expr(f"cast((`{s['node'].dim}` - {s['lo']}L) div {step}L as int)")).otherwise(picked)
        sums: dict[int, dict[int, int]] = {}
        for r in points.select(leaf.alias("leaf"), picked.alias("cell"), F.col(size).alias("w")).where("cell is not null").groupBy("leaf", "cell").agg(F.sum("w").alias("w")).collect():
            sums.setdefault(r.leaf, {})[r.cell] = r.w
        for first, s in list(search.items()):
            rest, at, weight = s["goal"], None, 0
            for cell, weight in sorted(sums.get(first, {}).items()):
                at = cell
                if weight >= rest:
                    break
                rest -= weight
            lo = s["lo"] + (at or 0) * s["step"]
            if s["step"] == 1 or weight <= s["near"] or at is None:
                s["node"].cut = lo + s["step"] if 2 * rest >= weight else lo
                del search[first]
            else:
                s["lo"], s["hi"], s["goal"] = lo, min(lo + s["step"], s["hi"]), rest


def build_tree(points: DataFrame, shards: int, dims: list[str], size: str = "size", cells: int = 4096, tolerance: float = 0.002) -> Node:
    root = Node(0, shards)
    while nodes := [n for n in root.leaves() if n.count > 1]:
        _split(points, nodes, root.column(), dims, size, cells, tolerance)
        for n in nodes:
            n.left, n.right = Node(n.first, n.count // 2), Node(n.first + n.count // 2, n.count - n.count // 2)
    return root


def with_slots(rows: DataFrame, shard: str, order: list[str], rows_per_chunk: int = 20_000) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard. A shard is numbered in chunks, so no task holds a whole shard."""
    chunks = max(1, -(-rows.count() // rows_per_chunk))
    rows = rows.withColumn("__chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counts = rows.groupBy(shard, "__chunk").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(W.partitionBy(shard).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    numbered = rows.withColumn("slot", F.row_number().over(W.partitionBy(shard, "__chunk").orderBy(*order)) - 1)
    return numbered.join(before, [shard, "__chunk"]).withColumn("slot", (F.col("slot") + F.col("__before")).cast("long")).drop("__chunk", "__before")


def shard_documents(docs: DataFrame, shards: int, dims: dict[str, Column] | None = None, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, size, text_crc32, shard and slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    dims = dims or {"d_size": F.log(F.octet_length(text) + overhead), "d_id": F.col(id_col).try_cast("double"), "d_source": F.xxhash64("source") if "source" in docs.columns else F.lit(0)}
    scratch = Scratch(docs.sparkSession, "sharding")
    points = docs.select(F.col(id_col), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *(c.alias(n) for n, c in dims.items()))
    points = scratch.save(points.withColumn("__tie", F.xxhash64(id_col, "text_crc32", F.monotonically_increasing_id())), "points")
    points = scratch.save(_scaled(points, list(dims)).drop(*dims), "scaled")
    tree = build_tree(points, shards, list(dims))
    out = points.select(id_col, "size", "text_crc32", tree.column().cast("int").alias("shard"), "__tie")
    return with_slots(out, "shard", [id_col, "text_crc32", "__tie"]).drop("__tie")


def op5_sharding(docs: DataFrame) -> DataFrame:
    """The contract's row per document: 40 shards under the law ``bytes``."""
    out = shard_documents(docs, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
