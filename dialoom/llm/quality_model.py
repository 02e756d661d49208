"""Quality classifier: an interpolated modified Kneser-Ney character n-gram model of trusted text.

A symbol is a code point in lower case; digits, white space and letters in runs of capitals are a symbol each, and code
points beyond the first plane share its private area. An n-gram of four is a code of 64 bits, exact for every script.
Trusted documents are counted batch by batch, then in Spark tables dealt by n-gram; joins between the orders give
continuation counts, the discounts D1, D2 and D3+ of each order and the weights of the order below.

Documents are dealt into blocks of about ``block_bytes`` of text by a hash of id and text. A block's distinct n-grams are
found once; the distinct ones over all blocks are joined with the tables of counts, order by order, each join a shuffle
on the n-gram or its context. The probabilities return to their blocks, where each document is scored. Nothing of the
model is broadcast or collected but its discounts and the size of its alphabet; it may grow with the corpus.

A fifth of the trusted texts (chosen by a hash of the text, so that copies stay together) is held out of the counts. The
limit of a language is a quantile of its held-out log perplexities and three standard errors of their mean, drawn to that
of all languages with a weight of ``prior`` documents. Documents above it are rejected.

Null and empty texts have no perplexity and are rejected. Without held-out text every other document is kept. Repeated
rows are scored alike, each on its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.storage import Scratch
from dialoom.llm.tokens import small_batches

ORDER, BITS = 4, 16
#: The symbol of letters in runs of capitals; 0 stands before the text.
SHOUT = 0xFFFE
HELD_OUT = 5


@functools.cache
def _codes() -> np.ndarray:
    """The symbol of each code point of the first plane."""
    codes = np.arange(0x10000, dtype=np.uint16)
    codes[0] = 0xFFFF
    for c in range(0x10000):
        low = chr(c).lower()
        if len(low) == 1 and ord(low) < 0x10000 and c:
            codes[c] = ord(low)
        if chr(c).isdecimal():
            codes[c] = ord("0")
        elif chr(c).isspace():
            codes[c] = ord(" ")
    return codes


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _codes()[np.where(points < 0x10000, points, 0xE000 + points % 6400)]
    upper = (points >= 65) & (points <= 90)
    codes[1:][upper[1:] & upper[:-1]] = SHOUT
    return codes


def grams(codes: np.ndarray, order: int) -> np.ndarray:
    """The code of the n-gram that ends at each position; symbol 0 stands before the text."""
    padded = np.concatenate([np.zeros(order - 1, np.uint64), codes.astype(np.uint64)])
    out = np.zeros(len(codes), np.uint64)
    for k in range(order):
        out = (out << np.uint64(BITS)) | padded[k : k + len(codes)]
    return out.view(np.int64)


def count_grams(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(gram, n) over all the documents, counted batch by batch before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 0):
            parts = [grams(symbols(t), order) for t in batch.column(0).to_pylist() if t]
            if parts:
                cells, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], ["gram", "n"])

    return docs.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """D1, D2, D3+ of an order, from its counts of counts."""
    seen = {r.n: r["count"] for r in counts.where("n <= 4").groupBy("n").count().collect()}
    n1, n2, n3, n4 = (seen.get(i, 0) for i in range(1, 5))
    if not (n1 and n2 and n3):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    made = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(made)]


def context_of(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, BITS)


def shorter(gram: Column, k: int) -> Column:
    """An n-gram of ``k`` without its first symbol."""
    return gram.bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))


def train(trusted: DataFrame, scratch: Scratch, text_col: str = "text", order: int = ORDER) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1: (gram, p) with discounted probabilities and (context, w) with weights of the order below."""
    counts = scratch.save(count_grams(trusted, text_col, order), "counts")
    out = []
    for k in range(order, 0, -1):
        d1, d2, d3 = _discounts(counts)
        n = F.col("n")
        d = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        context = context_of(F.col("gram"))
        totals = scratch.save(counts.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(d).alias("held")), "totals")
        p = counts.withColumn("context", context).join(totals, "context").select("gram", ((n - d) / F.col("total")).alias("p"))
        out.append((scratch.save(p, "p"), totals.select("context", (F.col("held") / F.col("total")).alias("w"))))
        # Continuation counts: how many different symbols precede each shorter n-gram.
        if k > 1:
            counts = scratch.save(counts.groupBy(shorter(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n")), "counts")
    return out[::-1]


def probabilities(asked: DataFrame, model: list[tuple[DataFrame, DataFrame]], scratch: Scratch) -> DataFrame:
    """(gram, p) for the distinct n-grams ``asked``, seen in training or not: one join with each table of an order."""
    k = len(model)
    seen, weights = model[-1]
    rows = asked.select("gram", context_of(F.col("gram")).alias("context"), shorter(F.col("gram"), k).alias("short"))
    rows = rows.join(seen, "gram", "left").join(weights, "context", "left")
    if k == 1:
        below = F.lit(1 / (seen.count() + 1))
    else:
        less = scratch.save(rows.select(F.col("short").alias("gram")).distinct(), "asked")
        rows = rows.join(probabilities(less, model[:-1], scratch).select(F.col("gram").alias("short"), F.col("p").alias("below")), "short", "left")
        below = F.col("below")
    p = F.coalesce("p", F.lit(0.0)) + F.coalesce("w", F.lit(1.0)) * below
    return scratch.save(rows.select("gram", p.alias("p")), "probabilities")


def block_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(block, gram), distinct, of rows (block, text) dealt by block; gathered over batches before the shuffle."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in small_batches(batches, 1):
            parts: dict[int, list[np.ndarray]] = {}
            for b, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    parts.setdefault(b, []).append(grams(symbols(t), order))
            for b, found in parts.items():
                held[b] = np.unique(np.concatenate([*found, held[b]] if b in held else found))
            if sum(map(len, held.values())) > 4_000_000:
                yield from made(held)
                held = {}
        yield from made(held)

    def made(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for b, cells in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), b), pa.int64()), pa.array(cells, pa.int64())], ["block", "gram"])

    return rows.select("block", "text").mapInArrow(gather, "block long, gram long").distinct()


def perplexities(docs: DataFrame, model: list[tuple[DataFrame, DataFrame]], scratch: Scratch, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = 8_000_000) -> DataFrame:
    """The rows of ``docs`` without their text, with ``perplexity``."""
    keep = [c for c in docs.columns if c != text_col]
    order = len(model)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    block = F.pmod(F.xxhash64(id_col, text_col), F.lit(size // block_bytes + 1))
    dealt = docs.select(block.alias("block"), F.col(text_col).alias("text"), F.struct(*keep).alias("row"))
    pairs = scratch.save(block_grams(dealt.repartition("block"), order), "block-grams")
    found = probabilities(scratch.save(pairs.select("gram").distinct(), "asked"), model, scratch)
    known = scratch.save(pairs.join(found, "gram").select("block", "gram", F.log("p").cast("float").alias("log_p")), "block-probabilities")
    scratch.drop(pairs)

    def score(rows: pa.Table, table: pa.Table) -> pa.Table:
        gram, log_p = table["gram"].to_numpy(), table["log_p"].to_numpy()
        by = np.argsort(gram)
        gram, log_p = gram[by], log_p[by]
        values = []
        for t in rows["text"]:
            text = t.as_py()
            values.append(float(np.exp(-log_p[np.searchsorted(gram, grams(symbols(text), order))].mean(dtype=np.float64))) if text else None)
        row = rows["row"].combine_chunks()
        row = row if isinstance(row, pa.StructArray) else pa.concat_arrays(row.chunks)
        return pa.Table.from_arrays([*(pc.struct_field(row, [i]) for i in range(len(keep))), pa.array(values, pa.float64())], [*keep, "perplexity"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(keep).schema) + ", perplexity double"
    return dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)


def score_documents(docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.995, prior: float = 100.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: id, lang, perplexity, its limit and kept."""
    scratch = Scratch(docs.sparkSession, "quality-model")
    ids = trusted_ids.select(F.col(id_col).alias("__id")).where("__id is not null").distinct()
    rows = docs.select(F.col(id_col), F.col(text_col), F.col(lang_col), (F.pmod(F.xxhash64(text_col), F.lit(HELD_OUT)) == 0).alias("__held"))
    learnt = rows.where(~F.col("__held")).join(ids.hint("merge"), rows[id_col] == F.col("__id"), "left_semi")
    scored = scratch.save(perplexities(rows, train(learnt, scratch, text_col), scratch, text_col, id_col), "scored")
    held = scored.where("__held and perplexity is not null")
    held = held.join(ids, held[id_col] == F.col("__id"), "left_semi")
    log_p = F.log("perplexity")
    # A quantile over few documents is low; three standard errors of their mean are added.
    limit = F.percentile_approx(log_p, F.lit(quantile), F.lit(10_000)) + 3 * F.stddev_pop(log_p) / F.sqrt(F.count("*"))
    over_all = held.agg(limit.alias("x")).first()["x"]
    top = F.lit(float("inf") if over_all is None else over_all)
    own = held.groupBy(lang_col).agg(limit.alias("own"), F.count("*").alias("n"))
    own = scratch.save(own.select(F.col(lang_col).alias("__lang"), ((F.col("own") * F.col("n") + top * prior) / (F.col("n") + prior)).alias("own")), "limits")
    out = scored.join(own, scored[lang_col].eqNullSafe(F.col("__lang")), "left").withColumn("limit", F.exp(F.coalesce("own", top)))
    return out.select(id_col, lang_col, "perplexity", "limit", F.coalesce(F.col("perplexity") <= F.col("limit"), F.lit(False)).alias("kept"))


def op4_quality_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    trusted = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")
    return score_documents(docs.select("doc_id", "text", "lang"), trusted)
