"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts, each document scanned once.

Texts are normalised in one pass over their UTF-8 bytes: A-Z becomes lower case, every other ASCII byte that is
no letter or digit becomes a space. Windows of ``window`` consecutive item words (the whole item, if it is
shorter) are the automaton's patterns, with a space at both ends so that only whole words match. A document's
matches are mapped back to code point offsets of the original text.

The automaton is broadcast, so its source is bounded: items are dealt into blocks of at most ``max_block_bytes``
of text (an automaton takes about 460 bytes of memory for each byte of items). For more than one, a document passes one block's automaton after the other in the
same task, and what the passes find is united. Nothing is shuffled.

Null and empty texts have no words, hence no hits. A null ``item_id`` counts as an item called ``null``; rows
with the same ``item_id`` are one item. Repeated document rows give repeated result rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.ASCII)
_FOUND = "n_words long, hits array<struct<first:int,last:int>>, items array<string>, spans array<struct<start:int,end:int>>"
_LOWER = {c: c + 32 for c in range(65, 91)}


def normal_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def joined(words: list[bytes]) -> str:
    """Words between single spaces, a byte a character."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def windows(words: list[bytes], size: int) -> Iterator[str]:
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield joined(words[i : i + size])


def build_automaton(items: list[tuple[str, str | None]], size: int):
    """The automaton of all windows; each pattern's value is (its characters, its items)."""
    import ahocorasick

    owners: dict[str, set[str]] = {}
    for item_id, text in items:
        for w in windows(normal_words(text), size):
            owners.setdefault(w, set()).add(item_id)
    automaton = ahocorasick.Automaton()
    for w, ids in owners.items():
        automaton.add_word(w, (len(w), tuple(sorted(ids))))
    if owners:
        automaton.make_automaton()
    return automaton


def merged(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of inclusive index ranges, as disjoint ranges in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def scan_text(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    words = normal_words(text)
    ranges: set[tuple[int, int]] = set()
    items: set[str] = set()
    if words and len(automaton):
        line = joined(words)
        found = list(automaton.iter(line))
        if found:
            starts = np.cumsum([1, *(len(w) + 1 for w in words[:-1])])
            ends = np.array([e for e, _ in found])
            first = np.searchsorted(starts, ends - np.array([v[0] for _, v in found]) + 2)
            last = np.searchsorted(starts, ends) - 1
            ranges.update(zip(first.tolist(), last.tolist(), strict=True))
            for ids in {v[1] for _, v in found}:
                items.update(ids)
    return len(words), merged(ranges), items


def spans_of(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets, end exclusive, of word ranges in the original text."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [(at[a][0], at[b][1]) for a, b in ranges]


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", max_block_bytes: int = 500_000) -> DataFrame:
    """Per document row: its id, n_words, the hit word ranges, the items found and the hit spans of the original."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.col(item_text_col).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / max_block_bytes))
    items = items.withColumn("b", F.pmod(F.xxhash64("i"), F.lit(blocks)))
    empty = F.array().cast
    found = docs.select(
        F.col(id_col), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
        empty("array<struct<first:int,last:int>>").alias("hits"), empty("array<string>").alias("items"), empty("array<struct<start:int,end:int>>").alias("spans"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    for block in range(blocks):
        rows = [(r.i, r.t) for r in items.where(F.col("b") == block).drop("b").collect()]
        found = found.mapInArrow(_scanner(spark.sparkContext.broadcast(rows), window), f"`{id_col}` {kind}, text string, {_FOUND}")
    return found.drop("text")


def _scanner(shared, window: int):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton(shared.value, window)
        for batch in batches:
            texts, hits, items = (batch.column(i).to_pylist() for i in (1, 3, 4))
            out_n, out_hits, out_items, out_spans = [], [], [], []
            for text, old_hits, old_items in zip(texts, hits, items, strict=True):
                n, ranges, ids = scan_text(text, automaton)
                ranges = merged([*ranges, *((h["first"], h["last"]) for h in old_hits)])
                out_n.append(n)
                out_hits.append([{"first": a, "last": b} for a, b in ranges])
                out_items.append(sorted(ids.union(old_items)))
                out_spans.append([{"start": a, "end": b} for a, b in spans_of(text, ranges)] if ranges else [])
            fields = batch.schema
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out_n, pa.int64()), pa.array(out_hits, fields.field(3).type), pa.array(out_items, fields.field(4).type), pa.array(out_spans, fields.field(5).type)],
                schema=fields,
            )

    return scan


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.0, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents, with their own columns, of whose words at most ``max_share`` are hit."""
    found = scan_documents(docs, benchmark, id_col=id_col, **options)
    hit = F.aggregate("hits", F.lit(0), lambda acc, h: acc + h["last"] - h["first"] + 1)
    bad = found.where(hit > max_share * F.col("n_words")).select(F.col(id_col).alias("__bad")).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")), "left_anti")


def op6_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest of ``scan_documents``."""
    found = scan_documents(docs, benchmark)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + (h["last"] - h["first"] + 1))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
