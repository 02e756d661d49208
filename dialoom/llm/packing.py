"""Packing: documents' tokens into sequences of bounded length, first-fit decreasing by a tournament tree.

Each document's ids are cut into pieces of at most ``length`` tokens. Documents are dealt at random, by a hash,
into groups of about ``group_docs``; each group is packed on its own, so a task holds one group's piece lengths
and no ids. Within a group, pieces in falling length go to the first bin with room: the tree's inner nodes hold
the largest free capacity below them, and the winner on the left is found in a number of steps that grows with
the logarithm of the bins. A group wastes about one part-filled bin.

Null and empty texts consist of the end id alone. Repeated document rows are packed each on its own. Pieces of a
length over ``length`` can't occur. An empty table gives no sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import tokens

PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


class TournamentTree:
    """Bins of one capacity; ``place(size)`` gives the first bin with room and the offset in it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.capacity = capacity
        self.free = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        free, at = self.free, 1
        if size > free[1]:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if free[at] < size:
                at += 1
        offset = self.capacity - free[at]
        free[at] -= size
        leaf, at = at - self.leaves, at // 2
        while at:
            best = max(free[2 * at], free[2 * at + 1])
            if free[at] == best:
                break
            free[at] = best
            at //= 2
        return leaf, offset


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Ties keep their order."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    full = 0
    tree = None
    for at in order.tolist():
        size = int(sizes[at])
        if size == capacity:  # falling sizes: these come first and fill a bin each
            bins[at], full = full, full + 1
            continue
        if tree is None:
            tree = TournamentTree(len(sizes) - full, capacity)
        leaf, offsets[at] = tree.place(size)
        bins[at] = full + leaf
    return bins, offsets


def token_pieces(docs: DataFrame, path: str, length: int = 4096, end_id: int = 2, drops_space: bool = True, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: the document's id, where it starts in the document, its length and checksum, and its ids if asked for."""
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tokens.small_batches(batches):
            rows: list[list] = [[], [], [], [], []]
            at, parts = [], []
            for i, data in enumerate(tokens.encoded(batch, path, drops_space, end_id)):
                for start in range(0, len(data), 4 * length):
                    part = data[start : start + 4 * length]
                    at.append(i)
                    for row, v in zip(rows, (start // 4, len(part) // 4, zlib.crc32(part), len(data) // 4, part), strict=True):
                        row.append(v)
                    if with_ids:
                        parts.append(part)
            columns = [batch.column(0).take(pa.array(at, pa.int32())), *(pa.array(r, pa.int64()) for r in rows[:4])]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(id_col, text_col).mapInArrow(cut, f"`{id_col}` {kind}, {PIECES}" + ", ids binary" * with_ids)


def pack_pieces(pieces: DataFrame, groups: int, length: int = 4096, id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. Sequence ids are the group's number times 2**32 plus the bin's."""
    schema = pieces.schema.simpleString()[len("struct<") : -1]
    columns = pieces.columns

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([id_col, "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), length)
        return frame[columns].assign(sequence_id=frame["__group"].to_numpy() * 2**32 + bins, offset=offsets)

    group = F.pmod(F.xxhash64(F.lit(seed), id_col, "doc_tokens"), F.lit(groups))
    return pieces.withColumn("__group", group).groupBy("__group").applyInPandas(pack, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = 4096, end_id: int = 2, group_docs: int = 1024, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """All documents packed: a row per piece. The number of groups follows the number of documents."""
    groups = max(1, math.ceil(docs.count() / group_docs))
    path = path or tokens.default_path("word_bpe_49k.json")
    pieces = token_pieces(docs, path, length, end_id, True, id_col, text_col, with_ids)
    return pack_pieces(pieces, groups, length, id_col)


def op2_packing(docs: DataFrame) -> DataFrame:
    """The contract's rows, straight from ``pack_documents``."""
    return pack_documents(docs)
