"""Token files in directly addressable codes: any token is read by its number, without decoding others.

Ids are split into chunks of eight bits, a level for each. Level k holds the k-th chunk of every id that reaches
it, and a bitmap that says which ids go on to level k + 1; a directory of ranks over the bitmap (a count for every
512 bits) gives an id's place in the next level. An id's chunks are found by one rank per level.

A file is a Parquet table of segments: whole documents in ascending order of id, about ``segment_tokens`` tokens
each, with the documents' ids and lengths beside the levels. Spark's writer commits it, so it survives lost
executors and lives in any store. Text, not ids, is shuffled into order, as it is smaller.

Null and empty texts hold the end id alone. Rows with the same id follow one another. A null id comes first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.llm import tokens
from dialoom.llm.storage import Scratch, shuffle_partitions

RANK_BITS = 512


class Level:
    def __init__(self, chunks: np.ndarray, bitmap: np.ndarray, ranks: np.ndarray) -> None:
        self.chunks, self.bitmap, self.ranks = chunks, bitmap, ranks

    def rank(self, i: int) -> int:
        """Set bits before position ``i``."""
        block = i // RANK_BITS
        lo = block * (RANK_BITS // 8)
        whole, rest = divmod(i - block * RANK_BITS, 8)
        n = int(self.ranks[block]) if block < len(self.ranks) else 0
        n += int(np.bitwise_count(self.bitmap[lo : lo + whole]).sum())
        if rest:
            n += (int(self.bitmap[lo + whole]) & ((1 << rest) - 1)).bit_count()
        return n

    def goes_on(self, i: int) -> bool:
        return bool(self.bitmap[i // 8] >> (i % 8) & 1)


class DirectCodes:
    """The levels of one segment: ``encode``, ``get`` one id, ``slice`` a range of ids."""

    def __init__(self, levels: list[Level]) -> None:
        self.levels = levels

    @classmethod
    def encode(cls, ids: np.ndarray) -> DirectCodes:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            more = rest > 255
            bitmap = np.packbits(more, bitorder="little")
            blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
            ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]) if len(blocks) else blocks
            levels.append(Level((rest & 255).astype(np.uint8), bitmap, ranks.astype(np.uint32)))
            if not more.any():
                return cls(levels)
            rest = rest[more] >> 8

    def get(self, i: int) -> int:
        value = shift = 0
        for level in self.levels:
            value |= int(level.chunks[i]) << shift
            if not level.goes_on(i):
                return value
            i, shift = level.rank(i), shift + 8
        raise ValueError("a code goes on after its last level")

    def slice(self, start: int, stop: int) -> np.ndarray:
        out = np.zeros(stop - start, np.uint32)
        at: np.ndarray | slice = slice(None)
        for k, level in enumerate(self.levels):
            if stop <= start:
                break
            part = level.chunks[start:stop].astype(np.uint32) << np.uint32(8 * k)
            out[at] |= part
            first = start // 8
            more = np.unpackbits(level.bitmap[first : (stop + 7) // 8], bitorder="little")[start - 8 * first : stop - 8 * first].astype(bool)
            at = np.flatnonzero(more) if isinstance(at, slice) else at[more]
            start = level.rank(start)
            stop = start + int(np.count_nonzero(more))
        return out

    def packed(self) -> list[dict]:
        return [{"chunks": v.chunks.tobytes(), "bitmap": v.bitmap.tobytes(), "ranks": v.ranks.astype("<u4").tobytes()} for v in self.levels]

    @classmethod
    def unpacked(cls, levels: list[dict]) -> DirectCodes:
        return cls([Level(np.frombuffer(v["chunks"], np.uint8), np.frombuffer(v["bitmap"], np.uint8), np.frombuffer(v["ranks"], "<u4")) for v in levels])


_LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())]))


def encode_segments(docs: DataFrame, path: str, end_id: int = 2, drops_space: bool = False, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = 1 << 19, partitions: int | None = None) -> DataFrame:
    """A row per segment, to be written as the token file."""
    kind = docs.schema[id_col].dataType.simpleString()
    n = partitions or shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.crc32(F.col("text").cast("binary")))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, segment, before = TaskContext.get().partitionId(), 0, 0
        ids, lengths, datas, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            codes = DirectCodes.encode(np.frombuffer(b"".join(datas), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([segment]), pa.array([before]), pa.array([held]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([codes.packed()], _LEVELS)],
                ["part", "segment", "part_start", "n_tokens", "doc_ids", "doc_tokens", "levels"],
            )

        for batch in tokens.small_batches(batches):
            got = tokens.encoded(batch, path, drops_space, end_id)
            ids.append(batch.column(0))
            lengths += [len(x) // 4 for x in got]
            datas += got
            held += sum(len(x) for x in got) // 4
            if held >= segment_tokens:
                yield flush()
                segment, before = segment + 1, before + held
                ids, lengths, datas, held = [], [], [], 0
        if datas:
            yield flush()

    return rows.mapInArrow(encode, f"part long, segment long, part_start long, n_tokens long, doc_ids array<{kind}>, doc_tokens array<bigint>, levels array<struct<chunks:binary,bitmap:binary,ranks:binary>>")


def write_token_file(docs: DataFrame, to: str, path: str | None = None, **options) -> None:
    encode_segments(docs, path or tokens.default_path("byte_bpe_50k.json"), **options).write.parquet(to)


def part_starts(segments: DataFrame) -> DataFrame:
    """Tokens before each part of the file. The driver gets one row per part, as many as the file was written with."""
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    rows, before = [], 0
    for r in parts:
        rows.append((r.part, before))
        before += r.n
    return segments.sparkSession.createDataFrame(rows, "part long, part_base long")


def read_documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document of a token file: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, base, doc_tokens, levels = (batch.column(i)[row].as_py() for i in (0, 1, 3, 4))
                codes = DirectCodes.unpacked(levels)
                ends = np.cumsum(doc_tokens)
                datas = [codes.slice(int(e) - n, int(e)).astype("<u4").tobytes() for e, n in zip(ends, doc_tokens, strict=True)]
                columns = [batch.column(2)[row].values, pa.array([part] * len(ends), pa.int64()), pa.array(base + ends - doc_tokens, pa.int64()), pa.array(doc_tokens, pa.int64()), pa.array(map(zlib.crc32, datas), pa.int64())]
                names = ["doc_id", "part", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(datas, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    docs = segments.select("part", "part_start", "doc_ids", "doc_tokens", "levels").mapInArrow(decode, f"doc_id {kind}, part long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    out = docs.join(F.broadcast(part_starts(segments)), "part")
    return out.withColumn("start", F.col("start") + F.col("part_base")).drop("part", "part_base")


def token_at(segments: DataFrame, position: int) -> int | None:
    """The id at a position of the whole file: one segment is read, one id is decoded."""
    at = segments.join(F.broadcast(part_starts(segments)), "part").withColumn("first", F.col("part_base") + F.col("part_start"))
    row = at.where((F.col("first") <= position) & (F.col("first") + F.col("n_tokens") > position)).select("first", "levels").first()
    return DirectCodes.unpacked([v.asDict() for v in row.levels]).get(position - row.first) if row else None


def op10_token_file(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the file, read it back, and give the contract's row per document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-file")
    segments = scratch.save(encode_segments(docs, path or tokens.default_path("byte_bpe_50k.json")), "segments")
    return read_documents(segments)
