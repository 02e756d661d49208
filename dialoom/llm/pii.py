"""Personal data: fixed patterns, and terms that the corpus shows to give a protected entity away.

Protected entities are the e-mail addresses, IP addresses, card and phone numbers that the patterns find. Evidence
is pooled in groups: an entity itself, its part (mail domain, first two numbers of an IP address, first six digits of
a card, country and area of a phone) and its kind, so that an entity of a single text is covered by what is known of
its part and kind. Corpus co-occurrence estimates, for a term t and a group g, how much of g's information t
discloses: log(P(g | t) / P(g)) / -log P(g), with P(g | t) = (both + a P(g)) / (df + a) from the document frequencies
of t, of g and of both, and ``smoothing`` a. It is near 1 where t never occurs without g. Terms at ``generalise_at`` or
more are generalised to the entity's kind, at ``remove_at`` or more removed, wherever they occur: terms meet a group
if one text holds both, at any distance, and documents that don't name the entity are the ones a term gives away.

Copies count once: equal texts are one document, and texts whose first mention of g stands in the same window
(``window`` terms on either side) are one occurrence of g. A pair needs two of those, as every term of a text occurs
once with all that the text names, and more than chance gives: of all terms, fewer than ``max_chance`` may be expected
to meet g as often if they were independent of it (Poisson bound, over the whole vocabulary).

Null and empty texts have no spans. Rows with the same id and text get the same spans; a null id is an id like
others. Everything is counted before it is joined, so a frequent entity or term is one row on one side of a join.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.storage import Scratch
from dialoom.llm.tokens import small_batches

# The kinds in their order, the patterns and lengths of the contract.
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalise", "remove")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starts inside a run of digits can't match where its first digit doesn't, so they are not tried.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")

_SPAN = pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())])
_GROUP = pa.struct([("group", pa.int64()), ("context", pa.int64())])
_FOUND = "row_key long, base array<struct<start:int,rank:int,end:int>>, groups array<struct<group:bigint,context:bigint>>, terms array<bigint>"
#: Cells of the map of revealing terms that every executor gets; its size is fixed.
CELLS = 1 << 22


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each "@" ends one run of local characters and starts one domain, so every character is looked at once."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end), by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 12 else not p.strip("0") or int(p.lstrip("0")[:4]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def part(rank: int, value: str) -> str:
    """What an entity shares with others of its origin."""
    if rank == 0:
        return value.rsplit("@", 1)[1]
    if rank == 1:
        return ".".join(value.split(".")[:2])
    digits = "".join(c for c in value if c.isdigit())
    return digits[:6] if rank == 2 else digits[:-7]


def _terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The terms that overlap no span."""
    if len(spans) >= 8:
        return _outside(text, spans)
    return [m.span() for m in _TERM.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e in spans)]


def _groups(text: str, spans: list[tuple[int, int, int]], window: int) -> tuple[list[dict], list[int]]:
    """The groups that a text names, each with the window of its first mention, and all terms of the text."""
    terms = _terms(text, spans)
    starts = [a for a, _ in terms]
    groups = {}
    for s, rank, e in spans:
        value = text[s:e].lower()
        i, j = bisect_left(starts, s), bisect_left(starts, e)
        words = [text[a:b].lower() for a, b in (*terms[max(0, i - window) : i], *terms[j : j + window])]
        context = _hash(" ".join(words))
        for name in (f"{rank}:{value}", f"{rank}part:{part(rank, value)}", f"{rank}"):
            groups.setdefault(_hash(name), context)
    return [{"group": g, "context": c} for g, c in groups.items()], sorted(map(_hash, {text[a:b].lower() for a, b in terms}))


def _outside(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Terms that overlap no span, for texts with many spans."""
    reach, ends = 0, []
    for _, _, e in spans:
        reach = max(reach, e)
        ends.append(reach)
    starts = [s for s, _, _ in spans]
    out = []
    for m in _TERM.finditer(text):
        i = bisect_left(starts, m.end())
        if not i or ends[i - 1] <= m.start():
            out.append(m.span())
    return out


def detect(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            keys, base, groups, terms = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                spans = base_spans(text)
                g, t = _groups(text, spans, window) if spans else ([], [])
                keys.append(_hash(text))
                base.append([{"start": s, "rank": r, "end": x} for s, r, x in spans])
                groups.append(g)
                terms.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(base, pa.list_(_SPAN)), pa.array(groups, pa.list_(_GROUP)), pa.array(terms, pa.list_(pa.int64()))], [id_col, "row_key", "base", "groups", "terms"])

    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {kind}, {_FOUND}")


def term_frequencies(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, df): in how many different texts each term occurs outside of base spans, over all documents; counted by batch before
    the shuffle. Terms are those that ``_groups`` and ``occurrences`` find, so each of theirs is here."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 0, 16_000_000):
            found: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    spans = base_spans(text)
                    terms = {text[a:b] for a, b in _terms(text, spans)} if spans else set(_TERM.findall(text))
                    found.update({t.lower() for t in terms})
            yield pa.RecordBatch.from_arrays([pa.array(map(_hash, found), pa.int64(), size=len(found)), pa.array(found.values(), pa.int64(), size=len(found))], ["term", "df"])

    return docs.select(text_col).distinct().mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def disclosures(docs: DataFrame, found: DataFrame, scratch: Scratch, generalise_at: float, remove_at: float, smoothing: float, max_chance: float, text_col: str) -> DataFrame:
    """(group, term, disclosure, action) for the pairs over the threshold. ``found`` comes from ``detect``."""
    n = math.log(max(1, found.select("row_key").distinct().count()))
    named = found.where(F.size("groups") > 0)
    once = named.select("row_key", F.explode("groups").alias("x")).groupBy("x.group", "x.context").agg(F.min("row_key").alias("row_key"))
    once = scratch.save(once, "once")
    of_group = scratch.save(once.groupBy("group").agg(F.count("*").alias("de")).where("de >= 2"), "groups")
    wanted = once.join(of_group, "group", "left_semi").groupBy("row_key").agg(F.collect_list("group").alias("groups"))
    texts = named.groupBy("row_key").agg(F.first("terms").alias("terms")).join(wanted, "row_key")
    pairs = texts.select("groups", F.explode("terms").alias("term")).select(F.explode("groups").alias("group"), "term")
    pairs = scratch.save(pairs.groupBy("group", "term").agg(F.count("*").alias("both")).where("both >= 2"), "pairs")
    every = scratch.save(term_frequencies(docs, text_col), "frequencies")
    vocabulary = math.log(max(1, every.count()))
    joined = pairs.join(of_group, "group").join(every, "term")
    ic, k = n - F.log("de"), F.col("both")
    expected = F.col("df") * F.col("de") / math.exp(n)
    # The chance of k or more is at most expected**k / k!; factorial() ends at 20, Stirling's bound doesn't.
    chance = vocabulary + k * F.log(expected) - F.coalesce(F.log(F.factorial(k.cast("int"))), k * F.log(k) - k)
    given = F.log((k + smoothing * F.col("de") / math.exp(n)) / (F.col("df") + smoothing))
    out = joined.where((k > expected) & (chance <= math.log(max_chance)))
    out = out.withColumn("disclosure", F.when(ic > 1e-9, (given + ic) / ic).otherwise(F.lit(0.0))).where(F.col("disclosure") >= generalise_at)
    return out.select("group", "term", "disclosure", F.when(F.col("disclosure") >= remove_at, F.lit(5)).otherwise(F.lit(4)).alias("action"))


def occurrences(docs: DataFrame, revealing: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row_key, term, start, end) of the revealing terms, and of some others: terms are looked up in a map of
    ``CELLS`` bits here, so that what is shipped is bounded and few rows meet the table of terms in a join."""
    cells = revealing.select(F.pmod("term", F.lit(CELLS)).cast("int").alias("cell")).distinct().toPandas()["cell"].to_numpy()
    bits = np.zeros(CELLS, np.bool_)
    bits[cells] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "row_key", "term", "start", "end"]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit, known, missed = np.unpackbits(np.frombuffer(shared.value, np.uint8)), {}, set()
        for batch in small_batches(batches):
            rows: list[list] = [[], [], [], [], []]
            for at, text in enumerate(batch.column(1).to_pylist()):
                if not text:
                    continue
                words = set(_TERM.findall(text))
                if len(missed) > 500_000:
                    missed = set()
                for w in words.difference(missed, known):
                    h = _hash(w.lower())
                    if hit[h % CELLS]:
                        known[w] = h
                    else:
                        missed.add(w)
                if words.isdisjoint(known):
                    continue
                key = _hash(text)
                for a, b in _terms(text, base_spans(text)):
                    if (term := known.get(text[a:b])) is not None:
                        for column, v in zip(rows, (at, key, term, a, b), strict=True):
                            column.append(v)
            ids = batch.column(0).take(pa.array(rows[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.int32())], names)

    if not len(cells):
        return docs.sparkSession.createDataFrame([], f"`{id_col}` {kind}, row_key long, term long, start int, end int")
    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {kind}, row_key long, term long, start int, end int")


def find_personal_data(docs: DataFrame, window: int = 5, generalise_at: float = 0.7, remove_at: float = 0.95, smoothing: float = 0.5, max_chance: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row: id, row_key, ``base`` and ``found``, arrays of (start, rank, end) by start, then kind; ranks are
    those of KINDS + TERM_KINDS."""
    scratch = Scratch(docs.sparkSession, "pii")
    seen = scratch.save(detect(docs, window, id_col, text_col), "found")
    revealing = scratch.save(disclosures(docs, seen, scratch, generalise_at, remove_at, smoothing, max_chance, text_col), "revealing")
    terms = scratch.save(revealing.groupBy("term").agg(F.max("action").alias("action")), "terms")
    marks = occurrences(docs, terms, id_col, text_col).join(terms, "term").groupBy(id_col, "row_key", "start", "end").agg(F.max("action").alias("rank"))
    added = marks.groupBy(id_col, "row_key").agg(F.collect_list(F.struct("start", "rank", "end")).alias("added"))
    added = scratch.save(added.withColumnsRenamed({id_col: "__id", "row_key": "__key"}), "added")
    out = seen.drop("groups", "terms").join(added, seen[id_col].eqNullSafe(added["__id"]) & (seen["row_key"] == added["__key"]), "left")
    every = F.sort_array(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,end:int>>"))))
    return out.select(id_col, "row_key", "base", every.alias("found"))


def shown(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS + TERM_KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with their own columns, spans replaced: base spans and generalised terms by their kind in square
    brackets, removed terms by nothing. Of overlapping spans the first one wins."""
    found = find_personal_data(docs, id_col=id_col, text_col=text_col, **options).where(F.size("found") > 0)
    found = found.select(F.col(id_col).alias("__id"), "row_key", "found").dropDuplicates(["__id", "row_key"])

    @F.pandas_udf("string")
    def replaced(texts, spans):
        import pandas as pd

        out = []
        for text, own in zip(texts, spans, strict=True):
            if text is None or own is None or not len(own):
                out.append(text)
                continue
            parts, at = [], 0
            for s in own:
                if s["start"] >= at:
                    parts += [text[at : s["start"]], "" if s["rank"] == 5 else f"[{(KINDS + ('term',))[s['rank']]}]"]
                    at = s["end"]
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out)

    @F.pandas_udf("long")
    def key(texts):
        return texts.map(lambda t: _hash(t or ""))

    keyed = docs.withColumn("__key", key(text_col))
    out = keyed.join(found, keyed[id_col].eqNullSafe(found["__id"]) & (keyed["__key"] == found["row_key"]), "left")
    return out.withColumn(text_col, replaced(text_col, "found")).select(docs.columns)


def op1_pii(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    out = find_personal_data(docs.select("doc_id", "text"))
    n = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return out.select("doc_id", *(n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"))
