"""Secret scans: fixed patterns, and runs that look random to character Markov models; DataFrame functions alone.

Two first-order Markov models over printable ASCII are trained from labelled samples: random strings and ordinary
identifiers. A candidate, a run of 16 or more key characters that has a digit or a change from lower to upper
case, is scored by the mean log-likelihood ratio of its transitions; at ``threshold`` or more it is a secret. The
models' table has a fixed size (94 x 94), so it travels in the plan; a text is scanned in its row.

Samples: random strings come from digests of a counter, ordinary ones from the words of at most
``sample_docs`` documents (those of smallest id hash) and identifiers made of them. The bound is on the training
sample only: every whole text is scanned.

Null and empty texts have no spans. Where no ordinary sample exists, the model falls back to its random side's
smoothing and flags by that. Repeated rows are scanned each on its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.storage import literal_table, pinned

# The patterns of the contract, and the lengths that matches need.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # a whole run of at least 18: shorter runs fail whole, so the bound can stand here
HEX = "[0-9a-f]{16,}"
ASSIGN_LENGTH = 12
CANDIDATE = "(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*(?:[0-9]|(?<=[a-z])[A-Z]))[A-Za-z0-9+/_=-]{16,}"
#: Elements of an array that are folded at a time.
CHUNK = 128
KINDS = ("assign", "access", "hex", "random")
FIRST, SYMBOLS = 33, 94
THRESHOLD = 0.6

_SPAN = "array<struct<start:int,rank:int,end:int>>"


def _folded(steps: Column, first: Column, out_type: str, step) -> Column:
    """The outputs of a fold over an array, in linear time for all lengths met here: appending to an array copies it, so
    steps are folded in chunks of ``CHUNK``, and chunks' outputs are joined at the end. ``step`` takes the state and an
    element and gives (state, outputs)."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(steps) - 1, F.lit(0)) / CHUNK).cast("int")), lambda k: F.slice(steps, (k * CHUNK + 1).cast("int"), CHUNK))
    none = F.array().cast(out_type)

    def inner(acc: Column, x: Column) -> Column:
        at, made = step(acc["at"], x)
        return F.struct(at.alias("at"), F.concat(acc["out"], made).alias("out"))

    def outer(acc: Column, chunk: Column) -> Column:
        done = F.aggregate(chunk, F.struct(acc["last"]["at"].alias("at"), none.alias("out")), inner)
        return F.struct(done.alias("last"), F.concat(acc["outs"], F.array(acc["last"]["out"])).alias("outs"))

    start = F.struct(F.struct(first.alias("at"), none.alias("out")).alias("last"), F.array().cast(f"array<{out_type}>").alias("outs"))
    return F.when(F.size(steps) > 0, F.aggregate(chunks, start, outer, lambda acc: F.flatten(F.concat(acc["outs"], F.array(acc["last"]["out"]))))).otherwise(none)


def _pieces(text: Column, pattern: str) -> tuple[Column, Column]:
    """The matches of a pattern, and the text before each and after the last one."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _with_spans(docs: DataFrame, name: str, text: Column, pattern: str) -> DataFrame:
    """Adds start, end and matched text of every leftmost match: the gaps that split() leaves give the offsets. What
    the fold reads is a column of its own, so that it is made once a row."""
    found, gaps = _pieces(text, pattern)
    steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        a = at + x["g"]
        b = a + F.length(x["m"])
        return b, F.array(F.struct(a.alias("start"), b.alias("end"), x["m"].alias("value")))

    docs = docs.withColumn(name, pinned(steps))
    return docs.withColumn(name, pinned(_folded(F.col(name), F.lit(0), "array<struct<start:int,end:int,value:string>>", step)))


def _blanked(text: Column, pattern: str, which=lambda m: F.lit(True)) -> Column:
    """The text with as many line feeds in place of each match that counts."""
    found, gaps = _pieces(text, pattern)
    parts = F.zip_with(gaps, found, lambda g, m: F.concat(g, F.when(m.isNull(), "").when(which(m), F.repeat(F.lit("\n"), F.length(m))).otherwise(m)))
    return F.when(F.size(found) > 0, F.array_join(parts, "")).otherwise(text)


def _assigned(value: Column) -> Column:
    return F.length(F.regexp_extract(value, ASSIGN, 1)) >= ASSIGN_LENGTH


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"))).cast(_SPAN)


def _code(value: Column, at: Column) -> Column:
    """A character's index in the models' alphabet."""
    c = F.ascii(F.substring(value, at, 1)) - F.lit(FIRST)
    return F.least(F.greatest(c, F.lit(0)), F.lit(SYMBOLS - 1))


def _pairs(value: Column) -> Column:
    """The table index of each transition."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(value) - 1, F.lit(1))), lambda i: _code(value, i) * SYMBOLS + _code(value, i + 1))


def default_samples(docs: DataFrame, sample_docs: int = 256, random_strings: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled samples: columns token, secret."""
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    mixed = F.translate(F.base64(F.unhex(digest)), "=", "A")
    n = (F.lit(16) + F.col("id") % 24).cast("int")
    made = spark.range(random_strings).select(
        F.when(F.col("id") % 3 == 0, F.substring(digest, F.lit(1), n)).when(F.col("id") % 3 == 1, F.substring(mixed, F.lit(1), n)).otherwise(F.substring(F.upper(F.translate(mixed, "+/", "77")), F.lit(1), n)).alias("token"),
        F.lit(True).alias("secret"),
    )
    # the sample is picked by hashes alone; texts of that many rows are fetched after it
    marked = docs.select(F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"), F.xxhash64(text_col).alias("k")).where("text is not null")
    first = marked.select("h", "k").orderBy("h", "k").limit(sample_docs).distinct()
    few = marked.join(F.broadcast(first), ["h", "k"]).dropDuplicates(["h", "k"])
    words = few.select("h", F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), lambda w: F.length(w) >= 3).alias("w"))
    named = F.transform("w", lambda w, i: F.when(i % 4 == 0, F.concat(F.lower(w), F.lit("_"), F.coalesce(F.get("w", i + 1), w))).when(i % 4 == 1, F.concat(F.lower(w), F.initcap(F.coalesce(F.get("w", i + 1), w)))).when(i % 4 == 2, F.concat(w, F.lit("-"), (2000 + i % 30).cast("string"))).otherwise(w))
    return made.unionByName(words.select(F.explode(named).alias("token"), F.lit(False).alias("secret")))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """The log ratio of each transition, random over ordinary. The driver gets at most two counts per table cell."""
    cells = samples.where(F.length("token") >= 2).select("secret", F.explode(_pairs(F.col("token"))).alias("cell"))
    counts = {(r.secret, r.cell): r["count"] for r in cells.groupBy("secret", "cell").count().collect()}
    out = []
    for a in range(SYMBOLS):
        rows = [[counts.get((kind, a * SYMBOLS + b), 0) + smoothing for b in range(SYMBOLS)] for kind in (True, False)]
        sums = [sum(r) for r in rows]
        out += [math.log(rows[0][b] / sums[0]) - math.log(rows[1][b] / sums[1]) for b in range(SYMBOLS)]
    return out


def log_ratio(value: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of the string's transitions."""
    table = literal_table(model)
    pairs = _pairs(value)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, c: acc + F.get(table, c)) / F.size(pairs)


def find_secrets(docs: DataFrame, samples: DataFrame | None = None, threshold: float = THRESHOLD, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows with ``base`` and ``found``: arrays of (start, rank of the kind, end) by start, then kind; ``found``
    has the base spans and those of the models that overlap none of them."""
    model = train(samples if samples is not None else default_samples(docs, id_col=id_col, text_col=text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = _with_spans(_with_spans(_with_spans(docs, "__assign", text, ASSIGN), "__access", text, ACCESS), "__hex", text, HEX)
    base = F.concat(_ranked(F.filter("__assign", lambda s: _assigned(s["value"])), 0), _ranked(F.col("__access"), 1), _ranked(F.col("__hex"), 2))
    out = out.withColumn("base", pinned(F.sort_array(base)))
    # candidates lie outside the base spans: these are blanked out before the search
    for name, pattern, which in (("__a", ASSIGN, _assigned), ("__b", ACCESS, None), ("__c", HEX, None)):
        before = {"__a": text, "__b": F.col("__a"), "__c": F.col("__b")}[name]
        out = out.withColumn(name, pinned(F.when(F.size("base") > 0, _blanked(before, pattern, which) if which else _blanked(before, pattern)).otherwise(before)))
    out = _with_spans(out, "__candidates", F.col("__c"), CANDIDATE)
    random = F.filter("__candidates", lambda c: log_ratio(c["value"], model) >= threshold)
    out = out.withColumn("found", pinned(F.sort_array(F.concat("base", _ranked(random, 3)))))
    return out.drop("__assign", "__access", "__hex", "__candidates", "__a", "__b", "__c")


def shown(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each merged span replaced by ``[SECRET]``."""

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        gap = F.substring(text, at + 1, F.greatest(s["start"] - at, F.lit(0)))
        made = F.when(s["start"] >= at, F.array(gap, F.lit("[SECRET]"))).otherwise(F.array().cast("array<string>"))
        return F.greatest(at, s["end"]), made

    last = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
    return F.concat(F.array_join(_folded(spans, F.lit(0), "array<string>", step), ""), F.substring(text, last + 1, F.length(text)))


def op7_secrets(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    out = find_secrets(docs.select("doc_id", "text"))
    n = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return out.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"))
