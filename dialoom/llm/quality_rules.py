"""Quality rules: fixed text rules, then a hashed n-gram log-likelihood ratio, by DataFrame functions alone.

The units are a text's white-space separated words, whole; their unigrams and bigrams are hashed into ``buckets``
cells each. Two multinomials over the cells are estimated from all rows:
the target one from trusted documents, the raw one from every document. A document's score is the mean, over its
n-grams, of the log ratio of the two; documents below ``threshold`` are rejected. Every document is decided, by
the same rule, whatever the input's size. The weights are a table of fixed size, so they travel in the plan.

Rules: fewer than 10 words, or over 20 % of the words in 5-word windows that occur twice or more in the text.

Null texts have no words and fail the rules; so do empty ones. Without trusted documents all weights are 0 and
the score rejects none. Repeated rows are decided alike, each on its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.llm.storage import literal_table, pinned, shuffles_removed

WHITE = " \t\n\x0b\x0c\r"
#: Scores under this are far outside what trusted text reaches: on 88,000 trusted texts the least was -0.2.
THRESHOLD = -0.5
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5


def words_of(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``__words`` and their ``__hashes``."""
    docs = docs.withColumn("__words", pinned(words_of(F.col(text_col))))
    return docs.withColumn("__hashes", pinned(F.transform("__words", lambda w: F.xxhash64(w))))


def _grams(hashes: Column, size: int) -> Column:
    """A hash for each run of ``size`` neighbours."""
    n = F.size(hashes) - F.lit(size - 1)
    runs = F.transform(F.slice(hashes, 1, F.greatest(n, F.lit(0))), lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, size))))
    return F.when(n > 0, runs).otherwise(F.array().cast("array<bigint>"))


def _with_repeated(docs: DataFrame, size: int) -> DataFrame:
    """Adds n_repeat_words, from ``__grams``: words covered by windows whose hash occurs twice or more, as the length
    of a union of intervals. Each array is a column of its own, so that it is made once a row; most rows have none."""
    grams, none = F.col("__grams"), F.array()
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    pairs = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    docs = docs.withColumn("__pairs", pinned(F.when(some, F.sort_array(pairs)).otherwise(none.cast("array<struct<h:bigint,i:int>>"))))
    twice = F.filter("__pairs", lambda x, k: (F.get("__pairs", k - 1)["h"] == x["h"]) | (F.get("__pairs", k + 1)["h"] == x["h"]))
    docs = docs.withColumn("__at", pinned(F.sort_array(F.transform(twice, lambda x: x["i"]))))
    lengths = F.transform("__at", lambda p, k: F.least(F.lit(size), F.coalesce(F.get("__at", k + 1) - p, F.lit(size))))
    return docs.withColumn("n_repeat_words", F.aggregate(lengths, F.lit(0).cast("long"), lambda acc, v: acc + v)).drop("__pairs", "__at")


def with_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed. Needs ``with_words``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    out = docs.withColumn("__lines", pinned(F.when(F.instr(text, "\n") > 0, lines).otherwise(F.array().cast("array<string>"))))
    out = _with_repeated(out.withColumn("__grams", pinned(_grams(F.col("__hashes"), WINDOW))), WINDOW)
    n = F.size("__words").cast("long")
    out = out.withColumns({
        "n_words": n,
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    }).drop("__grams", "__lines")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def with_cells(docs: DataFrame, buckets: int) -> DataFrame:
    """Adds ``__cells``: the cell of each n-gram; unigrams in the lower half, bigrams in the upper. Needs ``__hashes``."""
    uni = F.transform("__hashes", lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.transform(_grams(F.col("__hashes"), 2), lambda h: (F.pmod(h, F.lit(buckets)) + buckets).cast("int"))
    return docs.withColumn("__cells", pinned(F.concat(uni, two)))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text", prior: float = 1000.0) -> list[float]:
    """The log ratio of target to raw probability for each cell, counted over all rows; ``2 * buckets`` values."""
    trusted = trusted_ids.select(F.col(id_col).alias("__id")).where(F.col("__id").isNotNull()).distinct().withColumn("__trusted", F.lit(1))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(trusted.hint("merge"), "__id", "left")
    cells = with_cells(with_words(rows), buckets).select(F.explode("__cells").alias("cell"), F.coalesce("__trusted", F.lit(0)).alias("t"))
    with shuffles_removed(docs.sparkSession):
        counts = cells.groupBy("cell").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect()
    raw, target = [0] * (2 * buckets), [0] * (2 * buckets)
    for r in counts:
        raw[r.cell], target[r.cell] = r.raw, r.target
    out = []
    for half in (slice(0, buckets), slice(buckets, None)):
        n_raw, n_target = sum(raw[half]), sum(target[half])
        if not n_target:
            return [0.0] * (2 * buckets)
        # The target's prior is the raw distribution, worth ``prior`` n-grams: few trusted texts say little, at any size.
        for t, r in zip(target[half], raw[half], strict=True):
            share = r / n_raw
            out.append(math.log((t + prior * share) / (n_target + prior) / share) if r else 0.0)
    return out


def score_documents(docs: DataFrame, trusted_ids: DataFrame, buckets: int = 1 << 17, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the rules' figures, ``score`` and ``kept``."""
    ratios = log_ratios(docs, trusted_ids, buckets, id_col, text_col)
    table = literal_table(ratios)
    out = with_cells(with_rules(with_words(docs, text_col), text_col), buckets)
    total = F.aggregate("__cells", F.lit(0.0), lambda acc, c: acc + F.get(table, c))
    out = out.withColumn("score", pinned(F.when(F.size("__cells") > 0, total / F.size("__cells")).otherwise(F.lit(0.0))))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("__words", "__hashes", "__cells")


def trusted(labels: DataFrame) -> DataFrame:
    """Ids labelled as of good quality."""
    return labels.where(F.col("quality") == 1).select("doc_id")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return score_documents(docs, trusted(labels)).where("kept").select(docs.columns)


def op8_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's row per document, with the score beside it."""
    out = score_documents(docs.select("doc_id", "text"), trusted(labels))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
