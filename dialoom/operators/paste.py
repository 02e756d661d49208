"""Pasteable text: wiki Markdown and speech lines. Relations first; the one final file is joined on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEEPEST = 3


def heading_lines(body: DataFrame) -> DataFrame:
    """For each body row (document_id, seq, heading_path): the headings that differ from the row before, as Markdown."""
    before = F.coalesce(F.lag("heading_path").over(W.partitionBy("document_id").orderBy("seq")), F.array().cast("array<string>"))
    out = body.withColumn("__before", before)
    same = F.transform("heading_path", lambda h, i: F.coalesce(F.get("__before", i) == h, F.lit(False)))
    out = out.withColumn("__shared", F.coalesce(F.array_position(same, False), F.lit(0)))
    depth = F.when(F.col("__shared") == 0, F.size("heading_path")).otherwise(F.col("__shared") - 1)
    lines = F.transform("heading_path", lambda h, i: F.struct(i.alias("i"), F.concat(F.repeat(F.lit("#"), F.least(i + 1, F.lit(DEEPEST))), F.lit(" "), h).alias("line")))
    fresh = F.transform(F.filter(lines, lambda x: x["i"] >= F.col("__depth")), lambda x: x["line"])
    return out.withColumn("__depth", depth.cast("int")).withColumn("headings", fresh).drop("__before", "__shared", "__depth")


def footnote_numbers(rows: DataFrame, order: list[str]) -> DataFrame:
    """(footnote_id, number): cited ones by their first citation over all documents, then those never cited."""
    at = F.struct(*order)
    cited = rows.where("kind <> 'footnote'").select(at.alias("row"), F.posexplode("footnote_refs").alias("pos", "footnote_id")).groupBy("footnote_id").agg(F.min(F.struct("row", "pos")).alias("first")).select("footnote_id", F.lit(0).alias("late"), "first.row", "first.pos")
    left = rows.where("kind = 'footnote' and footnote_id is not null").groupBy("footnote_id").agg(F.min(at).alias("row")).select("footnote_id", F.lit(1).alias("late"), "row", F.lit(0).alias("pos"))
    every = cited.unionByName(left.join(cited.select("footnote_id"), "footnote_id", "left_anti"))
    return every.select("footnote_id", F.row_number().over(W.orderBy("late", "row", "pos")).alias("number"))  # one number line, as many rows as footnotes


def markdown(documents: list[str], rows: DataFrame) -> str:
    """Documents in the order given, joined to one text."""
    numbers = {r.footnote_id: r.number for r in footnote_numbers(rows, ["document_id", "seq"]).collect()}
    lines: list[str] = []
    body = {(r.document_id, r.seq): r.headings for r in heading_lines(rows.where("kind <> 'footnote'")).collect()}
    by: dict[str, list] = {}
    for r in rows.orderBy("document_id", "seq").toLocalIterator():
        by.setdefault(r.document_id, []).append(r)
    for document in documents:
        notes: dict[str, str] = {}
        for r in by.get(document, []):
            if r.kind == "footnote":
                if r.footnote_id is not None:
                    notes.setdefault(r.footnote_id, r.text)
                continue
            for heading in body[r.document_id, r.seq]:
                lines += [heading, ""]
            marks = sorted({numbers[x] for x in r.footnote_refs if x in numbers})
            lines += [r.text + "".join(f"[^{n}]" for n in marks), ""]
        if notes:
            lines += ["## 각주", "", *(f"[^{n}]: {t}" for n, t in sorted((numbers[k], t) for k, t in notes.items())), ""]
    return "\n".join(lines).strip() + "\n"


def speech_lines(rows: DataFrame, speaker: str = "speaker_raw", text: str = "text") -> DataFrame:
    return rows.withColumn("line", F.concat_ws(": ", speaker, text))
