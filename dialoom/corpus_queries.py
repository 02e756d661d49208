"""The engine's operators as queries over the driver's tables, with the SQL that says the same.

Tables that don't hold a pattern (headers, markup, annotations) are turned into inputs that do, alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.functions import digests, text
from dialoom.operators import audit, paste, screenplay, speakers, subtitles, transcript, wiki
from dialoom.plans.publish import json_column

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SPACE_RE2 = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
END_RE2 = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            SQL[name] = sql
        return f

    return add


def norm_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(nfc_normalize({x}), '[\\x{{200b}}\\x{{200c}}\\x{{200d}}\\x{{feff}}]', '', 'g'), '{SPACE_RE2}+', ' ', 'g'))"


LINES_SQL = f"""lines AS (SELECT doc_id, unnest(a) AS raw, generate_subscripts(a, 1) AS line_no FROM (
  SELECT doc_id, CASE WHEN s[-1] = '' THEN s[1:len(s) - 1] ELSE s END AS a FROM (SELECT doc_id, string_split_regex(text, '{END_RE2}') AS s FROM documents)))"""


@query("normalize_text", f"SELECT doc_id, {norm_sql('text')} AS text FROM documents")
def _(t):
    return t("documents").select("doc_id", text.normalize(F.col("text")).alias("text"))


@query("split_lines", f"WITH {LINES_SQL} SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, raw FROM lines")
def _(t):
    lines = t("documents").select("doc_id", F.posexplode(text.split_lines(F.col("text"))).alias("pos", "raw"))
    return lines.select("doc_id", (F.col("pos") + 1).cast("long").alias("line_no"), "raw")


@query("line_counts", f"WITH {LINES_SQL} SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id")
def _(t):
    return t("documents").select("doc_id", F.size(text.split_lines(F.col("text"))).cast("long").alias("n_lines")).where("n_lines > 0")


@query("merge_lines", f"WITH {LINES_SQL} SELECT doc_id, coalesce(string_agg(x, ' ' ORDER BY line_no) FILTER (x <> ''), '') AS merged FROM (SELECT doc_id, line_no, {norm_sql('raw')} AS x FROM lines) GROUP BY doc_id")
def _(t):
    docs = t("documents").select("doc_id", text.nfc(F.col("text")).alias("text"))
    return docs.select("doc_id", text.merge_lines(text.split_lines(F.col("text"))).alias("merged")).where(F.size(text.split_lines(F.col("text"))) > 0)


ROLE = "CASE turn % 4 WHEN 0 THEN role WHEN 1 THEN upper(role) || ' (aside)' WHEN 2 THEN role || ' [x] (y)' ELSE '  ' || role || ' (y) [x] ' END"


def spoken(t) -> DataFrame:
    return t("conversations").withColumn("speaker_raw", F.expr(ROLE))


BARE = "trim(regexp_replace(regexp_replace(trim(s), '\\s*\\([^(]*\\)$', ''), '\\s*\\[[^\\[]*\\]$', ''))"
SPOKEN_SQL = f"spoken AS (SELECT *, {ROLE} AS s FROM conversations), keyed AS (SELECT *, {BARE} AS bare FROM spoken)"
ALIASES = [("user", "persona", "user"), ("assistant", "persona", "helper"), ("system", "non_dialogue", None)]
ALIAS_SQL = "aliases(key, kind, persona_id) AS (VALUES ('user', 'persona', 'user'), ('assistant', 'persona', 'helper'), ('system', 'non_dialogue', NULL))"


def alias_frame(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(ALIASES, "key string, kind string, persona_id string")


@query("strip_qualifier", f"WITH {SPOKEN_SQL} SELECT conv_id, turn, bare FROM keyed")
def _(t):
    return spoken(t).select("conv_id", "turn", text.without_qualifier(F.col("speaker_raw")).alias("bare"))


@query("speaker_key", f"WITH {SPOKEN_SQL} SELECT conv_id, turn, lower(trim(s)) AS key FROM keyed")
def _(t):
    return spoken(t).select("conv_id", "turn", text.speaker_key(F.col("speaker_raw")).alias("key"))


@query("resolve_speaker", f"WITH {SPOKEN_SQL}, {ALIAS_SQL} SELECT conv_id, turn, coalesce(kind, 'unknown') AS kind, persona_id FROM keyed LEFT JOIN aliases ON lower(bare) = key")
def _(t):
    rows = spoken(t)
    return speakers.resolve(rows, alias_frame(rows)).select("conv_id", "turn", "kind", "persona_id")


@query("speakers_seen", f"WITH {SPOKEN_SQL} SELECT CAST(conv_id AS VARCHAR) AS source_id, trim(s) AS speaker, count(*) AS n FROM keyed GROUP BY 1, 2")
def _(t):
    return speakers.speakers_seen(spoken(t).withColumn("source_id", F.col("conv_id").cast("string")))


# A transcript per conversation: a title, then a header and the text a turn; some headers are malformed, some bodies blank.
TURN = "CASE WHEN turn % 7 = 3 THEN '[0:' || turn || ' ' || role ELSE '[' || lpad(CAST(turn AS {s}), 2, '0') || ':30] ' || role END || chr(10) || CASE WHEN turn % 5 = 4 THEN ' ' ELSE text END"
SCRIPT_SQL = f"""scripts AS (SELECT CAST(conv_id AS VARCHAR) AS source_id, 'Title' || chr(10) || string_agg({TURN.format(s='VARCHAR')}, chr(10) ORDER BY turn, text) AS script FROM conversations GROUP BY conv_id),
raw AS (SELECT source_id, unnest(a) AS raw, generate_subscripts(a, 1) AS line_no FROM (SELECT source_id, CASE WHEN s[-1] = '' THEN s[1:len(s) - 1] ELSE s END AS a FROM (SELECT source_id, string_split_regex(script, '{END_RE2}') AS s FROM scripts))),
flagged AS (SELECT source_id, line_no, rtrim(raw) AS raw, regexp_matches(raw, '^\\s*\\[\\s*\\d') AS cand, regexp_matches(raw, '^\\s*\\[\\s*\\d{{1,3}}:\\d\\d(:\\d\\d)?\\s*\\]\\s*\\S') AS hdr FROM raw),
seg AS (SELECT *, cand AND NOT hdr AS bad, sum(hdr::INT) OVER w AS seq, last_value(CASE WHEN hdr THEN 'h' WHEN cand THEN 'm' END IGNORE NULLS) OVER w AS state FROM flagged WINDOW w AS (PARTITION BY source_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
inside AS (SELECT * FROM seg WHERE hdr OR (NOT cand AND state = 'h')),
blocks AS (SELECT source_id, CAST(seq AS BIGINT) AS seq, CAST(min(line_no) AS BIGINT) AS line_no, regexp_extract(max(raw) FILTER (hdr), '\\[\\s*([0-9:]+)', 1) AS ts, trim(regexp_extract(max(raw) FILTER (hdr), '\\](.*)$', 1)) AS speaker_raw,
  coalesce(string_agg({norm_sql('raw')}, ' ' ORDER BY line_no) FILTER (NOT hdr AND {norm_sql('raw')} <> ''), '') AS text FROM inside GROUP BY source_id, seq),
decided AS (SELECT b.*, CASE WHEN text = '' THEN 'quarantined' WHEN kind = 'non_dialogue' THEN 'excluded_non_dialogue' WHEN kind IS NULL THEN 'excluded_unknown_speaker' WHEN persona_id <> 'user' THEN 'excluded_other_persona' ELSE 'target' END AS disposition FROM blocks b LEFT JOIN aliases ON lower(speaker_raw) = key),
quarantine AS (SELECT source_id, CAST(0 AS INT) AS phase, CAST(line_no AS BIGINT) AS line_no, CASE WHEN bad THEN 'malformed_header' WHEN state IS NULL THEN 'text_before_first_header' ELSE 'orphaned_body_after_malformed_header' END AS reason, trim(raw) AS raw FROM seg WHERE trim(raw) <> '' AND (bad OR (NOT cand AND state IS DISTINCT FROM 'h'))
  UNION ALL SELECT source_id, 1, line_no, 'empty_body', '[' || ts || '] ' || speaker_raw FROM decided WHERE text = '')"""
SCRIPT_SQL = f"WITH {ALIAS_SQL}, {SCRIPT_SQL}"


def scripts(t) -> DataFrame:
    turns = F.sort_array(F.collect_list(F.struct("turn", "text", F.expr(TURN.format(s="STRING")).alias("said"))))
    rows = t("conversations").groupBy(F.col("conv_id").cast("string").alias("source_id")).agg(turns.alias("turns"))
    return rows.select("source_id", F.lit("user").alias("target"), F.concat(F.lit("Title\n"), F.array_join(F.transform("turns", lambda x: x["said"]), "\n")).alias("text"))


def parsed(t) -> transcript.Parsed:
    texts = scripts(t)
    return transcript.parse_texts(texts, alias_frame(texts), texts.where("false").select("source_id", F.lit("").alias("error")))


@query("transcript_blocks", f"{SCRIPT_SQL} SELECT source_id, seq, line_no, ts AS timestamp, speaker_raw, text FROM blocks")
def _(t):
    made = transcript.blocks(transcript.segmented(transcript.numbered_lines(scripts(t))))
    return made.select("source_id", F.col("seq").cast("long").alias("seq"), F.col("line_no").cast("long").alias("line_no"), "timestamp", "speaker_raw", "text")


@query("transcript_quarantine", f"{SCRIPT_SQL} SELECT * FROM quarantine")
def _(t):
    return parsed(t).quarantine.withColumn("line_no", F.col("line_no").cast("long"))


@query("transcript_utterances", f"{SCRIPT_SQL} SELECT source_id, seq, line_no AS line, CAST(ts[1:2] AS BIGINT) * 60 + CAST(ts[4:5] AS BIGINT) AS seconds, text, printf('%s-t%05d-%04d', source_id, CAST(ts[1:2] AS BIGINT) * 60 + CAST(ts[4:5] AS BIGINT), seq) AS utterance_id FROM decided WHERE disposition = 'target'")
def _(t):
    u = parsed(t).utterances
    return u.select("source_id", F.col("seq").cast("long").alias("seq"), "source_locator.line", F.col("source_locator.timestamp_seconds").alias("seconds"), "text", "utterance_id")


@query("transcript_counts", f"""{SCRIPT_SQL} SELECT source_id, disposition AS counter, count(*) AS n FROM decided WHERE disposition <> 'quarantined' GROUP BY 1, 2
UNION ALL SELECT source_id, 'quarantined', count(*) FROM quarantine GROUP BY 1 UNION ALL SELECT source_id, 'input_lines', count(*) FROM raw GROUP BY 1 UNION ALL SELECT source_id, 'blocks_total', count(*) FROM blocks GROUP BY 1""")
def _(t):
    return parsed(t).counts


@query("exact_duplicate_groups", "SELECT sha256(text) AS text_sha256, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return audit.duplicate_sizes(t("documents")).where("n > 1")


@query("exact_duplicate_members", "SELECT doc_id, text_sha256, n AS duplicate_count FROM (SELECT doc_id, sha256(text) AS text_sha256, count(*) OVER (PARTITION BY sha256(text)) AS n FROM documents) WHERE n > 1")
def _(t):
    return audit.with_duplicates(t("documents").select("doc_id", "text")).where("duplicate_count > 1").drop("text")


@query("short_text", "SELECT 'documents' AS t, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE length(text) <= 20 UNION ALL SELECT 'conversations', conv_id || ':' || turn FROM conversations WHERE length(text) <= 20")
def _(t):
    short = lambda df: df.where(audit.is_short(F.col("text")))
    return short(t("documents")).select(F.lit("documents").alias("t"), F.col("doc_id").cast("string").alias("id")).unionByName(short(t("conversations")).select(F.lit("conversations").alias("t"), F.concat_ws(":", "conv_id", "turn").alias("id")))


@query("length_buckets", "SELECT bucket, count(x) AS n FROM (VALUES ('0-20'), ('21-50'), ('51-100'), ('101-200'), ('201+')) b(bucket) LEFT JOIN (SELECT CASE WHEN length(text) <= 20 THEN '0-20' WHEN length(text) <= 50 THEN '21-50' WHEN length(text) <= 100 THEN '51-100' WHEN length(text) <= 200 THEN '101-200' ELSE '201+' END AS x FROM documents) ON x = bucket GROUP BY bucket")
def _(t):
    return audit.length_buckets(t("documents")).drop("position")


MARKED = "marked AS (SELECT *, sha256(text) AS text_sha256, count(*) OVER (PARTITION BY sha256(text)) AS copies FROM documents)"


@query("review_candidates", f"WITH {MARKED} SELECT source AS source_id, CAST(doc_id AS VARCHAR) AS utterance_id, length(text) AS char_count, copies AS duplicate_count, text_sha256, concat_ws(',', CASE WHEN length(text) <= 20 THEN 'short_text' END, CASE WHEN copies > 1 THEN 'exact_duplicate' END) AS reasons FROM marked WHERE length(text) <= 20 OR copies > 1")
def _(t):
    rows = t("documents").select(F.col("source").alias("source_id"), F.col("doc_id").cast("string").alias("utterance_id"), "text")
    return audit.utterance_candidates(rows).withColumn("reasons", F.array_join("reasons", ",")).select("source_id", "utterance_id", "char_count", "duplicate_count", "text_sha256", "reasons")


@query("audit_summary", f"WITH {MARKED} SELECT source AS source_id, count(*) AS utterances, count(*) FILTER (length(text) <= 20) AS short_text, count(*) FILTER (copies > 1) AS exact_duplicate FROM marked GROUP BY 1")
def _(t):
    rows = t("documents").select(F.col("source").alias("source_id"), "text")
    return audit.summary(rows, rows.select("source_id").distinct())


@query("audit_totals", "SELECT count(*) FILTER (n > 1) AS duplicate_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_utterances FROM (SELECT count(*) AS n FROM documents GROUP BY sha256(text))")
def _(t):
    return audit.duplicate_totals(t("documents"))


@query("reason_rollup", "SELECT source AS source_id, lang AS reason, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source, lang), (lang))")
def _(t):
    return audit.reason_rollup(t("documents").select(F.col("source").alias("source_id"), F.col("lang").alias("reason")))


@query("count_reconciliation", "SELECT CAST(o_orderkey AS VARCHAR) AS source_id, CAST(o_orderkey % 7 AS BIGINT) AS declared, coalesce(n, 0) AS actual FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderkey % 7 <> coalesce(n, 0)")
def _(t):
    declared = t("orders").select(F.col("o_orderkey").cast("string").alias("source_id"), (F.col("o_orderkey") % 7).cast("long").alias("target"))
    return audit.miscounted(t("lineitem").select(F.col("l_orderkey").cast("string").alias("source_id")), declared, "target")


@query("provenance_mismatch", "SELECT CAST(l_orderkey AS VARCHAR) AS source_id, CAST(l_linenumber % 3 AS VARCHAR) AS dataset_version, CAST(o_orderkey % 3 AS VARCHAR) AS declared FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE CAST(l_linenumber % 3 AS VARCHAR) IS DISTINCT FROM CAST(o_orderkey % 3 AS VARCHAR)")
def _(t):
    rows = t("lineitem").select(F.col("l_orderkey").cast("string").alias("source_id"), (F.col("l_linenumber") % 3).cast("string").alias("dataset_version"))
    return audit.mismatched(rows, t("orders").select(F.col("o_orderkey").cast("string").alias("source_id"), (F.col("o_orderkey") % 3).cast("string").alias("dataset_version")))


@query("retention_gate", "SELECT o_orderkey FROM orders WHERE o_orderdate IS NOT NULL AND DATE '1996-06-30' > CAST(o_orderdate AS DATE)")
def _(t):
    return t("orders").where(F.col("o_orderdate").isNotNull() & (F.lit("1996-06-30").cast("date") > F.col("o_orderdate").cast("date"))).select("o_orderkey")


@query("manifest_dup_ids", "SELECT source AS source_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return t("documents").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("n")).where("n > 1")


@query("alias_collisions", "SELECT lower(lang) AS key, count(DISTINCT source) AS owners FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def _(t):
    return t("documents").groupBy(text.speaker_key(F.col("lang")).alias("key")).agg(F.count_distinct("source").alias("owners")).where("owners > 1")


@query("cue_intervals", "SELECT user_id, event_id, start_ms, CASE WHEN nxt >= start_ms THEN nxt END AS end_ms, CASE WHEN nxt IS NULL THEN 'missing_end' WHEN nxt < start_ms THEN 'time_reversed' END AS timing_issue FROM (SELECT user_id, event_id, epoch_us(ts) // 1000 AS start_ms, lead(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY value, event_id) AS nxt FROM events)")
def _(t):
    cues = t("events").select("user_id", "event_id", "value", F.unix_millis(F.col("ts").cast("timestamp")).alias("start_ms"))
    return subtitles.with_intervals(cues, "user_id", ["value", "event_id"]).drop("value")


VISIBLE = "array_to_string(list_filter(list_transform(string_split(replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), chr(160), ' '), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t]+', ' ', 'g'), ' ' || chr(9) || chr(13))), lambda x: x <> ''), chr(10))"


@query("visible_text", f"SELECT page_id, {VISIBLE} AS visible FROM pages")
def _(t):
    return t("pages").select("page_id", subtitles.visible(subtitles.without_markup(F.col("html"))).alias("visible"))


@query("hangul_lines", "SELECT doc_id, array_to_string(list_filter(string_split(CASE WHEN doc_id % 3 = 0 THEN '가나 ' || text || chr(10) || 'x' ELSE text END, chr(10)), lambda x: regexp_matches(x, '[가-힣]')), chr(10)) AS lines FROM documents")
def _(t):
    return t("documents").select("doc_id", subtitles.hangul_lines(F.expr("CASE WHEN doc_id % 3 = 0 THEN '가나 ' || text || chr(10) || 'x' ELSE text END")).alias("lines"))


# Annotations: two segments a labelled document; some stale, some that leave a gap.
NOTES = "notes AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'stale' ELSE sha256(text) END AS text_sha256, length(text) AS len, CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS gap, CASE WHEN quality = 1 THEN 'gintoki' ELSE 'undetermined' END AS label, text FROM documents JOIN labels USING (doc_id))"


def notes(t) -> tuple[DataFrame, DataFrame]:
    cues = t("documents").select(F.col("doc_id").alias("subtitle_id"), F.col("text").alias("visible_text"), F.lit(False).alias("is_clear"), F.when(F.col("doc_id") % 11 == 0, "missing_end").alias("timing_issue"))
    made = cues.join(t("labels").withColumnRenamed("doc_id", "subtitle_id"), "subtitle_id")
    made = made.select("subtitle_id", F.expr("CASE WHEN subtitle_id % 5 = 0 THEN 'stale' ELSE sha2(visible_text, 256) END").alias("text_sha256"), F.expr("array(named_struct('start_char', 0L, 'end_char', 3L, 'label', CASE WHEN quality = 1 THEN 'gintoki' ELSE 'undetermined' END), named_struct('start_char', 3L + IF(subtitle_id % 7 = 0, 1L, 0L), 'end_char', CAST(length(visible_text) AS BIGINT), 'label', 'other'))").alias("segments"))
    return cues, made


@query("annotation_completeness", f"WITH {NOTES} SELECT d.doc_id AS subtitle_id, CASE WHEN n.doc_id IS NULL THEN 'missing' WHEN n.text_sha256 = 'stale' THEN 'stale' ELSE 'invalid' END AS reason FROM documents d LEFT JOIN notes n USING (doc_id) WHERE n.doc_id IS NULL OR n.text_sha256 = 'stale' OR gap = 1 OR len <= 3")
def _(t):
    return subtitles.incomplete(*notes(t))


@query("segment_validation", f"WITH {NOTES} SELECT doc_id AS subtitle_id, gap = 0 AND len > 3 AS valid FROM notes")
def _(t):
    cues, made = notes(t)
    return made.join(cues, "subtitle_id").select("subtitle_id", subtitles.segments_valid(F.col("visible_text"), F.col("segments")).alias("valid"))


CUT = norm_sql("CASE n WHEN 1 THEN substring(text, 1, 3) ELSE substring(text, 4 + gap, len - 3 - gap) END")


@query("export_segments", f"WITH {NOTES}, cut AS (SELECT doc_id, n, CASE n WHEN 1 THEN label ELSE 'other' END AS label, {CUT} AS text FROM notes, (VALUES (1), (2)) v(n)) SELECT doc_id AS subtitle_id, CAST(n AS BIGINT) AS n, text, CASE WHEN label <> 'gintoki' THEN 'excluded_' || label WHEN doc_id % 11 = 0 THEN 'invalid_timing' WHEN text = '' THEN 'empty_segment' ELSE 'target' END AS disposition FROM cut")
def _(t):
    return subtitles.export(*notes(t)).select("subtitle_id", F.col("n").cast("long").alias("n"), "text", "disposition")


@query("annotation_upsert", "SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(t):
    old = t("documents").select("doc_id", F.col("n_chars").alias("quality"))
    return subtitles.upsert(old, t("labels").select("doc_id", F.col("quality").cast("long").alias("quality")), "doc_id")


@query("dataset_version", """SELECT source, 'ds1-' || sha256('{"manifest_digest":"' || sha256(source) || '","parser_version":"p1","persona_config_digest":"c1","scheme":"ds1"}')[1:16] AS dataset_version FROM (SELECT DISTINCT source FROM documents)""")
def _(t):
    made = F.struct(F.sha2("source", 256).alias("manifest_digest"), F.lit("p1").alias("parser_version"), F.lit("c1").alias("persona_config_digest"), F.lit(digests.SCHEME).alias("scheme"))
    return t("documents").select("source").distinct().select("source", F.concat(F.lit("ds1-"), F.substring(F.sha2(F.to_json(made), 256), 1, 16)).alias("dataset_version"))


@query("corpus_version", """SELECT 'ds1corpus-' || sha256('{' || string_agg('"' || source || '":"' || v || '"', ',' ORDER BY source) || '}')[1:16] AS corpus_version FROM (SELECT source, CAST(count(*) AS VARCHAR) AS v FROM documents GROUP BY 1)""")
def _(t):
    rows = t("documents").groupBy("source").agg(F.count("*").cast("string").alias("v")).agg(F.array_sort(F.collect_list(F.struct("source", "v"))).alias("x"))
    return rows.select(F.concat(F.lit("ds1corpus-"), F.substring(F.sha2(F.to_json(F.map_from_entries("x")), 256), 1, 16)).alias("corpus_version"))


def page_rows(t) -> DataFrame:
    pages = t("pages").select(F.col("page_id").cast("string").alias("document_id"), "html")
    return wiki.with_review(wiki.paragraphs(pages, start_level=1, strict=False))


@query("wiki_paragraphs")
def _(t):
    return page_rows(t).withColumns({"heading_path": F.array_join("heading_path", " / "), "footnote_refs": F.array_join("footnote_refs", ","), "review_reasons": F.array_join("review_reasons", ",")})


@query("wiki_report")
def _(t):
    return wiki.report(page_rows(t).where("error is null"))


@query("wiki_markdown")
def _(t):
    body = page_rows(t).where("error is null and kind = 'body'")
    return paste.heading_lines(body).select("document_id", "seq", F.array_join(F.concat("headings", F.array("text")), "\n\n").alias("markdown"))


@query("review_markers", "SELECT doc_id, concat_ws(',', CASE WHEN contains(x, '[[') THEN 'wiki_link_residue' END, CASE WHEN contains(x, '{{{') THEN 'template_residue' END, CASE WHEN contains(x, '#!') THEN 'wiki_directive' END) AS reasons FROM (SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN '[[' || text WHEN 2 THEN text || '{{{ #!' ELSE text END AS x FROM documents)")
def _(t):
    rows = t("documents").withColumn("x", F.expr("CASE doc_id % 4 WHEN 1 THEN '[[' || text WHEN 2 THEN text || '{{{ #!' ELSE text END"))
    return rows.select("doc_id", F.array_join(wiki.review_reasons(F.col("x")), ",").alias("reasons"))


# Pages of a wiki: a paragraph a turn; users cite, assistants sometimes define, every tenth turn opens a section.
WIKI = "wiki AS (SELECT CAST(conv_id AS VARCHAR) AS document_id, CAST(turn AS BIGINT) AS seq, CASE WHEN role = 'assistant' THEN 'footnote' ELSE 'body' END AS kind, CASE WHEN role = 'user' THEN 'fn-' || (turn + conv_id) % 9 END AS ref, CASE WHEN role = 'assistant' AND turn % 3 <> 0 THEN 'fn-' || (turn + conv_id) % 11 END AS footnote_id, 'A' || turn // 4 AS h1, 'B' || turn // 2 AS h2 FROM conversations)"


def wiki_rows(t) -> DataFrame:
    rows = t("conversations").selectExpr("CAST(conv_id AS STRING) AS document_id", "CAST(turn AS BIGINT) AS seq", "CASE WHEN role = 'assistant' THEN 'footnote' ELSE 'body' END AS kind", "CASE WHEN role = 'user' THEN array('fn-' || (turn + conv_id) % 9) ELSE array() END AS footnote_refs", "CASE WHEN role = 'assistant' AND turn % 3 <> 0 THEN 'fn-' || (turn + conv_id) % 11 END AS footnote_id", "array('A' || turn div 4, 'B' || turn div 2) AS heading_path")
    return rows.withColumn("footnote_refs", F.col("footnote_refs").cast("array<string>"))


@query("unresolved_refs", f"WITH {WIKI} SELECT DISTINCT document_id, ref FROM wiki WHERE ref IS NOT NULL AND NOT EXISTS (SELECT 1 FROM wiki n WHERE n.document_id = wiki.document_id AND n.kind = 'footnote' AND n.footnote_id = wiki.ref)")
def _(t):
    return wiki.unresolved(wiki_rows(t))


@query("footnote_numbers", f"WITH {WIKI}, c AS (SELECT ref AS footnote_id, 0 AS late, min((document_id, seq)) AS spot FROM wiki WHERE kind <> 'footnote' AND ref IS NOT NULL GROUP BY 1), l AS (SELECT footnote_id, 1 AS late, min((document_id, seq)) AS spot FROM wiki WHERE kind = 'footnote' AND footnote_id IS NOT NULL AND footnote_id NOT IN (SELECT footnote_id FROM c) GROUP BY 1) SELECT footnote_id, row_number() OVER (ORDER BY late, spot) AS number FROM (SELECT * FROM c UNION ALL SELECT * FROM l)")
def _(t):
    return paste.footnote_numbers(wiki_rows(t), ["document_id", "seq"]).withColumn("number", F.col("number").cast("long"))


@query("heading_delta", f"WITH {WIKI}, b AS (SELECT *, lag(h1) OVER w AS p1, lag(h2) OVER w AS p2 FROM wiki WHERE kind = 'body' WINDOW w AS (PARTITION BY document_id ORDER BY seq)) SELECT document_id, seq, CASE WHEN p1 IS DISTINCT FROM h1 THEN '# ' || h1 || '|## ' || h2 WHEN p2 IS DISTINCT FROM h2 THEN '## ' || h2 ELSE '' END AS headings FROM b")
def _(t):
    return paste.heading_lines(wiki_rows(t).where("kind = 'body'")).select("document_id", "seq", F.array_join("headings", "|").alias("headings"))


@query("speech_lines", "SELECT conv_id, turn, role || ': ' || text AS line FROM conversations")
def _(t):
    return paste.speech_lines(t("conversations"), "role").select("conv_id", "turn", "line")


@query("screenplay_utterances")
def _(t):
    line = F.expr("repeat(' ', 24) || upper(role) || chr(10) || repeat(' ', 12) || regexp_replace(text, '[\\n]', ' ') || chr(10) || CASE WHEN turn % 3 = 2 THEN chr(12) ELSE '' END")
    rows = t("conversations").groupBy(F.col("conv_id").cast("string").alias("source_id")).agg(F.sort_array(F.collect_list(F.struct("turn", line.alias("x")))).alias("xs"))
    texts = rows.select("source_id", F.lit("user").alias("target"), F.array_join(F.transform("xs", lambda x: x["x"]), "").alias("text"))
    return screenplay.parse(texts, {k: (kind, p) for k, kind, p in ALIASES})


@query("canonical_jsonl", "SELECT conv_id, turn, to_json({'conv_id': conv_id, 'role': role, 'text': text, 'turn': turn})::VARCHAR AS line FROM conversations")
def _(t):
    return t("conversations").select("conv_id", "turn", json_column(["conv_id", "turn", "role", "text"]).alias("line"))
