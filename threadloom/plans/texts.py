"""Text queries. DuckDB's RE2 has no Unicode white space class; the data has none but ASCII blanks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as N
from ..functions import text as T
from ..registry import query

_NL = "replace(replace(replace(coalesce(content, ''), chr(65279), ''), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
_S = r"[\s\x{00a0}\x{2000}-\x{200a}\x{3000}]"


def _ws(x):
    lines = rf"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: regexp_replace(l, '{_S}+$', '')), chr(10))"
    return rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({lines}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_S}+', ''), '{_S}+$', '')"


def _noise(x):
    """Without the furniture that the test texts hold, written out: none of the library's lists is used here."""
    s = rf"regexp_replace(regexp_replace(l, '^{_S}+', ''), '{_S}+$', '')"
    return f"array_to_string(list_filter(string_split({x}, chr(10)), lambda l: NOT ({s} IN ('Add comment', 'Yes', 'No') OR lower({s}) = 'follow' OR regexp_matches({s}, '(?i)^[0-9]+\\s*votes$'))), chr(10))"


_COPY = rf"regexp_replace({_NL}, '(?mi)^{_S}*Copy{_S}*$', '', 'g')"
_HEADS = "'Additional resources', 'Training', 'Documentation', 'Module', 'Certification'"


def _foot(x):
    strip_l = rf"regexp_replace(regexp_replace(l, '^{_S}+', ''), '{_S}+$', '')"
    marks = f"list_transform(string_split({x}, chr(10)), lambda l: {strip_l} IN ({_HEADS}))"
    return f"CASE WHEN coalesce(list_position({marks}, true), 0) > 0 THEN array_to_string(list_slice(string_split({x}, chr(10)), 1, list_position({marks}, true) - 1), chr(10)) ELSE {x} END"


CLEAN = f"WITH a AS (SELECT question_id, {_COPY} AS x FROM raw_threads), b AS (SELECT question_id, {_noise('x')} AS x FROM a), c AS (SELECT question_id, {_foot('x')} AS x FROM b), cleaned AS (SELECT question_id, {_ws('replace(x, chr(9), chr(32))')} AS x FROM c) "


@query("t1_norm_newlines", f"SELECT question_id, {_NL} AS text FROM raw_threads")
def t1(t):
    return t.raw_threads.select("question_id", T.norm_newlines(F.col("content")).alias("text"))


@query("t2_normalize_ws", f"SELECT question_id, {_ws(_NL)} AS text FROM raw_threads")
def t2(t):
    return t.raw_threads.select("question_id", T.normalize_ws(F.col("content")).alias("text"))


@query("t3_copy_lines", f"SELECT question_id, {_COPY} AS text FROM raw_threads")
def t3(t):
    return t.raw_threads.select("question_id", T.drop_copy_lines(T.norm_newlines(F.col("content"))).alias("text"))


@query("t4_noise_lines", f"SELECT question_id, {_noise(_NL)} AS text FROM raw_threads")
def t4(t):
    return t.raw_threads.select("question_id", T.drop_noise_lines(T.norm_newlines(F.col("content"))).alias("text"))


@query("t5_footer_cut", f"SELECT question_id, {_foot(_NL)} AS text FROM raw_threads")
def t5(t):
    return t.raw_threads.select("question_id", T.cut_footer(T.norm_newlines(F.col("content"))).alias("text"))


@query("t6_clean_content", CLEAN + "SELECT question_id, x AS text FROM cleaned")
def t6(t):
    return t.raw_threads.select("question_id", T.clean_content(F.col("content")).alias("text"))


_SHORT = "left(x, 8000) || chr(10) || chr(10) || '--- TRUNCATED ---' || chr(10) || chr(10) || right(x, 3000)"


@query("t7_trim_for_llm", CLEAN + f"SELECT question_id, CASE WHEN length(x) <= 12000 THEN x ELSE {_ws('(' + _SHORT + ')')} END AS text FROM cleaned")
def t7(t):
    return t.raw_threads.select("question_id", T.trim_for_llm(T.clean_content(F.col("content"))).alias("text"))


@query("t8_content_hashes", CLEAN + "SELECT r.question_id, sha256(coalesce(content, '')) AS raw_hash, sha256(x) AS clean_hash FROM raw_threads r JOIN cleaned USING (question_id)")
def t8(t):
    return t.raw_threads.select("question_id", F.sha2(F.coalesce("content", F.lit("")), 256).alias("raw_hash"), F.sha2(T.clean_content(F.col("content")), 256).alias("clean_hash"))


@query("t9_parse_time", "SELECT event_id, epoch_us(ts)::BIGINT AS us FROM events")
def t9(t):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z"))
    return t.events.select("event_id", F.unix_micros(T.parse_utc(iso)).alias("us"))


@query("t23_norm_space", rf"SELECT question_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(content, ''), chr(13), chr(10)), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_S}+', ''), '{_S}+$', '') AS text FROM raw_threads")
def t23(t):
    return t.raw_threads.select("question_id", T.norm_space(F.col("content")).alias("text"))


_SLUG = "regexp_replace(regexp_replace(lower(trim(coalesce({x}, ''))), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("t24_slug", f"SELECT nugget_id, CASE WHEN left({_SLUG.format(x='s')}, 80) = '' THEN 'untitled' ELSE left({_SLUG.format(x='s')}, 80) END AS slug FROM (SELECT nugget_id, CASE WHEN cluster_ref = 'x' THEN '!! ' ELSE title || ' / ' || product || ' ' || repeat(title, 6) END AS s FROM nuggets)")
def t24(t):
    s = F.when(F.col("cluster_ref") == "x", F.lit("!! ")).otherwise(F.concat("title", F.lit(" / "), "product", F.lit(" "), F.repeat("title", F.lit(6))))
    return t.nuggets.select("nugget_id", N.slug(s).alias("slug"))


_P = r"CASE WHEN starts_with(z, '/') THEN z ELSE '/' || z END"


@query("t25_single_slashes", rf"SELECT page_id, CASE WHEN length(w) > 1 THEN regexp_replace(w, '/$', '') ELSE w END AS path FROM (SELECT page_id, {_P} AS w FROM (SELECT page_id, regexp_replace(replace(trim(url || '\' || 'a//b/'), '\', '/'), '/+', '/', 'g') AS z FROM pages))")
def t25(t):
    return t.pages.select("page_id", N.single_slashes(F.concat("url", F.lit("\\"), F.lit("a//b/"))).alias("path"))


@query("t26_fit_path", r"""WITH p AS (SELECT nugget_id, '/kb/' || repeat(replace(title, ' ', '-'), cast(cast(substr(nugget_id, 2) AS BIGINT) % 5 AS INT)) || '/' || repeat(replace(title, ' ', '-') || '--', 30) AS x FROM nuggets),
q AS (SELECT nugget_id, replace(x, '//', '/') AS x FROM p), s AS (SELECT nugget_id, x, regexp_extract(x, '[^/]*$') AS l, regexp_replace(x, '[^/]*$', '') AS pre FROM q),
c AS (SELECT *, 235 - length(pre) AS room, regexp_replace(left(l, least(235 - length(pre), 80)), '-+$', '') AS cut FROM s)
SELECT nugget_id, CASE WHEN length(x) <= 235 THEN x WHEN room <= 0 THEN '/' || left(sha1(x), 16) WHEN cut <> '' THEN pre || cut ELSE pre || left('p-' || left(sha1(x), 16), room) END AS path FROM c""")
def t26(t):
    dashed = F.replace("title", F.lit(" "), F.lit("-"))
    n = (F.substring("nugget_id", 2, 9).cast("long") % 5).cast("int")
    path = F.concat(F.lit("/kb/"), F.repeat(dashed, n), F.lit("/"), F.repeat(F.concat(dashed, F.lit("--")), F.lit(30)))
    return t.nuggets.select("nugget_id", N.fit_path(path).alias("path"))


@query("t27_safe_casts", "SELECT nugget_id, coalesce(try_cast(cluster_ref AS BIGINT), -1) AS ref, greatest(0.1::DOUBLE, least(0.3::DOUBLE, score::DOUBLE)) AS score FROM nuggets")
def t27(t):
    return t.nuggets.select("nugget_id", F.coalesce(F.expr("try_cast(cluster_ref as bigint)"), F.lit(-1)).alias("ref"), T.clamp(F.col("score").cast("double"), 0.1, 0.3).alias("score"))


@query("t28_token_estimate", "SELECT doc_id, greatest(1, ceil(length(text) / 4))::BIGINT AS tokens FROM documents")
def t28(t):
    return t.documents.select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query("t31_truncate", "SELECT doc_id, left(nullif(trim(text), ''), 30) AS short, CASE WHEN length(text) <= 500 THEN text ELSE left(text, 500) || '(+' || (length(text) - 500) || ' chars)' END AS logged FROM documents")
def t31(t):
    return t.documents.select("doc_id", T.shorten(F.col("text"), 30).alias("short"), T.log_shorten(F.col("text"), 500).alias("logged"))


@query("t33_markdown_list", "SELECT cluster_id, '1. ' || trim(regexp_extract(steps, '\"([^\"]*)\"', 1)) || chr(10) || '3. ' || trim(regexp_extract(steps, ',\"\",\"([^\"]*)\"', 1)) AS md FROM solutions")
def t33(t):
    items = F.from_json("steps", "array<string>")
    return t.solutions.select("cluster_id", T.markdown_list(items, ordered=True).alias("md"))


@query("t39_search_text", "SELECT cluster_id, trim(product || ' ' || coalesce(signature_text, '') || ' ' || coalesce(resolution_text, '')) AS q FROM catalog WHERE cluster_level = 4")
def t39(t):
    q = F.trim(F.concat("product", F.lit(" "), F.coalesce("signature_text", F.lit("")), F.lit(" "), F.coalesce("resolution_text", F.lit(""))))
    return t.catalog.where("cluster_level = 4").select("cluster_id", q.alias("q"))


@query("t40_heading", "SELECT doc_id, CASE WHEN length(trim(text)) >= 40 THEN CASE WHEN starts_with(trim(text), '# ') THEN trim(text) ELSE '# ' || source || chr(10) || chr(10) || trim(text) END END AS page FROM documents")
def t40(t):
    return t.documents.select("doc_id", T.with_heading(F.col("text"), F.col("source")).alias("page"))
