"""HTML and context queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..operators import rollup as R
from ..operators import selection as K
from ..registry import query

_S = r"[\s\x{00a0}\x{2000}-\x{200a}\x{3000}]"


#: What the rules of character references give, written out for those of the test pages and of _MORE.
_REFS = [("&#8217;", "\u2019"), ("&#x27;", "''"), ("&rsquo;", "\u2019"), ("&rdquo;", "\u201d"), ("&hellip;", "\u2026"), ("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&eacute", "\u00e9"), ("&nbsp;", "\u00a0"), ("&notanentity;", "\u00acanentity;"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")]
#: Markup that no test page has: references of all kinds, elements that end lines on one kind of page only, and line ends.
_MORE = "html || '<ul><li>a&#8217;b</li></ul>u<pre>c&rsquo;&rdquo;</pre>v<article>d&#x27;e</article>w<table><tr><td>x&nbsp;y</td></tr></table>' || chr(13) || chr(10) || '<aside>z &hellip; &notanentity; &amp;lt; &eacute</aside>q<br/>r<br />s<blockquote>t</blockquote><section>o</section>p'"


def _unescape(x):
    for k, v in _REFS:
        x = f"replace({x}, '{k}', '{v}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"  # some pages cut the reference off


_GONE = r"regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '{0}', 'g'), '(?is)<style[^>]*>.*?</style>', '{0}', 'g')"


def _squeezed(x):
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g'), '^{_S}+', ''), '{_S}+$', '')"


def _thread(x):
    t = rf"regexp_replace(regexp_replace({_GONE.format('')}, '(?i)<br\s*/?>', chr(10), 'g'), '(?i)</(p|div|li|tr|h1|h2|h3|h4|h5|h6|blockquote)>', chr(10), 'g')".replace("html", x, 1)
    return _squeezed("regexp_replace(" + _unescape(f"regexp_replace({t}, '<[^>]+>', ' ', 'g')") + r", '[ \t]+', ' ', 'g')")


def _doc(x):
    t = rf"regexp_replace({_GONE.format(' ')}, '(?i)</?(p|div|li|tr|h1|h2|h3|h4|h5|h6|br|blockquote|pre|section|article|aside)(\s[^>]*)?>', chr(10), 'g')".replace("html", x, 1)
    return _squeezed(r"regexp_replace(regexp_replace(" + _unescape(f"regexp_replace({t}, '<[^>]+>', ' ', 'g')") + r", '[ \t]+', ' ', 'g'), '\n[ \t]+', chr(10), 'g')")


@query("t10_strip_html", f"SELECT page_id, {_thread('(' + _MORE + ')')} AS text FROM pages")
def t10(t):
    return t.pages.select("page_id", T.strip_html(F.expr(_MORE)).alias("text"))


@query("t11_strip_doc_html", f"SELECT page_id, {_doc('(' + _MORE + ')')} AS text FROM pages")
def t11(t):
    return t.pages.select("page_id", T.strip_doc_html(F.expr(_MORE)).alias("text"))


_LD = "html || '<script type=\"application/ld+json\">{broken</script><script type=\"application/ld+json\">{\"@type\":\"Other\"}</script>' || CASE WHEN page_id % 2 = 0 THEN '<script type=\"application/ld+json\">{\"@type\":\"QAPage\",\"n\":' || cast(page_id AS STRING) || '}</script>' ELSE '' END"


@query("t12_ld_json_pick", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '{\"@type\":\"QAPage\",\"n\":' || page_id || '}' END AS ld FROM pages")
def t12(t):
    return t.pages.select("page_id", H.pick_ld_json(F.expr(_LD)).alias("ld"))


# By page_id modulo 4: no JSON-LD; everything given, the author as an object; dates of answers only, the author as text; no date but one in the markup.
_QA = """CASE page_id % 4 WHEN 0 THEN html
WHEN 1 THEN html || '<script nonce="n" type="application/ld+json">{"@type":"QAPage","mainEntity":{"name":" Title ' || cast(page_id AS STRING) || ' ","text":"<p>q &amp; a</p><ul>x</ul>y","author":{"name":" Ann "},"dateCreated":"2024-01-02T03:04:05.1234567Z","acceptedAnswer":[{"text":"yes<br>no","updatedAt":"2023-01-01"}],"suggestedAnswer":[{"text":" "},{"text":"<b>more</b>"}]}}</script>'
WHEN 2 THEN html || '<script type="application/ld+json">{"@type":"QAPage","mainEntity":{"text":"only","author":"Bob","dateCreated":"nope","acceptedAnswer":[{"text":"a1","updatedAt":"2024-03-01T00:00:00Z"}],"suggestedAnswer":[{"text":"a2","dateCreated":"2024-02-01"}]}}</script>'
ELSE html || '<local-time class="d" datetime="2024-05-06T07:08:09Z"></local-time><script type="application/ld+json">{"@type":"QAPage","mainEntity":{"name":"N","text":""}}</script>' END"""


@query("t13_question_scrape", rf"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN {_unescape("trim(regexp_extract(html, '(?i)<h1[^>]*>([^<]+)</h1>', 1))")} WHEN 1 THEN 'Title ' || page_id WHEN 2 THEN '' ELSE 'N' END AS title,
CASE page_id % 4 WHEN 1 THEN 'Ann' WHEN 2 THEN 'Bob' ELSE '' END AS author, CASE page_id % 4 WHEN 1 THEN '2024-01-02T03:04:05.1234567Z' WHEN 2 THEN '2024-02-01' WHEN 3 THEN '2024-05-06T07:08:09Z' END AS asked,
CASE page_id % 4 WHEN 0 THEN {_thread("regexp_extract(html, '(?s)</h1>(.*?)<footer', 1)")} WHEN 1 THEN 'q & a' || chr(10) || ' x y' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'yes' || chr(10) || 'no' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'more'
WHEN 2 THEN 'only' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'a1' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'a2' ELSE '' END AS body FROM pages""")
def t13(t):
    return H.scrape_question(t.pages.select("page_id", F.expr(_QA).alias("html"))).select("page_id", "title", "author", "asked", "body")


@query("t14_link_extract", r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a, generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), 1) - 1 AS pos FROM pages),
b AS (SELECT page_id, pos, regexp_extract(a, '(?i)href="([^"]*)"', 1) AS href FROM a)
SELECT page_id, CASE WHEN starts_with(href, '/') THEN 'https://site' || href ELSE href END AS href, min(pos)::INT AS pos FROM b WHERE regexp_matches(href, '^/[A-Za-z]') GROUP BY ALL""")
def t14(t):
    return H.page_links(t.pages, "page_id", "html", "^/[A-Za-z]", F.lit("https://site")).select("page_id", "href", "pos")


_PAGED = """url || html || CASE WHEN page_id % 3 = 0 THEN '<a class="x pagination-link" href="#">' || cast(page_id % 50 AS STRING) || '</a><A CLASS="pagination-link current">' || chr(10) || ' 7 </A><a class="page">99</a>' WHEN page_id % 3 = 1 THEN '<i>x&amp;page=98</i>' ELSE '' END"""


@query("t15_last_page", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN greatest(page_id % 50, 7) ELSE coalesce(list_max(list_transform(regexp_extract_all(url || html, '[?&]page=([0-9]{1,9})', 1), lambda x: x::INT)), 1) END::INT AS pages FROM pages")
def t15(t):
    return t.pages.select("page_id", H.last_page(F.expr(_PAGED)).alias("pages"))


_URLS = "CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN b || '?b=1#f' WHEN 2 THEN b || '?page=3&a=x%20y*&e&a=2&c=' ELSE b || '?q=a+b~&page=9&z=ä&page=8#top?x' END"


@query("t16_page_url", """WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS b, regexp_extract(url, '[?]([^#]*)', 1) AS q, regexp_extract(url, '#(.+)$', 1) AS f, 'page=' || (page_id % 7) AS n FROM pages)
SELECT page_id, b || '?' || CASE page_id % 4 WHEN 0 THEN CASE WHEN q = '' THEN n WHEN regexp_matches(q, '(^|&)page=') THEN regexp_replace(q, '(^|&)page=[^&]*', '\\1' || n) ELSE q || '&' || n END || CASE WHEN f <> '' THEN '#' || f ELSE '' END
WHEN 1 THEN 'b=1&' || n || '#f' WHEN 2 THEN n || '&a=x+y%2A&a=2' ELSE 'q=a+b~&' || n || '&z=%C3%A4#top?x' END AS url FROM u""")
def t16(t):
    url = t.pages.withColumn("b", F.regexp_replace("url", "[?#].*$", "")).select("page_id", F.expr(_URLS).alias("url"))
    return url.select("page_id", H.page_url(F.col("url"), F.col("page_id") % 7).alias("url"))


@query("t18_nested_div", """WITH p AS (SELECT page_id, '<div>a</div>' || html || CASE page_id % 3 WHEN 0 THEN '</div>tail</div>' WHEN 1 THEN '<div>' ELSE '' END AS r FROM pages),
t AS (SELECT page_id, r, regexp_extract_all(r, '<div|</div>') AS k, string_split_regex(r, '<div|</div>') AS s FROM p),
u AS (SELECT page_id, i, k[i] AS tag, length(s[i]) + length(k[i]) AS n FROM t, unnest(range(1, len(k) + 1)) AS x(i)),
d AS (SELECT page_id, 1 + sum(CASE WHEN tag = '<div' THEN 1 ELSE -1 END) OVER w AS depth, sum(n) OVER w AS upto FROM u WINDOW w AS (PARTITION BY page_id ORDER BY i))
SELECT page_id, left(r, coalesce((SELECT min(upto) FROM d WHERE d.page_id = p.page_id AND depth = 0), length(r))::BIGINT) AS inner FROM p""")
def t18(t):
    end = F.expr("CASE page_id % 3 WHEN 0 THEN '</div>tail</div>' WHEN 1 THEN '<div>' ELSE '' END")
    page = F.concat(F.lit('<p>id="y"</p><section id="x"><div>a</div>'), "html", end)
    return t.pages.select("page_id", H.nested_div(page, "id", "x").alias("inner"))


@query("t19_doc_title_body", f"""WITH x AS (SELECT page_id, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h1,
 CASE WHEN page_id % 2 = 0 THEN '<h1>' || regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) || '</h1><p>3 minutes to read</p><div>In this article</div> <p>one</p><p>Feedback</p>' ELSE regexp_extract(html, '(?is)<h1[^>]*>.*?</h1>(.*?)<footer', 1) END AS part FROM pages),
y AS (SELECT page_id, {_doc('h1')} AS title, string_split({_doc('part')}, chr(10)) AS l FROM x),
z AS (SELECT page_id, title, l, coalesce(list_position(list_transform(l, lambda v: lower(trim(v)) = lower(title)), true), 0) AS at_line FROM y)
SELECT page_id, title, {_squeezed("array_to_string(list_filter(list_transform(CASE WHEN at_line > 0 AND title <> '' THEN list_slice(l, at_line + 1, len(l)) ELSE l END, lambda v: trim(v)), lambda v: v NOT IN ('In this article', 'Feedback') AND NOT regexp_matches(v, '^[0-9]+ minutes to read$')), chr(10))")} AS body FROM z""")
def t19(t):
    inner = F.expr("""'<div class="c" data-bi-name="content"><h1>' || regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) || '</h1><p>3 minutes to read</p><div>In this article</div> <p>one</p><p>Feedback</p></div>'""")
    page = F.when(F.col("page_id") % 2 == 0, F.concat("html", inner)).otherwise(F.col("html"))
    return H.doc_title_body(t.pages.select("page_id", page.alias("html"))).select("page_id", "title", "body")


@query("t14_link_dates", r"""WITH h AS (SELECT page_id, '<a class="q" href="/q/' || page_id || '">x</a>' || repeat('.', (page_id % 3) * 3000) || '<local-time datetime="2024-01-0' || (1 + page_id % 9) || '">' AS html FROM pages) SELECT page_id, '/q/' || page_id AS href, CASE WHEN page_id % 3 < 2 THEN '2024-01-0' || (1 + page_id % 9) END AS asked FROM h""")
def t14b(t):
    html = F.expr("concat('<a class=\"q\" href=\"/q/', page_id, '\">x</a>', repeat('.', cast(page_id % 3 as int) * 3000), '<local-time datetime=\"2024-01-0', 1 + page_id % 9, '\">')")
    return H.link_dates(t.pages.select("page_id", html.alias("html")), "page_id", "html", "^/q/")


_TOC = """CASE p_partkey % 7 WHEN 0 THEN '[{"href":"a' || cast(p_partkey AS STRING) || '","toc_title":"A","children":[{"href":"../b","toc_title":"B"}],"items":[{"items":[{"href":"/c?x=1","toc_title":"C"}]}]},{"href":"http://off","toc_title":"D"}]'
WHEN 1 THEN '{"children":{"children":{"children":[[{"href":"x/./y/../z","toc_title":"Z"}],{"href":""},5,null,"s"]}}}' WHEN 2 THEN 'not json' WHEN 4 THEN '[]'
WHEN 5 THEN '[{"href":"../../../../up/","items":[{"href":"mailto:a@b"},{"href":"a//b/.."}]}]' WHEN 6 THEN '{"items":[{"href":"i"}],"href":"self","children":[[[{"items":{"items":{"items":{"items":{"href":"deep"}}}}}]],{"href":"k"}]}' END"""
_ENTRIES = """(VALUES (0, 0, 'a', 'A', 'base/dir/a'), (0, 1, '../b', 'B', 'base/b'), (0, 2, '/c?x=1', 'C', 'c'), (0, 3, 'http://off', 'D', NULL), (1, 0, 'x/./y/../z', 'Z', 'base/dir/x/z'),
(5, 0, '../../../../up/', '', 'up/'), (5, 1, 'mailto:a@b', '', 'mailto:a@b'), (5, 2, 'a//b/..', '', 'base/dir/a/'), (6, 0, 'self', '', 'base/dir/self'), (6, 1, 'deep', '', 'base/dir/deep'), (6, 2, 'k', '', 'base/dir/k'), (6, 3, 'i', '', 'base/dir/i')) e(m, pos, href, title, url)"""
_OWN = "CASE WHEN m = 0 AND pos = 0 THEN p_partkey::VARCHAR ELSE '' END"


@query("t20_toc_flatten", f"SELECT p_partkey, pos::INT AS pos, href || {_OWN} AS href, title FROM part, {_ENTRIES} WHERE p_partkey % 7 = m")
def t20(t):
    return H.flatten_toc(t.part.select("p_partkey", F.expr(_TOC).alias("toc"))).select("p_partkey", "pos", "href", "title")


@query("t21_resolve_href", f"SELECT p_partkey, pos::INT AS pos, CASE WHEN starts_with(url, 'mailto:') THEN url ELSE 'https://docs.site/' || url || {_OWN} END AS url FROM part, {_ENTRIES} WHERE p_partkey % 7 = m")
def t21(t):
    rows = H.flatten_toc(t.part.select("p_partkey", F.expr(_TOC).alias("toc")))
    return rows.select("p_partkey", "pos", H.resolve_href(F.col("href"), "https://docs.site/base/dir", "https://docs.site").alias("url"))


@query("t22_ordered_urls", "SELECT url, (row_number() OVER (ORDER BY pos, url))::INT AS \"order\" FROM (SELECT regexp_replace(url, '[?].*$', '') AS url, min(page_id) AS pos FROM pages GROUP BY 1) ORDER BY pos, url LIMIT 40")
def t22(t):
    rows = t.pages.select(F.regexp_replace("url", "[?].*$", "").alias("url"), F.col("page_id").alias("pos"), F.lit("").alias("title"))
    return H.ordered_urls(rows, 40).select("url", "order")


@query("t32_wiki_links", """WITH m AS (SELECT cluster_key, max(cluster_id) AS id, arg_max(wiki_path, cluster_id) AS path FROM catalog WHERE is_active AND wiki_path IS NOT NULL GROUP BY 1)
SELECT c.cluster_id, 'see ' || CASE WHEN m.path IS NOT NULL THEN '[' || c.cluster_key || '](' || replace(replace(m.path, ' ', '%20'), '#', '%23') || ')' ELSE c.cluster_key END || ' and ' || CASE WHEN m.path IS NOT NULL THEN '[More](' || replace(replace(m.path, ' ', '%20'), '#', '%23') || ')' ELSE 'More' END || '.' AS text
FROM catalog c LEFT JOIN m USING (cluster_key) WHERE c.cluster_level <= 3""")
def t32(t):
    from ..operators.context import resolve_wiki_links

    rows = t.catalog.where("cluster_level <= 3").select("cluster_id", F.concat(F.lit("see [["), "cluster_key", F.lit("]] and [[More|"), "cluster_key", F.lit("]].")).alias("text"))
    return resolve_wiki_links(rows, t.catalog)


@query("t34_playbook", "SELECT cluster_id, '# ' || title || chr(10) || chr(10) || '## Problem' || chr(10) || problem || chr(10) || chr(10) || '## Resolution' || chr(10) || '1. ' || trim(regexp_extract(steps, '\"([^\"]*)\"', 1)) || chr(10) || '3. ' || trim(regexp_extract(steps, ',\"\",\"([^\"]*)\"', 1)) || chr(10) || chr(10) || '## Validation' || chr(10) || '- none given' AS page FROM solutions")
def t34(t):
    from ..operators.context import playbook

    return t.solutions.select("cluster_id", playbook(F.col("title"), F.col("problem"), F.from_json("steps", "array<string>"), F.array().cast("array<string>")).alias("page"))


@query("t35_context_blocks", """SELECT leaf_id, string_agg(rn || '. ' || left(thread_id, 12) || ' (' || printf('%.2f', usefulness::DOUBLE) || ')', chr(10) ORDER BY rn) AS block FROM (SELECT leaf_id, thread_id, coalesce(usefulness, 0) AS usefulness, row_number() OVER (PARTITION BY leaf_id ORDER BY usefulness DESC NULLS LAST, created_on DESC, thread_id) AS rn FROM threads WHERE leaf_id IS NOT NULL) WHERE rn <= 4 GROUP BY 1""")
def t35(t):
    top = K.top_threads(t.threads, "leaf_id", 4)
    line = F.format_string("%d. %s (%.2f)", "rn", F.substring("thread_id", 1, 12), F.coalesce(F.col("usefulness").cast("double"), F.lit(0.0)))
    rows = top.groupBy("leaf_id").agg(F.sort_array(F.collect_list(F.struct("rn", line.alias("l")))).alias("x"))
    return rows.select("leaf_id", F.array_join(F.transform("x", lambda v: v["l"]), "\n").alias("block"))


@query("t36_prompt_payload", "SELECT cluster_id, '{\"id\":' || cluster_id || ',\"key\":\"' || left(cluster_key, 8) || '\"}' AS payload FROM catalog WHERE cluster_level <= 2")
def t36(t):
    return t.catalog.where("cluster_level <= 2").select("cluster_id", F.to_json(F.struct(F.col("cluster_id").alias("id"), F.substring("cluster_key", 1, 8).alias("key"))).alias("payload"))


@query("t38_problem_bundle", "SELECT parent_id, string_agg('- ' || cluster_key, chr(10) ORDER BY rn) AS problem FROM (SELECT parent_id, cluster_key, row_number() OVER (PARTITION BY parent_id ORDER BY cluster_id) AS rn FROM catalog WHERE cluster_level = 3 AND is_active) WHERE rn <= 10 GROUP BY 1")
def t38(t):
    rows = R.top_n(t.catalog.where("cluster_level = 3 and is_active"), ["parent_id"], [F.col("cluster_id")], 10)
    x = rows.groupBy("parent_id").agg(F.sort_array(F.collect_list(F.struct("rn", "cluster_key"))).alias("x"))
    return x.select("parent_id", F.array_join(F.transform("x", lambda v: F.concat(F.lit("- "), v["cluster_key"])), "\n").alias("problem"))


@query("s8_document_search", r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM documents), f AS (SELECT doc_id, w, count(*) AS tf FROM w WHERE w IN ('the', 'license', 'apache') GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS len FROM w GROUP BY 1), a AS (SELECT count(*) AS docs, avg(len) AS mean FROM n), d AS (SELECT w, count(*) AS df FROM f GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6)::DOUBLE AS score FROM f JOIN d USING (w) JOIN n USING (doc_id), a GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""")
def s8(t):
    from ..sources.search import search

    return search(t.documents.select("doc_id", "text"), "the Apache license", 10).select("doc_id", "score")


_SIG = "CASE WHEN usefulness > 0.9 THEN repeat(coalesce(signature_text, '?'), 90) ELSE signature_text END"
_RES = "CASE WHEN usefulness > 0.8 THEN repeat(leaf_key || ' ', 80) END"


@query("t36_batch_payloads", f"""SELECT product, page, to_json(struct_pack(product := product, threads := list(struct_pack(thread_id := thread_id, signature_text := left(coalesce(s, ''), 600), resolution_text := left(coalesce(r, ''), 400), topic_hint := coalesce(topic_key, '')) ORDER BY rn)))::VARCHAR AS payload
FROM (SELECT *, {_SIG} AS s, {_RES} AS r, row_number() OVER (PARTITION BY product ORDER BY created_on DESC, thread_id) AS rn, (row_number() OVER (PARTITION BY product ORDER BY created_on DESC, thread_id) - 1) // 25 AS page FROM threads WHERE is_emergent AND product IS NOT NULL) GROUP BY product, page""")
def t36_batches(t):
    from ..operators.prompts import batch_payloads

    rows = t.threads.where("is_emergent and product is not null").select("thread_id", "product", "created_on", "topic_key", F.expr(_SIG).alias("signature_text"), F.expr(_RES).alias("resolution_text"))
    return batch_payloads(rows, "emergent_assign", [F.desc("created_on"), "thread_id"], 25, {"topic_hint": F.coalesce("topic_key", F.lit(""))})


@query("t35_leaf_blocks", """SELECT cluster_id, 'LEAF ' || rn || ': ' || cluster_key || CASE WHEN wiki_path IS NULL THEN ' [not on the wiki]' ELSE ' [on the wiki]' END || chr(10) || '  Signature: ' || left(coalesce(signature_text, ''), 200) || chr(10) || '  Fix: ' || left(coalesce(resolution_text, ''), 200) || chr(10) || '  Members: ' || member_count || chr(10)
|| '  Playbook: ' || title || chr(10) || '  Symptoms: ' || left(repeat(problem || ' ', 20), 120) || '; ' || problem || chr(10) || '  Solution: ' || regexp_extract(steps, '"([^"]*)"', 1) || '; ; ' || regexp_extract(steps, ',"","([^"]*)"', 1) || chr(10) AS block
FROM (SELECT c.*, s.title, s.problem, s.steps, row_number() OVER (PARTITION BY parent_id ORDER BY member_count DESC, c.cluster_id) AS rn FROM catalog c JOIN solutions s USING (cluster_id) WHERE c.is_active)""")
def t35_leaves(t):
    from ..operators.prompts import leaf_block

    rows = t.catalog.where("is_active").join(t.solutions, "cluster_id")
    ranked = R.top_n(rows, ["parent_id"], [F.desc("member_count"), F.col("cluster_id")], 1_000_000)
    symptoms = F.array(F.repeat(F.concat("problem", F.lit(" ")), F.lit(20)), "problem")
    return ranked.select("cluster_id", leaf_block(F.col("rn"), symptoms, F.array().cast("array<string>"), F.from_json("steps", "array<string>")).alias("block"))


@query("t38_diagnostic_bundle", """WITH l AS (SELECT cluster_id, problem AS p, [regexp_extract(steps, '"([^"]*)"', 1), '', regexp_extract(steps, ',"","([^"]*)"', 1)] AS a FROM solutions),
h AS (SELECT leaf_id, thread_id, row_number() OVER (PARTITION BY leaf_id ORDER BY usefulness DESC NULLS LAST, created_on DESC, thread_id) AS rn FROM threads WHERE leaf_id IS NOT NULL),
s AS (SELECT leaf_id AS cluster_id, list(struct_pack(thread_id := thread_id, source_url := 'https://q.site/' || thread_id) ORDER BY rn) AS src FROM h WHERE rn <= 4 GROUP BY 1)
SELECT cluster_id, 'Symptoms:' || chr(10) || '- ' || p || chr(10) || chr(10) || 'Checks:' || chr(10) || '- ' || array_to_string(a, chr(10) || '- ') || chr(10) AS problem,
to_json(struct_pack(symptoms := [p], anti_symptoms := []::VARCHAR[], checks := a, solution := a, verification := []::VARCHAR[], flows := []::VARCHAR[], notes := []::VARCHAR[], source_threads := src, docs := []::VARCHAR[]))::VARCHAR AS bundle FROM l JOIN s USING (cluster_id)""")
def t38_bundle(t):
    from ..operators.prompts import diagnostic_bundle, problem_text

    top = K.top_threads(t.threads, "leaf_id", 4)
    entry = F.struct("rn", F.struct("thread_id", F.concat(F.lit("https://q.site/"), "thread_id").alias("source_url")).alias("t"))
    threads = top.groupBy(F.col("leaf_id").alias("cluster_id")).agg(F.sort_array(F.collect_list(entry)).alias("x"))
    rows = t.solutions.select("cluster_id", F.array("problem").alias("symptoms"), F.from_json("steps", "array<string>").alias("steps")).join(threads, "cluster_id")
    lists = {"symptoms": F.col("symptoms"), "checks": F.col("steps"), "solution": F.col("steps")}
    return rows.select("cluster_id", problem_text(F.col("symptoms"), F.col("steps")).alias("problem"), diagnostic_bundle(lists, F.transform("x", lambda v: v["t"]), F.array().cast("array<string>")).alias("bundle"))


_INDEXED = r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM documents), f AS (SELECT doc_id, w, count(*) AS tf FROM w WHERE w IN ('the', 'license', 'apache') GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS len FROM w GROUP BY 1), a AS (SELECT count(*) AS docs, avg(len) AS mean FROM n), d AS (SELECT w, count(*) AS df FROM f GROUP BY 1)
SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6)::DOUBLE AS score, 'https://docs.site/' || source || '/' || doc_id AS url
FROM f JOIN d USING (w) JOIN n USING (doc_id) JOIN documents USING (doc_id), a WHERE lang = 'de' GROUP BY doc_id, source ORDER BY score DESC, doc_id LIMIT 10"""


@query("s8_index_search", _INDEXED)
def s8_index(t):
    from ..sources.scratch import new_folder
    from ..sources.search_index import SearchIndex

    docs = t.documents.select("doc_id", F.col("lang").alias("product"), F.concat(F.lit("https://docs.site/"), "source", F.lit("/"), "doc_id").alias("url"), "text")
    index = SearchIndex(t.spark, new_folder(t.spark, "index"))
    index.extend(docs.where("product = 'en'"))
    index.extend(docs.where("product <> 'en' or product is null"))
    return index.search("the Apache license", 10, "de").select("doc_id", "score", "url")


@query("s2_schema_patch", "SELECT 'qa' || doc_id AS question_id, source AS asker FROM documents")
def s2(t):
    from ..sources.raw import patch_columns

    rows = t.documents.select(F.concat(F.lit("qa"), F.col("doc_id").cast("string")).alias("question_id"), F.col("source").alias("asker"))
    return patch_columns(rows, {"question_id": "", "created_at": None}).select("question_id", "asker")


@query("s4a_toc_locations", "SELECT page_id, i::INT AS turn, '/' || array_to_string(list_slice(p, 1, len(p) - i), '/') || '/toc.json' AS path FROM (SELECT page_id, list_filter(string_split(regexp_replace(url, '^https?://[^/]*|[?].*$', '', 'g'), '/'), lambda x: x <> '') AS p FROM pages), range(0, 9) r(i) WHERE i < len(p)")
def s4a(t):
    from ..sources.raw import toc_locations

    return toc_locations(t.pages, "page_id", "url")


@query("s1_prefix_scan", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s1(t):
    from ..sources.raw import scan_prefix

    return scan_prefix(t.spark, f"{t.sf_dir}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))


@query("s5_csv_sink", "SELECT cluster_id, title, problem FROM solutions")
def s5(t):
    from ..sources.raw import csv_round_trip

    return csv_round_trip(t.solutions, ["cluster_id", "title", "problem"], "cluster_id long, title string, problem string")


@query("s5_document_sheet", """SELECT page_id AS "Order", 'p' || (page_id % 3) AS "Product", url AS "URL", 'a "b", ' || page_id AS "Title", url || chr(10) || 'é' AS "Body", true AS marked FROM pages""")
def s5_sheet(t):
    from ..sources.raw import DOCUMENT_SHEET, write_document_sheet
    from ..sources.scratch import new_folder

    rows = t.pages.select(F.col("page_id").alias("Order"), F.concat(F.lit("p"), F.col("page_id") % 3).alias("Product"), F.col("url").alias("URL"), F.concat(F.lit('a "b", '), "page_id").alias("Title"), F.concat("url", F.lit("\né")).alias("Body"))
    path = new_folder(t.spark, "sheet")
    write_document_sheet(rows, path)
    schema = ", ".join(f"{c} {'long' if c == 'Order' else 'string'}" for c in DOCUMENT_SHEET)
    back = t.spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).option("enforceSchema", True).csv(path)
    marks = t.spark.read.format("binaryFile").load(path).agg(F.bool_and(F.substring("content", 1, 3) == F.lit(b"\xef\xbb\xbf")).alias("marked"))
    return back.crossJoin(F.broadcast(marks))  # one row


@query("s9_wiki_upsert", "SELECT '/kb' AS path, true AS stub UNION ALL SELECT DISTINCT wiki_path, false FROM catalog WHERE wiki_path IS NOT NULL")
def s9(t):
    from ..sources.wiki import upsert_plan

    return upsert_plan(t.catalog.where("wiki_path is not null").select(F.col("wiki_path").alias("path"), F.lit("x").alias("content"))).select("path", "stub").distinct()
