"""Extraction from pages, listings and tables of contents."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import norm_space, once, parse_utc, strip, strip_doc_html, strip_html, unescape

LD_JSON = r"(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
_ANSWER = "array<struct<text string, updatedAt string, dateCreated string>>"


def pick_ld_json(page: Column, kind: str = "QAPage") -> Column:
    """The first embedded JSON-LD object of a type; blocks that don't parse are skipped."""
    blocks = F.regexp_extract_all(page, F.lit(LD_JSON), 1)
    hits = F.filter(blocks, lambda b: F.coalesce(F.try_variant_get(F.try_parse_json(b), "$['@type']", "string") == kind, F.lit(False)))
    return F.try_element_at(hits, F.lit(1))


def scrape_question(rows: DataFrame, page: str = "html") -> DataFrame:
    """Title, author, body and date of a question page: from JSON-LD; title and body else from the markup.

    Dates that don't parse don't count; the date is as the page writes it.
    """
    out = rows.withColumn("_v", F.try_parse_json(pick_ld_json(F.col(page))))
    get = lambda path, kind="string": F.try_variant_get("_v", f"$.mainEntity{path}", kind)
    # An accepted answer may be an object or a list of them.
    accepted = F.coalesce(F.from_json(F.to_json(F.try_variant_get("_v", "$.mainEntity.acceptedAnswer", "variant")), _ANSWER), F.array().cast(_ANSWER))
    suggested = F.coalesce(F.from_json(F.to_json(F.try_variant_get("_v", "$.mainEntity.suggestedAnswer", "variant")), _ANSWER), F.array().cast(_ANSWER))
    answers = F.filter(F.concat(accepted, suggested), lambda a: a.isNotNull())
    texts = F.concat(F.array(strip_html(get(".text"))), F.transform(answers, lambda a: strip_html(a["text"])))
    body = F.array_join(F.filter(texts, lambda x: F.trim(x) != ""), "\n\n---\n\n")
    when = lambda d: F.when(parse_utc(d).isNotNull(), d)
    dates = F.filter(F.transform(answers, lambda a: F.coalesce(when(a["updatedAt"]), when(a["dateCreated"]))), lambda d: d.isNotNull())
    earliest = F.array_min(F.transform(dates, lambda d: F.struct(parse_utc(d).alias("t"), d.alias("d"))))["d"]
    local = when(F.nullif(F.regexp_extract(page, r'(?i)<local-time[^>]+datetime="(20\d{2}-\d{2}-\d{2}T[\d:.]+(?:\+[\d:]+|Z)?)"', 1), F.lit("")))
    heading = unescape(strip(F.regexp_extract(page, r"(?i)<h1[^>]*>([^<]+)</h1>", 1)))
    rest = strip_html(F.regexp_extract(page, r"""(?s)</h1>(.*?)(?:<footer|<div[^>]+class="[^"]*(?:additional|related))""", 1))
    found = F.col("_v").isNotNull()
    # The author is an object with a name or plain text.
    author = F.coalesce(get(".author.name"), F.when(~F.coalesce(F.schema_of_variant(F.try_variant_get("_v", "$.mainEntity.author", "variant")).startswith("OBJECT"), F.lit(False)), get(".author")))
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    return out.withColumns({
        "title": F.when(found, text(get(".name"))).otherwise(heading),
        "author": F.when(found, text(author)).otherwise(F.lit("")),
        "body": F.when(found, body).otherwise(rest),
        "asked": F.when(found, F.coalesce(when(get(".dateCreated")), when(get(".datePublished")), earliest, local)),
    }).drop("_v")


def page_links(rows: DataFrame, key: str, page: str, pattern: str, base: Column | None = None) -> DataFrame:
    """(key, href, title, pos): anchors whose target matches, each target once, at its first place."""
    anchors = F.regexp_extract_all(page, F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), 0)
    out = rows.select(key, F.posexplode(anchors).alias("pos", "a"), *([base.alias("_base")] if base is not None else []))
    href = F.regexp_extract("a", r'(?i)href="([^"]*)"', 1)
    title = norm_space(unescape(F.regexp_replace("a", r"<[^>]+>", " ")))
    out = out.select(key, "pos", href.alias("href"), title.alias("title"), *(["_base"] if base is not None else [])).where(F.col("href").rlike(pattern))
    if base is not None:
        out = out.withColumn("href", F.when(F.col("href").startswith("/"), F.concat("_base", "href")).otherwise(F.col("href"))).drop("_base")
    return out.groupBy(key, "href").agg(F.min("pos").alias("pos"), F.min_by("title", "pos").alias("title"))


def link_dates(rows: DataFrame, key: str, page: str, pattern: str, reach: int = 5000) -> DataFrame:
    """(key, href, asked): of every matching anchor the first date in the `reach` characters behind it."""
    anchors = F.regexp_extract_all(page, F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>'), 0)
    out = rows.select(key, page, F.posexplode(anchors).alias("pos", "a"))
    href = F.regexp_extract("a", r'(?i)href="([^"]*)"', 1)
    behind = F.substring(F.col(page), F.expr(f"locate(a, `{page}`)"), F.lit(reach))
    out = out.select(key, "pos", href.alias("href"), F.nullif(F.regexp_extract(behind, r'(?i)datetime="([^"]+)"', 1), F.lit("")).alias("asked")).where(F.col("href").rlike(pattern))
    return out.groupBy(key, "href").agg(F.min_by("asked", "pos").alias("asked"))


# Lines of documentation pages that aren't the article's.
DOC_NOISE = r"(?i)^\s*(Article tested with|Feedback|Was this page helpful|Yes No|In this article|Submit and view feedback)\s*$|^\s*\d+\s+min(utes?)?\s+to\s+read\s*$"
_LINE_END = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"


def doc_title_body(rows: DataFrame, page: str = "html") -> DataFrame:
    """Adds title and body of a documentation page.

    The title is the heading; the body the text of the content division, else of what stands between heading and footer
    (at most 80,000 characters where there is no footer), without the lines up to one that repeats the title and without
    page furniture.
    """
    names = rows.columns
    parts = rows.withColumn("_h1", F.regexp_extract(page, r"(?is)<h1[^>]*>(.*?)</h1>", 1)).withColumn("_div", nested_div(F.col(page), "data-bi-name", "content"))
    after = F.regexp_extract(page, r"(?is)<h1[^>]*>.*?</h1>(.*)\z", 1)
    inner = F.when(after.rlike("(?i)<footer"), F.regexp_extract(after, r"(?is)\A(.*?)<footer", 1)).otherwise(F.substring(after, 1, 80_000))
    parts = parts.select(*names, strip_doc_html(F.col("_h1")).alias("title"), F.split(strip_doc_html(F.when(F.col("_div") != "", F.col("_div")).otherwise(inner)), _LINE_END, -1).alias("_lines"))
    at = F.array_position(F.transform("_lines", lambda x: F.lower(strip(x)) == F.lower(strip(F.col("title")))), F.lit(True)).cast("int")
    rest = F.when((at > 0) & (F.col("title") != ""), F.slice("_lines", at + 1, F.greatest(F.size("_lines") - at, F.lit(0)))).otherwise(F.col("_lines"))
    kept = F.filter(F.transform(rest, strip), lambda x: ~x.rlike(DOC_NOISE))
    return parts.withColumn("body", strip(F.regexp_replace(F.array_join(kept, "\n"), "\n{3,}", "\n\n"))).drop("_lines")


def last_page(page: Column) -> Column:
    """The largest number of the pagination's links, else of page= in any link, else 1."""
    ints = lambda pattern: F.array_max(F.transform(F.regexp_extract_all(page, F.lit(pattern), 1), lambda x: x.cast("int")))
    return F.coalesce(ints(r'(?is)<a[^>]*class="[^"]*pagination-link[^"]*"[^>]*>\s*(\d{1,9})\s*</a>'), ints(r"[?&]page=(\d{1,9})"), F.lit(1))


def page_url(url: Column, page: Column) -> Column:
    """The url with its page parameter set, behind the other parameters if it had none; these are decoded and encoded again, those
    without a value go, values of one name stand together, and a fragment stays behind them."""
    bare, fragment = F.substring_index(url, "#", 1), F.regexp_extract(url, r"(?s)#(.+)\z", 1)
    base, query = F.substring_index(bare, "?", 1), F.regexp_extract(bare, r"(?s)\?(.*)\z", 1)
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    encode = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    given = F.filter(F.split(query, "&", -1), lambda x: x.rlike("(?s)=."))
    pairs = F.transform(given, lambda x: F.struct(decode(F.substring_index(x, "=", 1)).alias("k"), decode(F.regexp_extract(x, r"(?s)=(.*)\z", 1)).alias("v")))
    names = F.array_distinct(F.concat(F.transform(pairs, lambda p: p["k"]), F.array(F.lit("page"))))
    line = lambda k, v: F.concat(encode(k), F.lit("="), encode(v))
    own = lambda k: F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: line(p["k"], p["v"]))
    lines = F.transform(names, lambda k: F.when(k == "page", F.array(F.concat(F.lit("page="), page.cast("string")))).otherwise(own(k)))
    return F.concat(base, F.lit("?"), F.array_join(F.flatten(lines), "&"), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")))


def nested_div(page: Column, attribute: str, value: str) -> Column:
    """What stands in the first element with attribute="value", through its own closing tag, which is part of the result;
    to the end if nothing closes it, and the empty text if there is no such element. Divisions are counted."""
    token = "<div|</div>"

    def inner(t):
        marker = f'{attribute}="{value}"'
        start = F.regexp_replace(F.substring_index(t, marker, 1), r"(?s)\A.*(?=<)", "")  # from the last < before the marker
        before = F.length(F.substring_index(t, marker, 1)) - F.length(start)
        rest = F.regexp_extract(F.substring(t, before + 1, F.length(t)), r"(?s)\A<[^>]*>(.*)\z", 1)
        return F.when(t.contains(marker) & start.startswith("<"), once(rest, closed)).otherwise(F.lit(""))

    def closed(rest):
        tags, between = F.regexp_extract_all(rest, F.lit(token), 0), F.split(rest, token, -1)
        zero = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"), F.lit(0).alias("last"))

        def step(state, tag):
            depth = state["depth"] + F.when(tag == "<div", 1).otherwise(-1)
            n = state["n"] + 1
            return F.struct(depth.alias("depth"), n.alias("n"), F.when((state["last"] == 0) & (depth == 0), n).otherwise(state["last"]).alias("last"))

        last = F.aggregate(tags, zero, step)["last"]
        upto = F.zip_with(F.slice(between, F.lit(1), last), F.slice(tags, F.lit(1), last), lambda a, b: F.concat(a, b))
        return F.when(last == 0, rest).otherwise(F.array_join(upto, ""))

    return once(F.coalesce(page, F.lit("")), inner)


# ---------------------------------------------------------------- tables of contents


def flatten_toc(rows: DataFrame, toc: str = "toc") -> DataFrame:
    """(…, pos, href, title) of a table of contents (JSON) of any depth, children before items.

    Nodes are taken apart level by level, each level written once; a node's place is the way to it, so places sort as the nodes
    stand. What isn't JSON, or repeats a key in an object, has no entries. `rows` must have a row for each value of its other
    columns.
    """
    from ..sources.scratch import written

    spark = rows.sparkSession
    keys = [c for c in rows.columns if c != toc]
    level = rows.select(*keys, F.array().cast("array<int>").alias("_way"), F.try_parse_json(toc).alias("_node")).where("_node is not null")
    found = None
    while True:
        level = written(level, "toc")
        if level.isEmpty():
            break
        own = level.select(*keys, "_way", F.try_variant_get("_node", "$.href", "string").alias("href"), F.coalesce(F.try_variant_get("_node", "$.toc_title", "string"), F.lit("")).alias("title")).where("href <> ''")
        found = own if found is None else found.unionByName(own)
        step = F.when(F.col("key").isNull(), F.col("pos")).when(F.col("key") == "children", 0).when(F.col("key") == "items", 1)
        parts = level.lateralJoin(spark.tvf.variant_explode(F.col("_node").outer()))
        level = parts.withColumn("_step", step).where("_step is not null").select(*keys, F.concat("_way", F.array("_step")).alias("_way"), F.col("value").alias("_node"))
    if found is None:
        return spark.createDataFrame([], rows.select(*keys, F.lit(0).alias("pos"), F.lit("").alias("href"), F.lit("").alias("title")).schema)
    entry = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_way", "href", "title"))).alias("_t"))  # one table of contents
    return entry.select(*keys, F.posexplode("_t").alias("pos", "_x")).select(*keys, "pos", "_x.href", "_x.title")


def without_dots(segments: Column) -> Column:
    """Path segments after . and .. have done their work; what would lead above the root stays at it."""

    def step(done, s):
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(s == "..", up).when(s.isin(".", ""), done).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(segments, F.array().cast("array<string>"), step)


def resolve_href(href: Column, base: str, site: str) -> Column:
    """Absolute urls of a site from the targets of a table of contents below `base`; null for others."""
    parts = urlsplit(base)
    root = f"{parts.scheme}://{parts.netloc}"
    below = F.array(*(F.lit(s) for s in parts.path.split("/") if s))
    plain = F.regexp_replace(F.trim(href), r"[?#].*$", "")
    segments = F.split(plain, "/", -1)
    open_end = F.element_at(segments, -1).isin("", ".", "..")
    path = F.array_join(without_dots(F.concat(below, segments)), "/")
    joined = F.concat(F.lit(root + "/"), path, F.when(open_end & (path != ""), F.lit("/")).otherwise(F.lit("")))
    joined = F.when(plain.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), plain).otherwise(joined)
    own = F.when(plain.startswith("http://"), F.lit(None)).when(plain.startswith("https://"), F.when(plain.startswith(site), plain)).when(plain == "", F.lit(None)).when(plain.startswith("/"), F.concat(F.lit(site), plain))
    relative = ~plain.startswith("/") & ~plain.rlike("^https?://") & (plain != "")
    return F.when(relative, joined).otherwise(own)


def ordered_urls(rows: DataFrame, most: int | None = None) -> DataFrame:
    """(url, title, order): each url once, at its first place; numbers run on after the cap."""
    from ..operators.numbering import numbered

    first = rows.where("url is not null").groupBy("url").agg(F.min("pos").alias("pos"), F.min_by("title", "pos").alias("title"))
    out = numbered(first, ["pos", "url"], "order").withColumn("order", F.col("order").cast("int"))
    return (out.where(F.col("order") <= most) if most else out).select("url", "title", "order")
