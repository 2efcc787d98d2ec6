"""Small tables for the cases that are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from threadloom.functions import annotations as A
from threadloom.functions import html as H
from threadloom.functions import keys as N
from threadloom.functions import products as B
from threadloom.functions import text as T
from threadloom.operators import mutations as M
from threadloom.operators import rollup as R
from threadloom.operators import validation as V
from threadloom.operators.predicates import beyond_watermark


def one(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(f(F.col("x"))).collect()]


def test_noise_lines(spark):
    text = "Hello\nAdd comment\n  Follow \nfollow me\n12 comments\nNo\nI said No\n1,234 Reputation points\n•  Moderator\nSort by:\nyes"
    assert one(spark, T.drop_noise_lines, text) == ["Hello\nfollow me\nI said No\nyes"]


def test_footer(spark):
    assert one(spark, T.cut_footer, "a\n Training \nb", "Module\nx", "a Training\nb") == ["a", "", "a Training\nb"]


def test_copy_lines_span_blank_lines(spark):
    assert one(spark, T.drop_copy_lines, "a\n\n copy \nb", "copyright\nb") == ["a\n\nb", "copyright\nb"]
    assert one(spark, T.clean_content, "a\r\n\r\nCopy\r\nb") == ["a\n\nb"]


def test_clean_nulls_and_unicode_blanks(spark):
    assert one(spark, T.clean_content, None, "", "﻿a \n\n\n\nb\t c") == ["", "", "a\n\nb c"]


def test_cleaning_keeps_no_noise_of_its_input(spark):
    out = one(spark, T.clean_content, "Add  comment\nAdd comment\nx")[0]
    assert "Add comment" in out and out.count("\n") == 1  # two blanks are collapsed after the filter


def test_trim(spark):
    a, b = one(spark, T.trim_for_llm, "x" * 12000, "y" * 12001)
    assert len(a) == 12000 and len(b) == T.HEAD + T.TAIL + len(T.MARKER)


def test_parse_utc(spark):
    got = one(spark, lambda c: F.unix_micros(T.parse_utc(c)), "2024-01-01T00:00:00.1234567Z", "2024-01-01 00:00:00", "nope", None)
    assert got == [1704067200123456, 1704067200000000, None, None]


def test_slug_and_paths(spark):
    assert one(spark, N.slug, "  A b!! ", "", None, "-".join(["x" * 79, "y"])) == ["a-b", "untitled", "untitled", "x" * 79 + "-"]
    assert one(spark, N.single_slashes, "a\\\\b//", "/", None) == ["/a/b", "/", "/"]
    assert one(spark, N.ancestors, "/a/b/c", "/a") == [["/a", "/a/b"], []]
    assert all(len(x) <= 235 for x in one(spark, N.fit_path, "/a/" + "b" * 400, "/" + "c/" * 300))


def test_parse_object(spark):
    rows = [r[0] for r in spark.createDataFrame([('{"a":1}',), ('```json\n{"a":1}\n```',), ('so: {"a":1} ok',), ("[1]",), ("",), ('{"a":',), ("none",), ("x {bad} y",)], "x string").select(A.parse_object(F.col("x"))).collect()]
    assert [r["error"] for r in rows] == [None, None, None, "json_not_object", "empty_model_output", "json_parse_failed", "json_parse_failed", "json_extract_parse_failed"]
    assert rows[1]["body"] == rows[2]["body"] == '{"a":1}'


def test_quoted_false_is_true(spark):
    df = spark.createDataFrame([("t", '{"product":"p","is_emergent":"false","solution_usefulness":7}'), ("u", '{"is_emergent":false}')], "thread_id string, output string")
    rows = {r["thread_id"]: r for r in A.annotation_columns(df).collect()}
    assert rows["t"]["is_emergent"] and not rows["u"]["is_emergent"]
    assert rows["t"]["usefulness"] == 1.0 and rows["t"]["topic_key"] == "p:unknown" and rows["u"]["product"] == "Other"


def test_rollup_by_id_key_and_both(spark):
    cat = spark.createDataFrame(
        [(1, 1, "p", "t", None, True), (2, 2, "p", "s", 1, True), (3, 3, "p", "v", 2, True), (4, 4, "p", "l", 3, True), (5, 4, "p", "m", 3, False), (6, 4, "p", "n", 3, True)],
        "cluster_id long, cluster_level int, product string, cluster_key string, parent_id long, is_active boolean").withColumn("last_seen", F.lit(dt.date(2024, 1, 1)))
    rows = [("a", "p", 4, "x", 0.5), ("b", "p", None, "l", 0.25), ("c", "p", 4, "l", None), ("d", "p", 4, "m", 0.75), ("e", " ", 4, "l", 1.0)]
    thr = spark.createDataFrame(rows, "thread_id string, product string, leaf_id long, leaf_key string, usefulness double")
    thr = thr.withColumn("usefulness", F.col("usefulness").cast("decimal(4,3)"))
    for c in ("variant", "scenario", "topic"):
        thr = thr.withColumn(f"{c}_id", F.lit(None).cast("long")).withColumn(f"{c}_key", F.lit("-"))
    out = {r["cluster_id"]: (r["member_count"], None if r["max_usefulness"] is None else float(r["max_usefulness"])) for r in R.rollup_levels(thr, cat).collect()}
    assert out[4] == (4, 0.75) and out[5] == (1, 0.75) and out[6] == (0, None) and out[3] == (0, 0.75) and out[1] == (0, 0.75)


def test_same_key_under_two_parents_is_one_node(spark):
    cat = spark.createDataFrame([(1, 1, "p", "t1", None, "x", True), (2, 1, "p", "t2", None, "x", True)], "cluster_id long, cluster_level int, product string, cluster_key string, parent_id long, created_by string, is_active boolean")
    want = spark.createDataFrame([("p", "s", "t1", "sig"), ("p", "s", "t2", "sig")], "product string, cluster_key string, parent_key string, signature_text string")
    new = M.get_or_create_nodes(cat, want, 2, "x")
    assert new.count() == 1
    both = cat.unionByName(new.drop("signature_text").withColumn("is_active", F.lit(True)))
    rows = spark.createDataFrame([("a", "p", "t1", "s", "", ""), ("b", "p", "t2", "s", "", "")], "thread_id string, product string, topic_key string, scenario_key string, variant_key string, leaf_key string")
    assert sorted(r["status"] for r in V.resolve_assignments(rows, both).collect()) == ["assigned_topic_scenario", "missing_scenario"]


def test_null_is_never_replaced_by_comparison(spark):
    base = spark.createDataFrame([(1, None, None, 1), (2, 0.5, dt.date(2024, 1, 1), 1)], "incident_id long, confidence double, last_seen date, thread_count long")
    new = spark.createDataFrame([(1, 0.9, dt.date(2024, 2, 1), 2), (2, 0.9, dt.date(2023, 1, 1), 2)], "incident_id long, confidence double, last_seen date, incoming long")
    links = spark.createDataFrame([(2, "a")], "incident_id long, thread_id string")
    out = {r["incident_id"]: r for r in M.incident_upsert(base, new, links).collect()}
    assert out[1]["confidence"] is None and out[1]["last_seen"] is None and out[1]["thread_count"] == 2
    assert out[2]["confidence"] == 0.9 and out[2]["last_seen"] == dt.date(2024, 1, 1) and out[2]["thread_count"] == 3


def test_upserts_that_repeat(spark):
    have = spark.createDataFrame([("a", 1)], "name string, n long").withColumn("seen", F.lit(dt.date(2024, 1, 1)))
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    once = M.count_up(have, rows, "name", "n", "seen", dt.date(2024, 2, 1))
    assert {r["name"]: r["n"] for r in once.collect()} == {"a": 3, "b": 1}
    add = spark.createDataFrame([("b", 9), ("b", 8)], "name string, n long").withColumn("seen", F.lit(dt.date(2024, 1, 1)))
    first = M.insert_absent(have, add, "name")
    assert M.insert_absent(first, add, "name").count() == first.count() == 2


def test_alias_order():
    assert M.fold_aliases([("a", "b"), ("b", "c")]) == {"a": "c", "b": "c"}
    assert M.fold_aliases([("b", "c"), ("a", "b")]) == {"b": "c", "a": "b"}


def test_watermark_compares_ids_as_text(spark):
    df = spark.createDataFrame([("qa9", dt.date(2024, 1, 1)), ("qa10", dt.date(2024, 1, 1)), ("qa10", dt.date(2024, 3, 1)), ("qa99", None)], "q string, d date")
    assert df.where(beyond_watermark("d", "q", dt.date(2024, 2, 1), "qa50")).count() == 3
    assert df.where(beyond_watermark("d", "q", dt.date(2024, 2, 1), "qa50", strict=True)).count() == 1


def test_product_cascade(spark):
    names = spark.createDataFrame([("event hub",), ("Event",), ("hub event grid x",), ("Other",), ("",), ("nothing",)], "raw string")
    products = spark.createDataFrame([("Event Hub",), ("Event Grid",), ("Event Hub Grid Y Z",)], "name string")
    got = {r["raw"]: r["product"] for r in B.normalize_products(names, products).collect()}
    assert got == {"event hub": "Event Hub", "Event": "Event Grid", "hub event grid x": "Event Grid", "Other": "Other", "": "", "nothing": "nothing"}


def test_html(spark):
    page = '<html><script type="application/ld+json">{bad</script><script type="application/ld+json">{"@type":"QAPage","mainEntity":{"name":" N ","text":"<p>q &amp; a</p>","author":{"name":"me"},"acceptedAnswer":[{"text":"yes<br>no","updatedAt":"2024-01-02"}],"suggestedAnswer":[{"text":" "}]}}</script>'
    df = spark.createDataFrame([(1, page), (2, "<h1>T</h1><p>body</p><footer>f</footer>")], "page_id long, html string")
    rows = {r["page_id"]: r for r in H.scrape_question(df).collect()}
    assert (rows[1]["title"], rows[1]["author"], rows[1]["body"], rows[1]["asked"]) == ("N", "me", "q & a\n\n---\n\nyes\nno", "2024-01-02")
    assert (rows[2]["title"], rows[2]["body"]) == ("T", "body")
    assert one(spark, lambda c: H.nested_div(c, "class", "x"), '<div class="x">a<div>b</div>c</div>d', "none") == ["a<div>b</div>c</div>", ""]


def test_unescape_is_the_standard_librarys(spark):
    import html

    texts = ["a&amp;b", "&#8217;&#x27;&rsquo;&rdquo;", "&notit; &notin; &not", "&#0;&#128;&#13;&#x110000;&#xD800;&#xFDD0;&#x1F600;&#11;&#99999999999999;&#x1FFFE;", "& &; &#; &#x; &unknown;", "&AMP&amp;lt;", "&eacute x", "&CounterClockwiseContourIntegral;&NotEqualTilde;", "none", "", "&#x000041;&#00065", "&a&b;", "&ampamp;", "&nbsp;&frac12&copy2"]
    texts += [f"&#{n};&#x{n:x}" for n in range(0, 300, 3)]
    assert one(spark, T.unescape, *texts, None) == [*map(html.unescape, texts), None]


def test_strip_html_of_both_kinds(spark):
    page = "<ul><li>a</li></ul>b<pre>c</pre>d<article>e</article>\r\n<table><tr><td>f</td></tr></table>g<br/>h<SCRIPT>x</SCRIPT>i"
    assert one(spark, T.strip_html, page) == ["a\n b c d e \r\n f \n g\nhi"]
    assert one(spark, T.strip_doc_html, page) == ["a\nb\nc\nd\ne\n\r\n\nf \ng h i"]


def test_noise_patterns_stay_within_a_line(spark):
    assert one(spark, T.drop_noise_lines, "12\nvotes\n3 votes", "Add\n", "No", "a\nYes", "", "\n\nAdd file\n\n") == ["12\nvotes", "", "", "a", "", "\n\n\n"]
    assert one(spark, T.cut_footer, "a\n\u00a0Module\nb", "\nTraining", "Training") == ["a", "", ""]


def test_nested_div_follows_divisions(spark):
    pages = ['<p id="x">a<div>b</div></div>c</p></div>', 'id="x">a', '<div id="x">a<div>b</div>', '<div id="x" class="y"><div></div></div></div>', None]
    assert one(spark, lambda c: H.nested_div(c, "id", "x"), *pages) == ["a<div>b</div></div>", "", "a<div>b</div>", "<div></div></div>", ""]


def test_title_and_body(spark):
    df = spark.createDataFrame([(1, '<h1>My <b>T</b></h1>x<div data-bi-name="content">tool<h1>my  t</h1><p>Feedback</p><p> one </p>5 min to read\n\n\n\n<p>two</p></div>z'), (2, "<h1>T</h1><p>a</p><FOOTER>f"), (3, "<p>no heading</p>"), (4, "<h1>T</h1>" + "y" * 90_000)], "page_id long, html string")
    rows = {r["page_id"]: (r["title"], r["body"]) for r in H.doc_title_body(df).collect()}
    assert rows == {1: ("My T", "one\n\ntwo"), 2: ("T", "a"), 3: ("", ""), 4: ("T", "y" * 80_000)}


def test_limits():
    import pytest

    from threadloom.functions import limits as L

    assert L.bounded("assign", batch_size=99, max_workers=0) == {"batch_size": 25, "max_workers": 1}
    assert (L.batches_for(100, 25), L.batches_for(100_000, 1), L.batches_for(10, 5, 3)) == (4, 200, 3)
    with pytest.raises(KeyError):
        L.bounded("assign", nothing=1)


def test_the_last_add_wins(spark):
    have = spark.createDataFrame([("a", 1)], "id string, v int")
    adds = spark.createDataFrame([("b", 5, 1), ("b", 3, 2), ("a", 9, 1)], "id string, v int, at int")
    none = have.limit(0)
    for parts in (1, 3):
        got = {r["id"]: r["v"] for r in V.refine(have, none, have, adds.repartition(parts), "id", order="at").collect()}
        assert got == {"a": 9, "b": 3}
    assert {r["id"]: r["v"] for r in V.refine(have, none, have, adds, "id").collect()} == {"a": 9, "b": 5}


def test_load_per_minute_over_hours(spark):
    from threadloom.streaming import ingest as S

    rows = [(i, dt.datetime(2024, 1, 1, 10, 58, 30) + dt.timedelta(seconds=7 * i), "k", 1.0) for i in range(40)]
    out = S.load_per_minute(spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double")).collect()
    at = {r[0]: r[1] for r in rows}
    assert {r["event_id"]: int(r["load"]) for r in out} == {i: sum(0 <= (at[i] - t).total_seconds() <= 60 for t in at.values()) for i in at}


def test_shared_folder_is_asked_for(spark, monkeypatch):
    import pytest

    from threadloom.sources.scratch import shared_folder

    assert shared_folder(spark)

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d: d)})
        sparkContext = type("S", (), {"master": "local-cluster[2,1,1024]"})

    with pytest.raises(ValueError):
        shared_folder(Session)


def test_lifecycle_bounds(spark):
    inc = spark.createDataFrame([(i, s, None, 1, None, None) for i, s in ((1, "active"), (2, "active"), (3, "resolved"), (4, "archived"))], "incident_id long, status string, last_seen date, thread_count long, resolved_on date, first_seen date")
    d = dt.date
    links = spark.createDataFrame([(1, "a", d(2024, 1, 6), d(2024, 1, 6)), (2, "b", d(2024, 1, 5), d(2024, 1, 5))], "incident_id long, thread_id string, created_on date, added_on date")
    out = {r["incident_id"]: r["status"] for r in M.incident_lifecycle(inc, links, d(2024, 1, 22), d(2024, 1, 6)).collect()}
    assert out == {1: "possibly_resolved", 2: "resolved", 3: "resolved", 4: "archived"}


def test_imports_without_llm():
    import subprocess
    import sys

    code = "import sys\nclass No:\n def find_spec(self, name, *a):\n  if name.startswith('threadloom.llm') or name == 'corpus_pipeline': raise ImportError(name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nassert not any(k.startswith('op') for k in e.queries()) and len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
