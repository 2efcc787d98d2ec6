"""Keys, hashes and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def norm_key(c: Column) -> Column:
    return F.substring(F.replace(F.lower(F.trim(_text(c))), F.lit(" "), F.lit("-")), 1, 360)


def norm_level(c: Column) -> Column:
    """1 to 4 from a number or a name such as topic, l2 or level3; else 0."""
    t = F.lower(F.trim(_text(c.cast("string"))))
    named = F.when(t == "topic", 1).when(t == "scenario", 2).when(t == "variant", 3).when(t.isin("leaf", "resolution_leaf", "resolution"), 4)
    n = F.coalesce(F.try_to_number(F.nullif(F.regexp_replace(F.regexp_replace(t, r"\..*$", ""), r"\D", ""), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))
    return F.coalesce(named, F.when(n.between(1, 4), n), F.lit(0)).cast("int")


def candidate_id(*parts: Column) -> Column:
    """12 hex digits of the sha1 of product, level and the four keys."""
    return F.substring(F.sha1(F.lower(F.concat_ws("|", *(F.trim(_text(p.cast("string"))) for p in parts)))), 1, 12)


def path_hash(*parts: Column) -> Column:
    return F.sha1(F.lower(F.concat_ws("|", *(_text(p) for p in parts))))


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.trim(_text(c))), "[^a-z0-9]+", "-")
    s = F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, 80)
    return F.when(s == "", F.lit("untitled")).otherwise(s)


def single_slashes(c: Column) -> Column:
    s = F.regexp_replace(F.replace(F.trim(_text(c)), F.lit("\\"), F.lit("/")), "/+", "/")
    s = F.when(s.startswith("/"), s).otherwise(F.concat(F.lit("/"), s))
    return F.when(F.length(s) > 1, F.regexp_replace(s, "/$", "")).otherwise(s)


def fit_path(c: Column, most: int = 235) -> Column:
    """Shortens the last segment so that the path fits; very long prefixes become a hash."""
    p = single_slashes(c)
    last = F.substring_index(p, "/", -1)
    prefix = F.substring(p, F.lit(1), F.length(p) - F.length(last))
    room = F.lit(most) - F.length(prefix)
    cut = F.regexp_replace(F.substring(last, F.lit(1), F.least(room, F.lit(80))), "-+$", "")
    digest = F.substring(F.sha1(p), 1, 16)
    short = F.when(cut != "", cut).otherwise(F.substring(F.concat(F.lit("p-"), digest), F.lit(1), room))
    return F.when(F.length(p) <= most, p).when(room <= 0, F.concat(F.lit("/"), digest)).otherwise(F.concat(prefix, short))


def sanitize_name(c: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(_text(c)), "[^a-z0-9_-]", "_"), 1, 60)


# What stands in a url, and the source that this means, in turn.
SOURCES = [("learn.microsoft.com", "msqa"), ("stackoverflow.com", "so"), ("github.com", "github")]


def source_of(url: Column, sources=SOURCES, other: str = "msqa") -> Column:
    """Which site a thread is from, by its url."""
    u, out = F.lower(_text(url)), None
    for part, name in sources:
        out = F.when(u.contains(part), F.lit(name)) if out is None else out.when(u.contains(part), F.lit(name))
    return F.lit(other) if out is None else out.otherwise(F.lit(other))


def question_id(url: Column) -> Column:
    """'qa' and the digits behind /questions/ in a url, or the empty text."""
    d = F.regexp_extract(_text(url), r"/questions/(\d+)", 1)
    return F.when(d != "", F.concat(F.lit("qa"), d)).otherwise("")


def ancestors(path: Column) -> Column:
    """All proper prefixes of /a/b/c: [/a, /a/b]."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    n = F.size(parts)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))
