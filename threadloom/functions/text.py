"""Text cleaning as column expressions; no Python runs over the rows."""

from __future__ import annotations

import html
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column, f) -> Column:
    """f(c), where f uses its argument more than once and c is dear: c is computed a single time."""
    return F.transform(F.array(c), f)[0]


# Lines that are page furniture when they stand alone.
NOISE_LINES = [
    "Add",
    "Add comment",
    "Comment",
    "Discard draft",
    "Insert image",
    "Cancel",
    "Add file",
    "Post your answer",
    "Your answer",
    "Sign in to comment",
    "Sign in to answer",
    "Sign in to follow",
    "Follow question",
    "I have the same question",
    "No comments",
    "Report a concern",
    "Loading...",
    "Do not use comments to answer questions.Loading...",
    "Use answers to provide solutions to the user's question.Loading...",
    "Was this answer helpful?",
    "Yes",
    "No",
    "Most helpful",
    "Newest",
    "Oldest",
]

# Patterns of such lines, whatever their case.
NOISE_PATTERNS = [
    r"follow",
    r"Sort by:",
    r"Add to Collections",
    r"Add to plan",
    r"Share via",
    r"(Facebook|x\.com|LinkedIn|Email)",
    r"\d[\d,]*\s*Reputation points",
    r"•\s*Moderator",
    r"\d+\s*votes",
    r"\d+\s*\{count\}\s*votes",
    r"\d+\s*comments?",
    r"Hide comments for this question",
    r"Show comments for this answer",
    r"Show comments for this question",
    r"No comments",
    r"Heading\s*2Heading\s*3Heading\s*4.*View Markdown",
    r"ColumnRemove columnInsert column beforeInsert column afterRowRemove rowInsert row afterInsert row beforeView Markdown",
    r"Browse,\s*drag\s*&\s*drop,\s*or\s*paste\s*an\s*image.*",
    r"Browse,\s*drag\s*&\s*drop,\s*or\s*paste\s*a\s*file.*",
    r"\d+\s+person\s+found\s+this\s+answer\s+helpful\.",
]

# Headings from which on a page is a footer.
FOOTER_HEADINGS = ["Additional resources", "Training", "Documentation", "Module", "Certification", "Show 2 more", "Show more"]

#: White space of any script; what of it stands inside a line; and what of that is neither a blank nor a tab.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_FEW = r"\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_H, _RARE = rf"[\t {_FEW}]", f"[{_FEW}]"
_NOISE = (
    rf"(?dmU)^{_H}*+(?:(?:" + "|".join(re.escape(x).replace("\\ ", " ") for x in NOISE_LINES) + ")|(?i:" + "|".join(x.replace(r"\s", _H) for x in NOISE_PATTERNS) + rf")){_H}*+\n")
_FOOTER = rf"(?dmU)^{_H}*+(?:" + "|".join(FOOTER_HEADINGS) + rf"){_H}*+$"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(c, F.lit(SPACES))


def norm_newlines(c: Column) -> Column:
    t = F.replace(F.coalesce(c, F.lit("")), F.lit("\ufeff"), F.lit(""))
    return F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def normalize_ws(c: Column) -> Column:
    blanks = F.replace(F.regexp_replace(norm_newlines(c), "[ \t]++", " "), F.lit(" \n"), F.lit("\n"))
    # White space other than blanks at the ends of lines is rare, and dear to look for.
    t = once(blanks, lambda x: F.when(x.rlike(_RARE), F.regexp_replace(x, rf"(?dm)(?<!{_H}){_H}++$", "")).otherwise(x))
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def drop_copy_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"(?dmiU)^\s*Copy\s*$", "")


def drop_noise_lines(c: Column) -> Column:
    """Without the lines that are page furniture; one pass over the text, whose last line gets an end for it."""
    return F.regexp_replace(F.regexp_replace(F.concat(c, F.lit("\n")), _NOISE, ""), r"\n\z", "")


def cut_footer(c: Column) -> Column:
    """Up to the first heading of a footer that stands alone. Headings are no noise, so the first one always cuts."""
    at = F.regexp_instr(c, F.lit(_FOOTER))
    return F.when(at > 0, F.substring(c, F.lit(1), F.greatest(at - 2, F.lit(0)))).otherwise(c)


def clean_content(c: Column) -> Column:
    t = once(drop_noise_lines(drop_copy_lines(norm_newlines(c))), cut_footer)
    return normalize_ws(F.replace(t, F.lit("\t"), F.lit(" ")))


# What is kept of a long text, and what stands for the rest.
HEAD, TAIL, MARKER = 8000, 3000, "\n\n--- TRUNCATED ---\n\n"


def trim_for_llm(c: Column, most: int = 12_000) -> Column:
    short = F.concat(F.substring(c, 1, HEAD), F.lit(MARKER), F.substring(c, -TAIL, TAIL))
    return F.when(F.length(c) <= most, c).otherwise(normalize_ws(short))


def norm_space(c: Column) -> Column:
    """CR becomes LF (so CRLF becomes two), runs of blanks one, three LF or more two."""
    t = F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\r"), F.lit("\n")), "[ \t]+", " ")
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))


def parse_utc(c: Column) -> Column:
    """ISO time, naive means UTC, digits of a second beyond six are dropped; null for anything else."""
    t = F.regexp_replace(F.trim(c), r"(\.\d{6})\d+", "$1")
    return F.try_to_timestamp(F.regexp_replace(t, "Z$", "+00:00"))


def clamp(c: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(F.coalesce(c, F.lit(""))) / 4)).cast("long")


def shorten(c: Column, most: int) -> Column:
    """Stripped and cut; null when empty."""
    s = F.nullif(F.trim(c), F.lit(""))
    return F.substring(s, 1, most) if most > 0 else s


def log_shorten(c: Column, most: int) -> Column:
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.substring(c, 1, most), F.lit("(+"), (F.length(c) - most).cast("string"), F.lit(" chars)")))


def markdown_list(items: Column, ordered: bool = False) -> Column:
    """Lines of a list; blank items are skipped but keep their number."""
    line = (lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), F.trim(x))) if ordered else (lambda x, i: F.concat(F.lit("- "), F.trim(x)))
    rows = F.transform(items, lambda x, i: F.when(F.trim(x) != "", line(x, i)))
    return F.array_join(F.filter(rows, lambda x: x.isNotNull()), "\n")


def with_heading(text: Column, key: Column, least: int = 40) -> Column:
    """Prepends a first-level heading if there is none; null for texts that are too short."""
    t = F.trim(text)
    full = F.when(t.startswith("# "), t).otherwise(F.concat(F.lit("# "), key, F.lit("\n\n"), t))
    return F.when(F.length(t) >= least, full)


# ---------------------------------------------------------------- HTML

# Elements whose closing tags end a line on thread pages, and whose tags of either kind do on documentation pages.
THREAD_BLOCKS = ["p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote"]
DOC_BLOCKS = ["p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "br", "blockquote", "pre", "section", "article", "aside"]

_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_COMMON = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": "\u00a0"}


def _table(values: dict) -> Column:
    """A map that the planner turns into one literal."""
    part = lambda xs: F.split(F.lit("\x01".join(xs)), "\x01", -1)
    return F.map_from_arrays(part(values), part(values.values()))


def _decoded(ref: Column) -> Column:
    """What a character reference of a page stands for, by the rules of HTML 5; itself if for nothing."""
    body = F.substring(ref, 2, 40)
    short = _table({k: v for k, v in html5.items() if not k.endswith(";")})
    # Without its semicolon the longest name that it starts with counts.
    starts = F.filter(F.transform(F.sequence(F.length(body) - 1, F.lit(2), F.lit(-1)), lambda k: F.concat(F.try_element_at(short, F.substring(body, F.lit(1), k)), F.substring(body, k + 1, F.lit(40)))), lambda x: x.isNotNull())
    named = F.coalesce(F.try_element_at(_table(html5), body), F.when(F.length(body) > 2, F.try_element_at(starts, F.lit(1))), ref)
    hexadecimal = F.lower(F.substring(ref, 3, 1)) == "x"
    digits = F.regexp_replace(ref, "^&#[xX]?0*|;$", "")
    number = F.when(F.length(digits) > 7, F.lit(0x110000)).when(digits == "", F.lit(0)).when(hexadecimal, F.conv(digits, 16, 10).cast("int")).otherwise(F.try_to_number(digits, F.lit("9999999")).cast("int"))
    odd = _table({str(n): html.unescape(f"&#{n};") for n in range(160) if html.unescape(f"&#{n};") != chr(n)})

    def char(n):
        gone = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
        plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd")).when(n < 160, F.coalesce(F.try_element_at(odd, n.cast("string")), plain)).when(gone, F.lit("")).otherwise(plain)

    out = None
    for k, v in _COMMON.items():
        out = F.when(ref == k, F.lit(v)) if out is None else out.when(ref == k, F.lit(v))
    return out.when(ref.startswith("&#"), once(number, char)).otherwise(named)


def unescape(c: Column) -> Column:
    """Every character reference replaced, once: named ones by the table of HTML 5, and numbers."""

    def run(t):
        refs, between = F.regexp_extract_all(t, F.lit(_REFERENCE), 0), F.split(t, _REFERENCE, -1)
        joined = F.concat(between[0], F.array_join(F.zip_with(refs, F.slice(between, F.lit(2), F.size(refs)), lambda r, b: F.concat(_decoded(r), b)), ""))
        return F.when(t.contains("&"), joined).otherwise(t)

    return once(c, run)


def strip_html(c: Column) -> Column:
    """Text of a thread page: script and style bodies go, breaks and closing block tags are line ends, other tags blanks."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<script[^>]*>.*?</script>", "")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", "")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", "\n")
    t = F.regexp_replace(t, rf"(?i)</(?:{'|'.join(THREAD_BLOCKS)})>", "\n")
    t = unescape(F.regexp_replace(t, r"<[^>]+>", " "))
    return strip(F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), "\n{3,}", "\n\n"))


def strip_doc_html(c: Column) -> Column:
    """Text of a documentation page: script and style bodies are blanks, block tags of either kind are line ends."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<script[^>]*>.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", " ")
    t = F.regexp_replace(t, rf"(?i)</?(?:{'|'.join(DOC_BLOCKS)})(?:\s[^>]*)?>", "\n")
    t = unescape(F.regexp_replace(t, r"<[^>]+>", " "))
    t = F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), "\n[ \t]+", "\n")
    return strip(F.regexp_replace(t, "\n{3,}", "\n\n"))
