"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that count as white space when text is stripped.
WHITESPACE_POINTS = (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
    8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
    8232, 8233, 8239, 8287, 12288,
)
WHITESPACE = "".join(map(chr, WHITESPACE_POINTS))

# Named character references decoded in page text; the ampersand is last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&nbsp;": chr(160),
    "&copy;": chr(169),
    "&reg;": chr(174),
    "&deg;": chr(176),
    "&middot;": chr(183),
    "&ndash;": chr(8211),
    "&mdash;": chr(8212),
    "&lsquo;": chr(8216),
    "&rsquo;": chr(8217),
    "&ldquo;": chr(8220),
    "&rdquo;": chr(8221),
    "&hellip;": chr(8230),
    "&amp;": "&",
}

# Words that mark an article as being about the city.
CITY_WORDS = (
    "new york",
    "nyc",
    "manhattan",
    "brooklyn",
    "queens",
    "bronx",
    "staten island",
    "new york city",
)

# HTML elements that close an open paragraph.
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|center|dd|details|dialog|dir|div|dl|dt|fieldset|figcaption|figure|"
    "footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|main|menu|nav|ol|p|pre|section|table|td|th|tr|ul"
)

HEADING_PATTERN = r"(?s)<[hH][23][\s/>].*$"
UNSEEN_PATTERN = r"(?s)<(?:!--.*?-->|(?i:script[\s>].*?</script>|style[\s>].*?</style>))"
PARAGRAPH_PATTERN = r"<[pP](?:\s[^>]*)?>"
PARAGRAPH_END_PATTERN = rf"(?is)</?(?:{BLOCK_TAGS})(?:[\s/][^>]*)?>.*$"
TAG_PATTERN = r"<[^>]*>"
HREF_PATTERN = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def long_enough(value: Column, least: int) -> Column:
    """At least ``least`` characters once stripped; null text is never long enough."""
    return F.coalesce(F.length(strip(value)) >= least, F.lit(False))


def strip_citations(value: Column) -> Column:
    """Remove markers such as [1] or [ 5 ]."""
    return F.regexp_replace(value, r"\[\s*\d+\s*\]", "")


def safe_name(value: Column) -> Column:
    """A name that can be part of a path: blanks to "_", slashes to "-"."""
    return F.translate(value, " /", "_-")


def numbers_in(value: Column) -> Column:
    """Distinct numbers in the text, thousands separators removed first."""
    plain = F.regexp_replace(value, r"(?U)(\d),(\d{3})\b", "$1$2")
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(r"(?U)\b\d+(?:\.\d+)?\b"), 0))


def contains_any(value: Column, words) -> Column:
    """Case-blind test for any of a short list of words."""
    lowered = F.lower(value)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w.lower())) for w in words])


def stable_key(*parts: Column) -> Column:
    """A 60-bit key for dimension rows, equal on every run and in every engine.

    For dimensions of up to some millions of rows; the star plan checks uniqueness.
    Nulls take part as an empty value behind a separator.
    """
    joined = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def decode_entities(value: Column) -> Column:
    decoded = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), ENTITIES.items(), value)
    return F.when(F.contains(value, F.lit("&")), decoded).otherwise(value)


def intro_paragraphs(html: Column) -> Column:
    """Array of the paragraph texts before the first h2 or h3 of a page.

    A paragraph ends at its closing tag or at the next block element, as browsers
    close it. Its text nodes are stripped and joined by one blank; paragraphs
    without text are dropped.
    """
    head = F.regexp_replace(F.regexp_replace(html, UNSEEN_PATTERN, ""), HEADING_PATTERN, "")
    pieces = F.split(head, PARAGRAPH_PATTERN, -1)
    # all pieces but the first, without asking for their number, which would split the page again
    bodies = F.slice(pieces, 2, 1_000_000_000)

    def paragraph_text(body: Column) -> Column:
        nodes = F.split(F.regexp_replace(body, PARAGRAPH_END_PATTERN, ""), TAG_PATTERN, -1)
        shown = F.transform(nodes, lambda node: strip(decode_entities(node)))
        return F.array_join(F.filter(shown, lambda node: node != ""), " ")

    return F.filter(F.transform(bodies, paragraph_text), lambda text: text != "")


def link_targets(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(HREF_PATTERN), 1)
