"""Record cleaning and small string helpers as column expressions (with the
same SQL text for the oracle where the two dialects differ)."""

from __future__ import annotations

from html.entities import name2codepoint
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inline markup tags stripped from titles (inner text kept).
INLINE_TAGS = ["i", "ref", "sub", "sup", "tt"]
MARKUP_RE = r"</?(?:" + "|".join(INLINE_TAGS) + r")\b[^>]*>"

# Character entities decoded in text, ``&amp;`` last so that
# an escaped entity is not decoded twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
            ("&amp;", "&")]

PARAGRAPH_RE = r"<p(?:\s[^>]*)?>([^<]*)"
SNIPPET_MIN = 150
SNIPPET_MAX = 200
URL_KEY_OFFSET = 20


def strip_markup(c: Column) -> Column:
    return F.regexp_replace(c, MARKUP_RE, "")


def strip_markup_sql(c: str) -> str:
    return f"regexp_replace({c}, '{MARKUP_RE}', '', 'g')"


def unescape(c: Column) -> Column:
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape_sql(c: str) -> str:
    for a, b in ENTITIES:
        c = f"replace({c}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return c


# Named entities of the published character sets, less those of XML itself.
XML_ENTITIES = ("amp", "lt", "gt", "quot", "apos")
NAMED = {n: chr(k) for n, k in sorted(name2codepoint.items()) if n not in XML_ENTITIES}
REFERENCE_RE = r"^(#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _each_reference(c: Column, decode) -> Column:
    """``c`` with every ``&`` and the piece that follows it replaced by
    ``decode(piece, name)``; ``name`` is empty where no reference begins."""
    parts = F.split(c, "&")
    tail = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
                       lambda p: decode(p, F.regexp_extract(p, REFERENCE_RE, 1)))
    return F.when(F.contains(c, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))).otherwise(c)


def _after(piece: Column, name: Column) -> Column:
    return F.substring(piece, F.length(name) + 2, F.lit(1 << 30))


def declare_entities(xml: Column) -> Column:
    """XML text whose named entities need no DTD: known ones become their
    character, unknown ones and bare ampersands become text, and those of XML
    itself and numeric references are left to the parser."""
    named = F.create_map(*[F.lit(x) for x in chain.from_iterable(NAMED.items())])

    def decode(piece: Column, name: Column) -> Column:
        known = F.try_element_at(named, name)
        kept = name.isin(*XML_ENTITIES) | name.startswith("#")
        return (F.when(known.isNotNull(), F.concat(known, _after(piece, name)))
                .when(kept, F.concat(F.lit("&"), piece)).otherwise(F.concat(F.lit("&amp;"), piece)))

    return _each_reference(xml, decode)


def decode_numeric(c: Column) -> Column:
    """Numeric character references as characters; impossible ones stay."""
    def decode(piece: Column, name: Column) -> Column:
        digits = F.when(name.startswith("#x"), F.conv(F.substring(name, 3, 8), 16, 10)).when(
            name.startswith("#"), F.substring(name, 2, 8)).try_cast("long")
        fine = digits.between(1, 0xD7FF) | digits.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fine, digits)), 8, "0")), "UTF-32")
        return F.when(fine, F.concat(char, _after(piece, name))).otherwise(F.concat(F.lit("&"), piece))

    return _each_reference(c, decode)


def url_key(c: Column) -> Column:
    """The record key at the end of a record URL: drop a fixed prefix width."""
    return F.substring(c, URL_KEY_OFFSET + 1, 1 << 30)


def snippet(html: Column) -> Column:
    """Longest paragraph's own text (first on ties), decoded; kept only when
    longer than 150 characters, cut to 200 + '...'."""
    ps = F.transform(F.regexp_extract_all(html, F.lit(PARAGRAPH_RE), 1), lambda p: unescape(p))
    lens = F.transform(ps, lambda p: F.length(p))
    best = F.element_at(ps, F.array_position(lens, F.array_max(lens)).cast("int"))
    best = F.when(F.size(ps) > 0, best)
    return (F.when(F.length(best) > SNIPPET_MAX, F.concat(F.substring(best, 1, SNIPPET_MAX), F.lit("...")))
            .when(F.length(best) > SNIPPET_MIN, best))


def snippet_sql(html: str) -> str:
    ps = f"list_transform(regexp_extract_all({html}, '{PARAGRAPH_RE}', 1), lambda p: {unescape_sql('p')})"
    best = (f"(SELECT CASE WHEN len(_ps) = 0 THEN NULL ELSE _ps[list_position(list_transform(_ps, lambda p: length(p)), "
            f"list_max(list_transform(_ps, lambda p: length(p))))] END FROM (SELECT {ps} AS _ps))")
    return (f"(SELECT CASE WHEN length(b) > {SNIPPET_MAX} THEN substring(b, 1, {SNIPPET_MAX}) || '...' "
            f"WHEN length(b) > {SNIPPET_MIN} THEN b END FROM (SELECT {best} AS b))")


def split_composite(key: Column, suffix_len: int) -> tuple[Column, Column]:
    """A key made of ``prefix || suffix`` (suffix of fixed width) split back."""
    n = F.length(key)
    return key.substr(F.lit(1), n - suffix_len), key.substr(n - suffix_len + 1, F.lit(suffix_len))
