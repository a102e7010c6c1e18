"""Reading values out of HTML with regular expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup that carries no text.
SCRIPT_OR_STYLE = r"(?is)<(script|style)\b.*?</\1\s*>"
COMMENT = r"(?s)<!--.*?-->"
TAG = r"(?s)<[!/a-zA-Z][^>]*>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_markup(c) -> Column:
    """Drop scripts, styles, comments and tags; entities stay as written."""
    text = _col(c)
    bare = text
    for pattern in (SCRIPT_OR_STYLE, COMMENT, TAG):
        bare = F.regexp_replace(bare, pattern, "")
    # Most review text has no markup at all, so the three passes are skipped.
    return F.when(F.contains(text, F.lit("<")), bare).otherwise(text)


def _entity_map() -> Column:
    """name -> character, from the HTML 4 table of the standard library; two literals, since a call for each entry takes long."""
    pairs = [*((name, chr(code)) for name, code in sorted(name2codepoint.items())), ("apos", "'")]
    names, chars = (F.split(F.lit("\u0001".join(x)), "\u0001") for x in zip(*pairs, strict=True))
    return F.map_from_arrays(names, chars)


def decode_entities(c) -> Column:
    """Decode named and numeric character references, once.

    The text is cut in front of every ``&``; each piece is looked at on its
    own, so the ``&`` that comes out of ``&amp;`` cannot start a new entity.
    """
    text = _col(c)
    table = _entity_map()

    def code_point(p: Column) -> Column:
        hexa = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]{1,6});", 1)
        deci = F.regexp_extract(p, r"^&#([0-9]{1,7});", 1)
        number = F.coalesce(F.conv(F.nullif(hexa, F.lit("")), 16, 10), F.nullif(deci, F.lit(""))).cast("long")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^&([A-Za-z][A-Za-z0-9]*);", 1)
        char = F.coalesce(
            F.when(name != "", F.try_element_at(table, name)),
            F.when(p.startswith("&#"), code_point(p)),
        )
        rest = F.substring(p, F.locate(";", p) + 1, F.length(p))
        return F.when(char.isNotNull(), F.concat(char, rest)).otherwise(p)

    pieces = F.transform(F.split(text, "(?=&)"), piece)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def html_to_text(c) -> Column:
    """Visible text: markup dropped, entities decoded."""
    return decode_entities(strip_markup(c))


def first_match(c, pattern: str, group: int = 1) -> Column:
    """First match of a pattern, null when there is none."""
    text = _col(c)
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def all_matches(c, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), group)
