"""HTML column functions: visible text, paragraphs, links (HTM-1, 2, 5), and the tokens, attributes and entities
that the element table (``millrace.operators.elements``) is made of.

Scripts, styles and comments are removed first, so a ``</p>`` inside a script
cannot end a paragraph (Q17).
"""

from __future__ import annotations

import json
from functools import cache
from html import unescape as unescape_one
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import _c

# Block tags that end an open paragraph.
BLOCK_TAGS = "p|div|article|section|nav|header|footer|aside|main|ul|ol|li|table|form|h1|h2|h3|h4|h5|h6|body|html"

# White space that a text is trimmed of besides plain blanks is left to ``collapse_ws``.
ENTITY = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);?"


@cache
def entity_table() -> str:
    """Named entities and the numeric ones that stand for other characters, as JSON: built from the standard's table in Python's library."""
    named = {name.removesuffix(";") + ";": text for name, text in html5.items()}
    # without a semicolon only the old names count
    named |= {name: text for name, text in html5.items() if not name.endswith(";")}
    named |= {f"#{n}": unescape_one(f"&#{n};") for n in range(128, 160)}
    return json.dumps(named)


def _numeric(digits: Column, base: int) -> Column:
    """The character with a code point; what is no character is U+FFFD."""
    code = F.when(F.length(digits) <= 8, F.conv(digits, base, 10).cast("long")).otherwise(F.lit(1 << 40))
    fine = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    moved = F.get(F.array(*[F.lit(unescape_one(f"&#{n};")) for n in range(128, 160)]), (F.least(code, F.lit(160)) - 128).cast("int"))
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(fine, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    return F.when(code.between(128, 159), moved).otherwise(plain)


def _entity(x: Column) -> Column:
    """What an entity stands for; itself where it is none."""
    table = F.from_json(F.lit(entity_table()), "map<string,string>")
    name = F.substr(x, F.lit(2))
    digits = F.regexp_extract(x, "^&#[xX]?0*([0-9A-Fa-f]*)", 1)
    return (
        F.when(x.rlike("^&#[0-9]"), _numeric(F.when(digits == "", "0").otherwise(digits), 10))
        .when(x.rlike("^&#[xX]"), _numeric(F.when(digits == "", "0").otherwise(digits), 16))
        .otherwise(F.coalesce(F.try_element_at(table, name), x))
    )


def unescape(c: Column) -> Column:
    """Text with its entities decoded once: named (as the HTML standard lists them), decimal and hexadecimal.

    A name without its semicolon counts if the standard lists it so; unknown names stay. A no-break space
    becomes a plain one.
    """
    parts = F.regexp_extract_all(c, F.lit(rf"{ENTITY}|&|[^&]+"), 0)
    whole = F.array_join(F.transform(parts, lambda x: F.when(x.startswith("&") & (x != "&"), _entity(x)).otherwise(x)), "")
    return F.when(F.instr(c, "&") > 0, F.replace(whole, F.lit("\u00a0"), F.lit(" "))).otherwise(c)


def strip_invisible(c: Column | str) -> Column:
    """Remove comments, scripts and styles (with their content)."""
    c = F.regexp_replace(_c(c), r"(?s)<!--.*?-->", "")
    c = F.regexp_replace(c, r"(?is)<script\b.*?</script\s*>", "")
    return F.regexp_replace(c, r"(?is)<style\b.*?</style\s*>", "")


def drop_tags(c: Column, sep: str = "") -> Column:
    return F.regexp_replace(c, r"<[^>]*>", sep)


def collapse_ws(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"^ | $", "")


def body_text(c: Column | str) -> Column:
    """HTM-1: visible text of the body, tags as spaces, entities unescaped, whitespace collapsed.

    The body starts after ``</head>`` or ``<body>``, whichever comes first; a page with neither is all body but its
    title.  It goes to the end of the page: browsers add what follows a ``</body>`` to the body.
    """
    page, start = strip_invisible(c), r"(?is)\A.*?(?:</head\s*>|<body\b[^>]*>)"
    untitled = F.regexp_replace(page, r"(?is)<title\b.*?</title\s*>", "")
    body = F.when(page.rlike(start), F.regexp_replace(page, start, "")).otherwise(untitled)
    return collapse_ws(unescape(drop_tags(body, " ")))


def _paragraph_parts(c: Column | str) -> Column:
    parts = F.split(strip_invisible(c), r"(?i)<p(?:\s[^>]*)?>")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def paragraph_texts(c: Column | str) -> Column:
    """Texts of all paragraphs; one ends at the next ``<p``, ``</p>`` or block tag (Q17)."""
    cut = rf"(?is)(</p\s*>|</?(?:{BLOCK_TAGS})(?:[\s/>]|$)).*$"
    return F.transform(_paragraph_parts(c), lambda p: unescape(drop_tags(F.regexp_replace(p, cut, ""))))


def paragraphs(c: Column | str) -> Column:
    """HTM-2: all paragraph texts joined by one space."""
    return F.array_join(paragraph_texts(c), " ")


def links(c: Column | str) -> Column:
    """HTM-5: targets of the ``<a>`` tags that have one, in document order, entities decoded; quoted either way or bare."""
    tags = F.regexp_extract_all(strip_invisible(c), F.lit(r"(?i)<a\s[^>]*>"), 0)
    value = r"""(?i)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    found = F.filter(tags, lambda t: t.rlike(value))
    return F.transform(found, lambda t: unescape(F.concat(*[F.regexp_extract(t, value, i) for i in (1, 2, 3)])))


# Elements that have no end tag.
VOID_TAGS = "area base br col embed hr img input link meta source track wbr".split()

TAG = r"""</?[A-Za-z][^\s/>]*(?:"[^"]*"|'[^']*'|[^'">])*>"""


def tokens(c: Column | str) -> Column:
    """The page as an array of tags, texts and what has none (comments, scripts, styles, declarations), in order; joined they are the page."""
    raw = r"<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|<[!?][^>]*>"
    return F.regexp_extract_all(_c(c), F.lit(rf"(?is){raw}|{TAG}|[^<]+|<"), 0)


def is_tag(token: Column) -> Column:
    return token.rlike(rf"(?is)\A{TAG}\z") & ~token.rlike(r"(?i)\A<(script|style)\b")


def tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))


def attributes(tag: Column) -> Column:
    """``map<string,string>`` of a start tag: quoted either way or bare, entities decoded, names lower-cased; the first of a name counts."""
    pair = r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>=`]+)))?"""
    inner = F.regexp_replace(tag, r"\A<[^\s/>]*|/?>\z", "")
    found = F.regexp_extract_all(inner, F.lit(pair), 0)
    entry = lambda x: F.struct(F.lower(F.regexp_extract(x, pair, 1)).alias("key"), unescape(F.concat(*[F.regexp_extract(x, pair, i) for i in (2, 3, 4)])).alias("value"))
    entries = F.transform(found, entry)
    names = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1))


def texts(parts: Column) -> Column:
    """The texts among tokens, entities decoded."""
    return F.transform(F.filter(parts, lambda x: ~x.startswith("<") | (x == "<")), unescape)
