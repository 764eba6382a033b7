"""URL column functions (URL-1..5, FIL-10..12), regex-based and null-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import _c

SCHEME_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def host(c: Column | str) -> Column:
    """Network location of an absolute URL ('' when there is none)."""
    return F.regexp_extract(_c(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def drop_dots(url: Column) -> Column:
    """``url`` without the path segments ``.`` and ``..``; each ``..`` takes the segment before it along."""
    parts = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)(/[^?#]*)(.*)$"
    segments = F.split(F.regexp_extract(url, parts, 2), "/")
    step = lambda acc, s: F.when(s == ".", acc).when(s == "..", F.regexp_replace(acc, "/[^/]*$", "")).otherwise(F.concat(acc, F.lit("/"), s))
    path = F.aggregate(F.slice(segments, 2, F.size(segments)), F.lit(""), step)
    end = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
    clean = F.concat(F.regexp_extract(url, parts, 1), path, end, F.regexp_extract(url, parts, 3))
    return F.when(url.rlike(r"^[^/?#]*//[^/?#]*(?:/[^?#]*)?/\.\.?(?:[/?#]|$)"), clean).otherwise(url)


def resolve(base: Column | str, href: Column | str) -> Column:
    """URL-1: resolve ``href`` against ``base`` (absolute, ``//``, ``/``, ``#``, ``?``, relative; dot segments are resolved)."""
    b, h = _c(base), _c(href)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(b, "#.*$", "")
    no_query = F.regexp_replace(b, "[?#].*$", "")
    directory = F.when(no_query.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*$"), F.concat(no_query, F.lit("/"))).otherwise(
        F.regexp_extract(no_query, "^(.*/)", 1)
    )
    return (
        F.when(h == F.lit(""), b)
        .when(h.rlike(SCHEME_RE), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), drop_dots(F.concat(origin, h)))
        .when(h.startswith("#"), F.concat(no_frag, h))
        .when(h.startswith("?"), F.concat(no_query, h))
        .otherwise(drop_dots(F.concat(directory, h)))
    )


def root_domain(c: Column | str) -> Column:
    """URL-2: last two labels of the host; null when the host has no dot (Q8)."""
    labels = F.split(host(c), r"\.")
    return F.when(
        F.size(labels) >= 2, F.concat(F.element_at(labels, -2), F.lit("."), F.element_at(labels, -1))
    )


def file_name(c: Column | str) -> Column:
    """URL-3: last path segment (text after the last '/')."""
    return F.substring_index(_c(c), "/", -1)


def absolutize(c: Column | str, prefix: str, repairs: list[tuple[str, str]] = ()) -> Column:
    """URL-4: prefix site-relative links with ``prefix``, then apply literal repairs."""
    col = _c(c)
    out = F.concat(F.lit(prefix), col)
    for a, b in repairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(col.startswith(prefix), col).otherwise(out)


def query_key(c: Column | str) -> Column:
    """URL-5: part after the last '?', up to its first '.'."""
    return F.substring_index(F.substring_index(_c(c), "?", -1), ".", 1)


def is_banned(domain: Column | str, banned: list[str], match: str = "suffix") -> Column:
    """FIL-10 for a short list: ``suffix`` (the domain or one above it) or ``contains`` (then 't.co' bans 'microsoft.com'); null = not banned."""
    d = _c(domain)
    arr = F.array(*[F.lit(b) for b in banned])
    if match == "contains":
        test = F.exists(arr, lambda b: F.instr(d, b) > 0)
    else:
        test = F.exists(arr, lambda b: (d == b) | d.endswith(F.concat(F.lit("."), b)))
    return F.coalesce(test, F.lit(False))


def one_segment_below(c: Column | str, prefix: str) -> Column:
    """FIL-11, anchored: the link is ``prefix`` and one more path segment, without a slash after it; null = no match."""
    u = _c(c)
    rest = F.substring(u, len(prefix) + 1, 1 << 30)
    return F.coalesce(u.startswith(prefix) & (rest != "") & ~rest.contains("/"), F.lit(False))


def host_suffixes(c: Column | str) -> Column:
    """The host of a URL and all domains above it, lower-case, without user, port and a final dot (``a.b.org``: ``a.b.org, b.org, org``)."""
    name = F.regexp_replace(F.regexp_replace(F.lower(host(c)), r"^[^@]*@|:\d*$", ""), r"\.$", "")
    labels = F.split(name, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(name != "", every).otherwise(F.array().cast("array<string>"))


def link_kind(c: Column | str, suffixes: tuple[str, ...] = ("pdf", "docx")) -> Column:
    """FIL-12: 'file' for links ending in one of ``suffixes`` (case-sensitive), else 'page'."""
    pat = r"\.(" + "|".join(suffixes) + r")$"
    return F.when(_c(c).rlike(pat), F.lit("file")).otherwise(F.lit("page"))
