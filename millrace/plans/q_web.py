"""Registered queries: HTML extraction, links and URLs over ``pages`` (HTM-1..5, URL-1..5, FIL-10..13, AGG-7, AGG-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import urls as U
from millrace.operators import elements as EL
from millrace.plans import sqlkit as S
from millrace.plans.catalog import query
from millrace.session import table

# Test parameters of our own.
BANNED = ["example.org", "x.com", "t.co"]
BAN_TABLE = ["example.org", "x.com", "t.co", "co.uk", "cdn.example.net"]
SITE_PREFIX = "https://www.example.org"
LINK_PATTERN = r"^https?://[^/]+/[a-z]{2}/"

BLOCKS = H.BLOCK_TAGS
# The entities that the test pages hold, for the oracles ('&amp;' last).
ENT = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _unescape(e: str) -> str:
    for a, b in ENT:
        e = f"replace({e}, {S.lit(a)}, {S.lit(b)})"
    return e


def _strip_invisible(e: str) -> str:
    e = f"regexp_replace({e}, '(?s)<!--.*?-->', '', 'g')"
    e = f"regexp_replace({e}, '(?is)<script\\b.*?</script\\s*>', '', 'g')"
    return f"regexp_replace({e}, '(?is)<style\\b.*?</style\\s*>', '', 'g')"


def _collapse(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '\\s+', ' ', 'g'), '^ | $', '', 'g')"


def _drop_tags(e: str, sep: str = "") -> str:
    return f"regexp_replace({e}, '<[^>]*>', {S.lit(sep)}, 'g')"


CUT = f"'(?is)(</p\\s*>|</?(?:{BLOCKS})(?:[\\s/>]|$)).*$'"


def _paragraphs_list(e: str) -> str:
    parts = f"regexp_split_to_array({_strip_invisible(e)}, '(?i)<p(?:\\s[^>]*)?>')"
    cut = "regexp_replace(p, " + CUT + ", '')"
    return f"list_transform(list_slice({parts}, 2, len({parts})), lambda p: {_unescape(_drop_tags(cut))})"


# ---- HTML ----------------------------------------------------------------------

@query(
    "htm_body_text",
    "SELECT page_id, " + _collapse(_unescape(_drop_tags(
        f"regexp_extract({_strip_invisible('html')}, '(?is)<body\\b[^>]*>(.*?)(?:</body\\s*>|\\z)', 1)", " "))) + " AS text FROM pages",
)
def htm_body_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.body_text("html").alias("text"))


@query("htm_paragraphs", "SELECT page_id, array_to_string(" + _paragraphs_list("html") + ", ' ') AS text FROM pages")
def htm_paragraphs(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.paragraphs("html").alias("text"))


@query(
    "agg_ordered_concat",
    "SELECT page_id, array_to_string(" + _paragraphs_list("html") + ", ' ') AS text FROM pages WHERE len(" + _paragraphs_list("html") + ") > 0",
)
def agg_ordered_concat(spark, sf):
    """AGG-13: paragraphs as rows, then an ordered concatenation per page (grouped by page, bounded by page size)."""
    rows = table(spark, sf, "pages").select("page_id", F.posexplode(H.paragraph_texts("html")).alias("pos", "t"))
    g = rows.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("parts"))
    return g.select("page_id", F.array_join(F.transform("parts", lambda x: x["t"]), " ").alias("text"))


# Tags beside those of the pages, one link of each kind and two that are none.
MORE_LINKS = """<link href="s.css"><!-- <a href="gone"> --><A HREF='y'><a class=k href=z?a=1&amp;b=2><a name="n">"""


@query(
    "htm_links",
    "SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS href FROM (SELECT page_id, "
    "list_concat(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), ['y', 'z?a=1&b=2']) AS l FROM pages)",
)
def htm_links(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.concat("html", F.lit(MORE_LINKS)).alias("html"))
    x = p.select("page_id", F.posexplode(H.links("html")).alias("pos", "href"))
    return x.withColumn("pos", F.col("pos").cast("long"))


def _class_block_sql(e: str, cls: str, tag: str = "div") -> str:
    inner = f"regexp_extract({_strip_invisible(e)}, '(?is)<{tag}\\b[^>]*\\bclass=\"{cls}\"[^>]*>(.*?)</{tag}\\s*>', 1)"
    frags = f"regexp_split_to_array({inner}, '<[^>]*>')"
    text = f"array_to_string(list_transform({frags}, lambda f: regexp_replace({_unescape('f')}, '^\\s+|\\s+$', '', 'g')), '')"
    return f"CASE WHEN length({inner}) > 0 THEN {text} END"


@query("htm_class_block", f"SELECT page_id, {_class_block_sql('html', 'ad')} AS text FROM pages")
def htm_class_block(spark, sf):
    return EL.class_block(table(spark, sf, "pages"), "ad")


# Blocks put in front of every page in turn, and the text that each has by hand.
BLOCK_SHAPES = [
    ("<div class='big note'> a &#233;<div>b</div>&#x41; </div>", "a ébA"),
    ("<div id=q class=note>x &eacute;<br>y<!-- </div> --></div>", "x éy"),
    ('<DIV title=" class=note "><p>no</DIV><div\nclass="note wide" > 1 &lt;2<p>3</div>4', "1 <23"),
    ("<section class=note>no</section><div class = 'note'>5<div>6", None),
]


@query(
    "htm_class_shapes",
    "SELECT page_id, CASE " + " ".join(f"WHEN page_id % 4 = {i} THEN {S.lit(t)}" for i, (_, t) in enumerate(BLOCK_SHAPES) if t)
    + " ELSE '56' || tail END AS text FROM (SELECT page_id, array_to_string(list_transform(regexp_split_to_array(regexp_replace("
    + _strip_invisible("html") + ", '<![^>]*>', '', 'g'), '<[^>]*>'), lambda f: regexp_replace(" + _unescape("f") + ", '^\\s+|\\s+$', '', 'g')), '') AS tail FROM pages)",
)
def htm_class_shapes(spark, sf):
    """HTM-4 on shapes the pages lack: other quotes, none, several classes, nesting, entities, no end tag (all of the page is inside)."""
    p = table(spark, sf, "pages")
    front = F.get(F.array(*[F.lit(h) for h, _ in BLOCK_SHAPES]), (F.col("page_id") % 4).cast("int"))
    return EL.class_block(p.select("page_id", F.concat(front, F.col("html")).alias("html")), "note")


def _digest_html(e_page_id: str, e_html: str) -> str:
    return f"replace({e_html}, '<p><b>', '<div id=\"lead-' || CAST({e_page_id} AS VARCHAR) || '\"><p><b>')"


def _digest_sql(h: str, marker: str) -> str:
    section = f"regexp_extract({_strip_invisible(h)}, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)"
    heading = _collapse(_unescape(_drop_tags(f"regexp_extract({section}, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1)")))
    head_line = f"CASE WHEN strpos({heading}, {S.lit(marker)}) > 0 THEN {heading} || chr(10) ELSE '' END"
    parts = f"regexp_split_to_array({section}, '\\sid=\"')"
    first_p = "regexp_replace(regexp_extract(p, '(?is)<p(?:\\s[^>]*)?>(.*)$', 1), " + CUT + ", '')"
    entry = ("regexp_extract(p, '^([^\"]*)\"', 1) || chr(10) || CASE WHEN regexp_matches(p, '(?is)<p(?:\\s[^>]*)?>') "
             f"THEN {_unescape(_drop_tags(first_p))} || chr(10) ELSE '' END")
    return f"{head_line} || array_to_string(list_transform(list_slice({parts}, 2, len({parts})), lambda p: {entry}), '')"


DIGEST_MARKER = "e"


@query("htm_section_digest", f"SELECT page_id, {_digest_sql(_digest_html('page_id', 'html'), DIGEST_MARKER)} AS digest FROM pages")
def htm_section_digest(spark, sf):
    """The ids that the oracle puts in double quotes stand here in single quotes, bare or as entities as well."""
    p = table(spark, sf, "pages")
    no = F.col("page_id").cast("string")
    kind = F.col("page_id") % 4
    tag = (
        F.when(kind == 0, F.concat(F.lit('<div id="lead-'), no, F.lit('">')))
        .when(kind == 1, F.concat(F.lit("<DIV class=x ID = 'lead-"), no, F.lit("'>")))
        .when(kind == 2, F.concat(F.lit("<div data-id=\"no\" id=lead-"), no, F.lit(">")))
        .otherwise(F.concat(F.lit('<div title=" id=no" id="&#108;ead&#x2d;'), no, F.lit('">')))
    )
    return EL.section_digest(p.select("page_id", F.replace(F.col("html"), F.lit("<p><b>"), F.concat(tag, F.lit("<p><b>"))).alias("html")), "article", "h1", DIGEST_MARKER)


# ---- links and URLs ------------------------------------------------------------

def derived_links(spark, sf):
    """Links of every kind, derived from each page's anchors by position: ``(page_id, pos, base, href)``."""
    x = table(spark, sf, "pages").select("page_id", F.col("url").alias("base"), F.posexplode(H.links("html")).alias("pos", "raw"))
    word = F.substr(F.col("raw"), F.lit(2))
    href = (
        F.when(F.col("pos") == 0, F.col("raw"))
        .when(F.col("pos") == 1, F.concat(F.lit("https://docs.example.com"), F.col("raw")))
        .when(F.col("pos") == 2, F.concat(F.lit("//cdn.example.net"), F.col("raw")))
        .when(F.col("pos") == 3, word)
        .when(F.col("pos") == 4, F.concat(F.lit("#"), word))
        .when(F.col("pos") == 5, F.concat(F.lit("mailto:"), word, F.lit("@example.com")))
        .when(F.col("pos") == 6, F.concat(F.lit("http://localhost"), F.col("raw")))
        .when(F.col("pos") == 7, F.concat(F.col("raw"), F.lit(".pdf")))
        .when(F.col("pos") == 8, F.concat(F.col("raw"), F.lit(".PDF")))
        .otherwise(F.concat(F.lit("https://www.t.co.uk"), F.col("raw"), F.lit(".docx")))
    )
    return x.select("page_id", F.col("pos").cast("long").alias("pos"), "base", href.alias("href"))


LINKS_SQL = """(SELECT page_id, pos, base,
  CASE pos WHEN 0 THEN raw WHEN 1 THEN 'https://docs.example.com' || raw WHEN 2 THEN '//cdn.example.net' || raw
           WHEN 3 THEN substr(raw, 2) WHEN 4 THEN '#' || substr(raw, 2) WHEN 5 THEN 'mailto:' || substr(raw, 2) || '@example.com'
           WHEN 6 THEN 'http://localhost' || raw WHEN 7 THEN raw || '.pdf' WHEN 8 THEN raw || '.PDF'
           ELSE 'https://www.t.co.uk' || raw || '.docx' END AS href
FROM (SELECT page_id, url AS base, unnest(range(len(l))) AS pos, unnest(l) AS raw
      FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)))"""

SCHEME = "'^[A-Za-z][A-Za-z0-9+.\\-]*:'"


def _resolve_sql(b: str, h: str) -> str:
    scheme = f"regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)"
    origin = f"regexp_extract({b}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
    no_frag = f"regexp_replace({b}, '#.*$', '')"
    no_query = f"regexp_replace({b}, '[?#].*$', '')"
    directory = (f"CASE WHEN regexp_matches({no_query}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/]*$') THEN {no_query} || '/' "
                 f"ELSE regexp_extract({no_query}, '^(.*/)', 1) END")
    return (f"CASE WHEN {h} = '' THEN {b} WHEN regexp_matches({h}, {SCHEME}) THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} WHEN starts_with({h}, '/') THEN {origin} || {h} "
            f"WHEN starts_with({h}, '#') THEN {no_frag} || {h} WHEN starts_with({h}, '?') THEN {no_query} || {h} "
            f"ELSE {directory} || {h} END")


def _root_sql(u: str) -> str:
    host = f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)"
    labels = f"string_split({host}, '.')"
    return f"CASE WHEN len({labels}) >= 2 THEN {labels}[-2] || '.' || {labels}[-1] END"


RESOLVED_SQL = f"(SELECT page_id, pos, base, href, {_resolve_sql('base', 'href')} AS link FROM {LINKS_SQL})"


def resolved(spark, sf):
    l = derived_links(spark, sf)
    return l.withColumn("link", U.resolve("base", "href"))


@query("url_resolve", f"SELECT page_id, pos, href, link FROM {RESOLVED_SQL}")
def url_resolve(spark, sf):
    return resolved(spark, sf).select("page_id", "pos", "href", "link")


@query("url_root_domain", f"SELECT page_id, pos, link, {_root_sql('link')} AS domain FROM {RESOLVED_SQL}")
def url_root_domain(spark, sf):
    return resolved(spark, sf).select("page_id", "pos", "link", U.root_domain("link").alias("domain"))


@query("url_filename", "SELECT page_id, pos, split_part(link, '/', -1) AS file_name FROM " + RESOLVED_SQL)
def url_filename(spark, sf):
    return resolved(spark, sf).select("page_id", "pos", U.file_name("link").alias("file_name"))


@query(
    "url_absolutize",
    f"SELECT page_id, pos, CASE WHEN starts_with(href, {S.lit(SITE_PREFIX)}) THEN href "
    f"ELSE replace({S.lit(SITE_PREFIX)} || href, '.org./', '.org/') END AS link FROM {LINKS_SQL}",
)
def url_absolutize(spark, sf):
    l = derived_links(spark, sf)
    return l.select("page_id", "pos", U.absolutize("href", SITE_PREFIX, [(".org./", ".org/")]).alias("link"))


@query("url_query_key", "SELECT page_id, split_part(split_part(url, '?', -1), '.', 1) AS key FROM pages")
def url_query_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.query_key("url").alias("key"))


def _banned_sql(d: str) -> str:
    return f"coalesce(len(list_filter({S.str_list(BANNED)}, lambda b: strpos({d}, b) > 0)) > 0, false)"


@query(
    "fil_banned_domain",
    f"SELECT page_id, pos, link, domain FROM (SELECT page_id, pos, link, {_root_sql('link')} AS domain FROM {RESOLVED_SQL}) "
    f"WHERE NOT {_banned_sql('domain')}",
)
def fil_banned_domain(spark, sf):
    r = resolved(spark, sf).select("page_id", "pos", "link", U.root_domain("link").alias("domain"))
    return r.where(~U.is_banned(F.col("domain"), BANNED, "contains"))


def _host_banned_sql(u: str) -> str:
    """Whether a domain of the ban table is the host of ``u`` or stands above it."""
    h = f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)"
    return f"len(list_filter({S.str_list(BAN_TABLE)}, lambda b: {h} = b OR ends_with({h}, '.' || b))) > 0"


def ban_table(spark):
    return spark.createDataFrame([(b,) for b in BAN_TABLE], "domain string")


@query("fil_banned_hosts", f"SELECT page_id, pos, link FROM {RESOLVED_SQL} WHERE NOT {_host_banned_sql('link')}")
def fil_banned_hosts(spark, sf):
    """FIL-10 with a ban table: hosts meet it at all their suffixes, so 'microsoft.com' is not banned by 't.co'."""
    from millrace.operators.bans import drop_banned

    return drop_banned(resolved(spark, sf).select("page_id", "pos", "link"), ban_table(spark))


@query(
    "fil_link_pattern",
    f"SELECT page_id, pos, link FROM {RESOLVED_SQL} WHERE regexp_matches(link, {S.lit(LINK_PATTERN)})",
)
def fil_link_pattern(spark, sf):
    return resolved(spark, sf).select("page_id", "pos", "link").where(F.col("link").rlike(LINK_PATTERN))


# Fixed value: links one segment below this page are kept.
SEGMENT_PREFIX = "https://docs.example.com/"


@query("fil_link_segment", f"SELECT page_id, pos, link FROM {RESOLVED_SQL} WHERE regexp_matches(link, '^https://docs\\.example\\.com/[^/]+$')")
def fil_link_segment(spark, sf):
    """FIL-11, anchored: links of exactly one segment below a page."""
    return resolved(spark, sf).select("page_id", "pos", "link").where(U.one_segment_below("link", SEGMENT_PREFIX))


@query(
    "fil_link_kind",
    f"SELECT page_id, pos, link, CASE WHEN regexp_matches(link, '\\.(pdf|docx)$') THEN 'file' ELSE 'page' END AS kind FROM {RESOLVED_SQL}",
)
def fil_link_kind(spark, sf):
    return resolved(spark, sf).select("page_id", "pos", "link", U.link_kind("link").alias("kind"))


@query("agg_distinct_links", f"SELECT DISTINCT link FROM {RESOLVED_SQL}")
def agg_distinct_links(spark, sf):
    return resolved(spark, sf).select("link").distinct()


SEEDS_SQL = ("(SELECT " + _root_sql("url") + " AS source, url, CASE WHEN strpos(url, '?') > 0 THEN NULL ELSE 2 END AS max_depth FROM pages)")


def seeds(spark, sf):
    p = table(spark, sf, "pages")
    depth = F.when(F.instr("url", "?") > 0, F.lit(None).cast("int")).otherwise(F.lit(2))
    return p.select(U.root_domain("url").alias("source"), "url", depth.alias("max_depth"))


@query("fil_valid_seeds", f"SELECT source, url, max_depth FROM {SEEDS_SQL} WHERE source IS NOT NULL AND url IS NOT NULL AND max_depth IS NOT NULL")
def fil_valid_seeds(spark, sf):
    return seeds(spark, sf).dropna("any", subset=["source", "url", "max_depth"])


# ---- link frontier ---------------------------------------------------------------

def page_edges(spark, sf):
    """Edges derived from each page's anchors: position ``i`` points at page ``3 * page_id + i`` when it exists;
    position 5 also yields a PDF file link.  ``(src, dst, kind)``."""
    p = table(spark, sf, "pages")
    a = p.select("page_id", F.col("url").alias("src"), F.posexplode(H.links("html")).alias("pos", "raw"))
    tgt = p.select(F.col("page_id").alias("tid"), F.col("url").alias("dst"))
    to_pages = a.join(tgt, F.col("tid") == F.col("page_id") * 3 + F.col("pos")).select("src", "dst", F.lit("page").alias("kind"))
    files = a.where(F.col("pos") == 5).select("src", F.concat(U.resolve("src", "raw"), F.lit(".pdf")).alias("dst"), F.lit("file").alias("kind"))
    return to_pages.unionByName(files)


EDGES_SQL = f"""(SELECT a.src, q.url AS dst, 'page' AS kind FROM
   (SELECT page_id, url AS src, unnest(range(len(l))) AS pos, unnest(l) AS raw
    FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)) a
   JOIN pages q ON q.page_id = a.page_id * 3 + a.pos
 UNION ALL
 SELECT src, {_resolve_sql('src', 'raw')} || '.pdf', 'file' FROM
   (SELECT page_id, url AS src, unnest(range(len(l))) AS pos, unnest(l) AS raw
    FROM (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)) WHERE pos = 5)"""


@query(
    "pip_link_frontier",
    f"""WITH RECURSIVE seeds AS (SELECT * FROM {SEEDS_SQL} WHERE source IS NOT NULL AND url IS NOT NULL AND max_depth IS NOT NULL),
edges AS (SELECT * FROM {EDGES_SQL} WHERE NOT {_banned_sql(_root_sql('dst'))}),
walk(source, url, kind, depth, rest) AS (
  SELECT DISTINCT source, url, 'page', 0, max_depth FROM seeds
  UNION
  SELECT w.source, e.dst, e.kind, w.depth + 1, w.rest - 1 FROM walk w JOIN edges e ON e.src = w.url
  WHERE w.kind = 'page' AND (w.rest > 0 OR w.rest = 0 AND e.kind = 'file'))
SELECT source, url, kind, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY source, url, kind""",
)
def pip_link_frontier(spark, sf):
    from millrace.operators import frontier as FR

    return FR.expand(seeds(spark, sf), page_edges(spark, sf), BANNED, "contains")
