"""Element table of stored pages: every element with its start, end and depth (HTM-3, HTM-4).

A page is a list of tokens. Start and end tags of one name are matched by their running depth, which a window
counts: the start that opens depth ``d`` is closed by the next end tag that leaves it. So an element is an
interval of token numbers, and "inside" is interval containment. Nothing is walked row by row, and a page's
texts stay where they are: only its tags are rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import html as H


def with_tokens(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("tokens", H.tokens(html))


def element_table(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``(key, tag, start, end, nest, depth, token)`` of ``pages(key, tokens)``; ``key`` is unique.

    ``start`` is the number of the start tag, ``end`` that of the token which ends the element (past the last
    one: the number of tokens). ``nest``: how many elements of the same name are open, itself included.
    ``depth``: how many elements are. End tags that close nothing are ignored. A paragraph ends at the next
    block tag; another element without an end tag ends with the element around it.
    """
    rows = pages.select(key, F.size("tokens").alias("n"), F.posexplode("tokens").alias("pos", "token")).where(H.is_tag(F.col("token")))
    closing = F.col("token").startswith("</")
    rows = rows.select(key, "n", "pos", H.tag_name(F.col("token")).alias("tag"), closing.alias("closing"), F.when(~closing, F.col("token")).alias("token"))
    rows = rows.repartition(key)  # all windows below are within a page
    void = F.col("tag").isin(H.VOID_TAGS)
    rows = rows.where(~(void & F.col("closing")))
    page = Window.partitionBy(key).orderBy("pos")
    rest = page.rowsBetween(1, Window.unboundedFollowing)
    block = F.col("tag").isin(H.BLOCK_TAGS.split("|"))
    rows = rows.withColumn("next_block", F.min(F.when(block, F.col("pos"))).over(rest))

    named = Window.partitionBy(key, "tag").orderBy("pos")
    upto = named.rowsBetween(Window.unboundedPreceding, 0)
    before = named.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("sum", F.sum(F.when(F.col("closing"), -1).otherwise(1)).over(upto))
    low = F.least(F.lit(0), F.coalesce(F.min("sum").over(before), F.lit(0)))
    rows = rows.withColumn("low", low)
    rows = rows.where(~F.col("closing") | (F.col("sum") >= F.col("low")))  # others close nothing
    level = F.col("sum") - F.col("low") + F.when(F.col("closing"), 1).otherwise(0)
    rows = rows.withColumn("nest", level)
    same = Window.partitionBy(key, "tag", "nest").orderBy("pos")
    after, shuts = F.lead("pos").over(same), F.lead("closing").over(same)
    rows = rows.withColumn("end", F.when(shuts, after)).where(~F.col("closing"))
    end = F.when(void, F.col("pos")).when(F.col("tag") == "p", F.least(F.coalesce("end", "next_block"), "next_block")).otherwise(F.col("end"))
    rows = rows.withColumn("end", end)

    # open intervals around each start; an element without an end takes that of the innermost one
    kept = F.col("end").isNotNull() & (F.col("end") > F.col("pos"))
    none = F.lit(None).cast("string")
    opens = rows.select("*", F.lit(1).alias("kind"), F.when(kept, 1).otherwise(0).alias("step"))
    shut = rows.where(kept).select(key, "n", F.col("end").alias("pos"), none.alias("tag"), F.lit(0).alias("kind"), F.lit(-1).alias("step"))
    events = opens.unionByName(shut, allowMissingColumns=True)
    events = events.withColumn("depth", F.sum("step").over(Window.partitionBy(key).orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    around = Window.partitionBy(key, "depth").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    inner = F.last(F.when(F.col("step") == 1, F.col("end")), ignorenulls=True).over(around)
    events = events.withColumn("end", F.coalesce("end", F.when(F.col("depth") > 0, inner), "n"))
    depth = F.col("depth") + F.when(F.col("step") == 0, 1).otherwise(0)
    found = events.where("kind = 1")
    return found.select(key, "tag", F.col("pos").alias("start"), "end", F.col("nest").cast("int").alias("nest"), depth.cast("int").alias("depth"), "token")


def has_class(attributes: Column, names: str) -> Column:
    """Whether an element's class list holds every class of ``names``."""
    own = F.split(F.coalesce(F.try_element_at(attributes, F.lit("class")), F.lit("")), r"\s+")
    found = F.lit(True)
    for name in names.split():
        found = found & F.array_contains(own, name)
    return found


def _inner(span: Column) -> Column:
    """Tokens between an element's tags."""
    return F.slice("tokens", span["start"] + 2, F.greatest(span["end"] - span["start"] - 1, F.lit(0)))


def class_block(pages: DataFrame, classes: str, tag: str = "div", key: str = "page_id", html: str = "html") -> DataFrame:
    """HTM-4: ``(key, text)`` of the first ``tag`` with all of ``classes``, its texts stripped and joined with nothing; null without one."""
    paged = with_tokens(pages.select(key, html), html)
    found = element_table(paged, key).where(F.col("tag") == tag.lower()).where(has_class(H.attributes(F.col("token")), classes))
    first = found.groupBy(key).agg(F.min(F.struct("start", "end")).alias("span"))
    strip = lambda t: F.regexp_replace(t, r"^\s+|\s+$", "")
    text = F.array_join(F.transform(H.texts(_inner(F.col("span"))), strip), "")
    empty = F.col("span").isNull() | (F.size(_inner(F.col("span"))) == 0)
    return paged.join(first, key, "left").select(key, F.when(~empty, text).alias("text"))


def section_digest(
    pages: DataFrame, section: str = "article", heading: str = "h1", marker: str = "§", section_class: str = "", key: str = "page_id", html: str = "html"
) -> DataFrame:
    """HTM-3: ``(key, digest)``: of each outermost section its heading if it holds ``marker``, then of each element with an id in it
    the id and the text of the first paragraph in that element, a line each; empty without a section."""
    paged = with_tokens(pages.select(key, html), html)
    table = element_table(paged, key).withColumn("attrs", H.attributes(F.col("token")))
    span = F.struct("start", "end")
    is_section = (F.col("tag") == section.lower()) & has_class(F.col("attrs"), section_class)
    order = Window.partitionBy(key).orderBy("start")
    # outermost sections: none of the sections before reaches beyond the start
    reach = F.max(F.when(is_section, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    table = table.withColumn("opens", is_section & (F.col("start") >= F.coalesce(reach, F.lit(0))))
    here = F.last(F.when(F.col("opens"), span), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    following = order.rowsBetween(1, Window.unboundedFollowing)
    next_of = lambda name: F.first(F.when(F.col("tag") == name, span), ignorenulls=True).over(following)
    table = table.select(key, "start", "end", "opens", "attrs", here.alias("section"), next_of(heading.lower()).alias("heading"), next_of("p").alias("p"))
    table = table.where((F.col("start") < F.col("section.end")))
    ident = F.try_element_at("attrs", F.lit("id"))
    inside = F.when(F.col("p.start") < F.col("end"), F.col("p"))
    head = F.when(F.col("opens") & (F.col("heading.start") < F.col("end")), F.col("heading"))
    lines = table.where("opens").select(key, F.col("start").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("id"), head.alias("part"))
    marked = table.where(~F.col("opens") & (F.length(ident) > 0)).select(key, F.col("start").alias("at"), F.lit(1).alias("kind"), ident.alias("id"), inside.alias("part"))
    rows = lines.unionByName(marked).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "kind", "id", "part"))).alias("lines"))

    def line(x: Column) -> Column:
        text = F.array_join(H.texts(_inner(x["part"])), "")
        title = H.collapse_ws(text)
        own = F.concat(x["id"], F.lit("\n"), F.when(x["part"].isNotNull(), F.concat(text, F.lit("\n"))).otherwise(""))
        return F.when(x["kind"] == 1, own).when(x["part"].isNotNull() & (F.instr(title, marker) > 0), F.concat(title, F.lit("\n"))).otherwise("")

    done = paged.join(rows, key, "left")
    return done.select(key, F.coalesce(F.array_join(F.transform("lines", line), ""), F.lit("")).alias("digest"))
