"""Registered queries: nested filing and fact shapes built from ``lineitem`` (ARR-1, ARR-2, WIN-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import nested as N
from millrace.plans.catalog import query
from millrace.session import table


def filings(spark, sf):
    """Per order, parallel arrays of its line items ordered by line number: the filing JSON shape."""
    l = table(spark, sf, "lineitem")
    e = F.struct(
        F.col("l_linenumber").alias("n"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("form"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("fd"),
        F.concat(F.lit("Q"), F.col("l_linenumber").cast("string")).alias("rd"),
    )
    g = l.groupBy(F.col("l_orderkey").alias("cik")).agg(F.sort_array(F.collect_list(e)).alias("xs"))
    recent = F.struct(
        F.transform("xs", lambda x: x["form"]).alias("form"),
        F.transform("xs", lambda x: x["fd"]).alias("filingDate"),
        F.transform("xs", lambda x: x["rd"]).alias("reportDate"),
    )
    return g.select("cik", recent.alias("recent"))


FILING_ROWS_SQL = """(SELECT l_orderkey AS cik, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag || l_linestatus, strftime(l_shipdate, '%Y-%m-%d')) - 1 AS pos,
  l_returnflag || l_linestatus AS form_type, strftime(l_shipdate, '%Y-%m-%d') AS date_filed, 'Q' || CAST(l_linenumber AS VARCHAR) AS report_period
  FROM lineitem)"""


@query("arr_unpivot", f"SELECT * FROM {FILING_ROWS_SQL}")
def arr_unpivot(spark, sf):
    return N.unpivot_filings(filings(spark, sf))


@query(
    "win_first_date",
    "SELECT cik, pos, form_type, first_value(date_filed) OVER w AS date_filed, first_value(report_period) OVER w AS report_period "
    f"FROM {FILING_ROWS_SQL} WINDOW w AS (PARTITION BY cik, form_type ORDER BY pos)",
)
def win_first_date(spark, sf):
    return N.first_of_form(N.unpivot_filings(filings(spark, sf)))


@query(
    "arr_unnest_facts",
    "SELECT l_orderkey AS cik, 'tax-' || l_returnflag AS taxonomy, 'c-' || l_linestatus AS concept, l_extendedprice AS amount, "
    "CASE WHEN l_quantity > 25 THEN 'USD' ELSE 'EUR' END AS unit, strftime(l_shipdate, '%Y-%m-%d') AS end_date FROM lineitem",
)
def arr_unnest_facts(spark, sf):
    l = table(spark, sf, "lineitem")
    unit = F.when(F.col("l_quantity") > 25, "USD").otherwise("EUR")
    rows = l.select(
        F.col("l_orderkey").alias("cik"),
        F.concat(F.lit("tax-"), "l_returnflag").alias("taxonomy"),
        F.concat(F.lit("c-"), "l_linestatus").alias("concept"),
        unit.alias("unit"),
        F.col("l_extendedprice").alias("val"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string")).otherwise(unit).alias("uom"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("end"),
    )
    return N.unnest_facts(N.nest_facts(rows))
