"""Nested JSON shapes of company filings and facts (ARR-1, ARR-2, WIN-4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# facts: taxonomy -> concept -> {units: unit -> [ {val, uom, end} ]}
FACTS_SCHEMA = "map<string, map<string, struct<units: map<string, array<struct<val: double, uom: string, `end`: string>>>>>>"


def unpivot_filings(filings: DataFrame, recent: str = "recent") -> DataFrame:
    """ARR-1: parallel arrays ``form, filingDate, reportDate`` -> one row per filing, aligned by position."""
    z = F.arrays_zip(F.col(f"{recent}.form").alias("form"), F.col(f"{recent}.filingDate").alias("filingDate"),
                     F.col(f"{recent}.reportDate").alias("reportDate"))
    rows = filings.select("cik", F.posexplode(z).alias("pos", "f"))
    return rows.select("cik", F.col("pos").cast("long").alias("pos"), F.col("f.form").alias("form_type"),
                       F.col("f.filingDate").alias("date_filed"), F.col("f.reportDate").alias("report_period"))


def first_of_form(rows: DataFrame) -> DataFrame:
    """WIN-4 (reference behaviour, Q10): every filing takes the dates of the first filing with the same form.

    The window is partitioned by (cik, form): bounded by one company's filings.
    """
    w = Window.partitionBy("cik", "form_type").orderBy("pos")
    return rows.withColumn("date_filed", F.first("date_filed").over(w)).withColumn("report_period", F.first("report_period").over(w))


def unnest_facts(companies: DataFrame, facts_json: str = "facts_json") -> DataFrame:
    """ARR-2: four levels of maps and arrays -> ``(cik, taxonomy, concept, amount, unit, end_date)``.

    The unit is the fact's own ``uom``, else the map key holding it (Q11).
    """
    f = companies.select("cik", F.from_json(F.col(facts_json), FACTS_SCHEMA).alias("facts"))
    t = f.select("cik", F.explode("facts").alias("taxonomy", "concepts"))
    c = t.select("cik", "taxonomy", F.explode("concepts").alias("concept", "cv"))
    u = c.select("cik", "taxonomy", "concept", F.explode("cv.units").alias("unit_key", "instances"))
    i = u.select("cik", "taxonomy", "concept", "unit_key", F.explode("instances").alias("x"))
    return i.select("cik", "taxonomy", "concept", F.col("x.val").alias("amount"),
                    F.coalesce(F.col("x.uom"), F.col("unit_key")).alias("unit"), F.col("x.end").alias("end_date"))


def nest_facts(facts: DataFrame) -> DataFrame:
    """Inverse shape builder: ``(cik, taxonomy, concept, unit, val, uom, end)`` rows -> ``(cik, facts_json)``.

    Each level is one keyed aggregate; groups are bounded by one company's facts.
    """
    inst = F.struct(F.col("val"), F.col("uom"), F.col("end").alias("end"))
    l1 = facts.groupBy("cik", "taxonomy", "concept", "unit").agg(F.collect_list(inst).alias("arr"))
    l2 = l1.groupBy("cik", "taxonomy", "concept").agg(F.map_from_entries(F.collect_list(F.struct("unit", "arr"))).alias("units"))
    l3 = l2.groupBy("cik", "taxonomy").agg(
        F.map_from_entries(F.collect_list(F.struct("concept", F.struct(F.col("units").alias("units"))))).alias("cmap"))
    l4 = l3.groupBy("cik").agg(F.map_from_entries(F.collect_list(F.struct("taxonomy", "cmap"))).alias("facts"))
    return l4.select("cik", F.to_json("facts").alias("facts_json"))
