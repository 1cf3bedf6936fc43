"""Subject and mapping views on the driver tables, as DataFrames and as SQL.

The two forms give the same rows. The views hold nulls, mixed case, stray spaces, unparsable visits,
excluded and null statuses, country overrides, null day patterns, null cycle lengths and caps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.params import ForecastParams
from dosecast.sources.staging import stage
from dosecast.sources.tables import spread

AS_OF = dt.date(2001, 9, 1)
PARAMS = ForecastParams(as_of_date=AS_OF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _remainder(column: str, n: int) -> Column:
    return F.col(column) % n


def _multiple(column: str, n: int) -> Column:
    return _remainder(column, n) == 0


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subject row per customer; the visit history comes from the orders."""
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_d"))
    )
    people = (
        spread(table(spark, sf_dir, "customer"), "c_custkey")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    n = F.col("n_orders").cast("string")
    return people.select(
        F.concat(F.lit("ST-"), _remainder("c_custkey", 4).cast("string")).alias("study_protocol"),
        F.col("c_nationkey").alias("site_id"),
        F.when(_multiple("c_custkey", 2), F.col("r_name")).otherwise(F.lower("r_name")).alias("country"),
        F.col("n_regionkey").alias("parent_depot"),
        F.col("c_custkey").alias("subject_number"),
        F.when(~_multiple("c_custkey", 6), F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("tpc"),
        F.when(_multiple("c_custkey", 11), "Screen Failed")
        .when(_multiple("c_custkey", 13), None)
        .when(_multiple("c_custkey", 3), "Crossover Approved")
        .otherwise("Randomized")
        .alias("subject_status"),
        F.concat(
            F.when(_multiple("c_custkey", 5), "arm ").otherwise("Arm "),
            _remainder("c_custkey", 3).cast("string"),
        ).alias("randomized_treatment"),
        F.when(_multiple("c_custkey", 17), None)
        .when(_multiple("c_custkey", 7), F.concat(F.lit("TPC C"), n, F.lit("D8")))
        .when(_multiple("c_custkey", 3), F.concat(F.lit("Crossover Cycle "), n, F.lit(" Day 1")))
        .when(_multiple("c_custkey", 8), F.concat(F.lit("Cycle "), n))
        .otherwise(F.concat(F.lit("Cycle "), n, F.lit(" Day 8")))
        .alias("last_study_visit_recorded"),
        F.col("last_d").cast("date").alias("last_study_visit_date"),
        F.lit(dt.date(2001, 8, 1)).alias("extract_date"),
    )


SUBJECTS_SQL = """
SELECT 'ST-' || CAST(c.c_custkey % 4 AS VARCHAR) AS study_protocol,
       c.c_nationkey AS site_id,
       CASE WHEN c.c_custkey % 2 = 0 THEN r.r_name ELSE lower(r.r_name) END AS country,
       n.n_regionkey AS parent_depot,
       c.c_custkey AS subject_number,
       CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE '  ' || c.c_mktsegment || ' ' END AS tpc,
       CASE WHEN c.c_custkey % 11 = 0 THEN 'Screen Failed'
            WHEN c.c_custkey % 13 = 0 THEN NULL
            WHEN c.c_custkey % 3 = 0 THEN 'Crossover Approved' ELSE 'Randomized' END AS subject_status,
       CASE WHEN c.c_custkey % 5 = 0 THEN 'arm ' ELSE 'Arm ' END || CAST(c.c_custkey % 3 AS VARCHAR)
         AS randomized_treatment,
       CASE WHEN c.c_custkey % 17 = 0 THEN NULL
            WHEN c.c_custkey % 7 = 0 THEN 'TPC C' || CAST(o.n_orders AS VARCHAR) || 'D8'
            WHEN c.c_custkey % 3 = 0 THEN 'Crossover Cycle ' || CAST(o.n_orders AS VARCHAR) || ' Day 1'
            WHEN c.c_custkey % 8 = 0 THEN 'Cycle ' || CAST(o.n_orders AS VARCHAR)
            ELSE 'Cycle ' || CAST(o.n_orders AS VARCHAR) || ' Day 8' END AS last_study_visit_recorded,
       CAST(o.last_d AS DATE) AS last_study_visit_date,
       DATE '2001-08-01' AS extract_date
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_d FROM orders GROUP BY o_custkey) o
  ON o.o_custkey = c.c_custkey
"""


def _odd_visit(written: Column) -> Column:
    return (
        F.when(_multiple("c_custkey", 19), "Cycle 3000000000 Day 8")
        .when(_multiple("c_custkey", 23), "TPC C99999999999999999999D1")
        .when(_multiple("c_custkey", 29), "Cycle 2 Day 200000")
        .when(_multiple("c_custkey", 31), "Cycle 2 Day 9223372036854775807")
        .when(_multiple("c_custkey", 37), "Cycle 2 Day 9000")
        .otherwise(written)
    )


def odd_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects, some with cycle and day numbers that no visit can have or no int can hold."""
    number = F.col("subject_number").alias("c_custkey")
    rows = subjects(spark, sf_dir).select("*", number)
    return rows.withColumn("last_study_visit_recorded", _odd_visit(F.col("last_study_visit_recorded"))).drop("c_custkey")


ODD_SUBJECTS_SQL = f"""
SELECT * REPLACE (CASE WHEN subject_number % 19 = 0 THEN 'Cycle 3000000000 Day 8'
    WHEN subject_number % 23 = 0 THEN 'TPC C99999999999999999999D1'
    WHEN subject_number % 29 = 0 THEN 'Cycle 2 Day 200000'
    WHEN subject_number % 31 = 0 THEN 'Cycle 2 Day 9223372036854775807'
    WHEN subject_number % 37 = 0 THEN 'Cycle 2 Day 9000' ELSE last_study_visit_recorded END AS last_study_visit_recorded)
FROM ({SUBJECTS_SQL})
"""


def odd_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping with day numbers and cycle lengths that leave the calendar for some treatments."""
    crossover = F.col("subject_status") == "Crossover Approved"
    return mapping(spark, sf_dir).withColumns(
        {
            "visit_days": F.when(crossover & (F.col("visit_days") == "1, 8,15"), "1, 8,5000000")
            .when(crossover & (F.col("visit_days") == "1"), "9223372036854775807,1")
            .otherwise(F.col("visit_days")),
            "dispensing_frequency_days": F.when(
                (F.col("study_protocol") == "ST-1") & (F.col("subject_status") == "Randomized"),
                F.when(F.col("visit_days") == "1", 9223372036854775807).otherwise(200000),
            ).otherwise(F.col("dispensing_frequency_days")),
        }
    )


def mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Treatment mapping: arms of the customers x status x segment x drug of the parts x country."""
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    region = table(spark, sf_dir, "region")
    segments = customer.agg(F.collect_set("c_mktsegment")).scalar()
    drugs = (
        part.groupBy("p_type")
        .agg((F.min("p_size") + 1).alias("sz"))
        .agg(F.collect_list(F.struct("p_type", "sz")))
        .scalar()
    )
    countries = region.agg(F.collect_set("r_name")).scalar()
    nothing = F.array(F.lit(None).cast("string"))
    rows = (
        customer.select(_remainder("c_custkey", 4).alias("k"), _remainder("c_custkey", 3).alias("a"))
        .distinct()
        .withColumn("status", F.explode(F.array(F.lit("Randomized"), F.lit("Crossover Approved"))))
        .withColumn("tpc", F.explode(F.concat(segments, nothing)))
        .withColumn("d", F.explode(drugs))
        .withColumn("country", F.explode(F.concat(nothing, countries)))
        .select("k", "a", "status", "tpc", "d.p_type", "d.sz", "country")
        .where(F.col("country").isNull() | F.col("p_type").isin("ECONOMY", "LARGE"))
    )
    size, larger = F.col("sz").cast("string"), (F.col("sz") + 1).cast("string")
    promo = F.col("p_type") == "PROMO"
    return rows.select(
        F.concat(F.lit("ST-"), F.col("k").cast("string")).alias("study_protocol"),
        F.concat(F.lit("Arm "), F.col("a").cast("string")).alias("randomized_treatment"),
        F.col("status").alias("subject_status"),
        "tpc",
        F.when(promo, None)
        .when(F.col("country").isNotNull(), F.concat("country", F.lit("-"), "p_type", F.lit(" "), larger, F.lit("mg")))
        .otherwise(F.concat("p_type", F.lit(" "), size, F.lit(" mg")))
        .alias("study_drug_dispensed"),
        F.when(promo, "Promo Plus").when(F.col("p_type") == "MEDIUM", "Extra 5 mg").alias("additional_study_drug_dispensed"),
        "country",
        F.when(F.col("p_type") == "LARGE", "1, 8,15")
        .when(F.col("p_type") == "SMALL", None)
        .when(F.col("p_type") == "MEDIUM", "1")
        .otherwise("1,8")
        .alias("visit_days"),
        F.col("sz").cast("bigint").alias("dispensing_quantity"),
        F.when(F.col("k") == 3, None).when(F.col("a") == 1, 28).otherwise(21).cast("bigint").alias(
            "dispensing_frequency_days"
        ),
        F.when(F.col("k") == 1, 14.0).alias("max_cycles"),
    )


MAPPING_SQL = """
SELECT 'ST-' || CAST(s.k AS VARCHAR) AS study_protocol,
       'Arm ' || CAST(s.a AS VARCHAR) AS randomized_treatment,
       st.status AS subject_status, t.tpc AS tpc,
       CASE WHEN d.p_type = 'PROMO' THEN NULL
            WHEN ct.country IS NOT NULL THEN ct.country || '-' || d.p_type || ' ' || CAST(d.sz + 1 AS VARCHAR) || 'mg'
            ELSE d.p_type || ' ' || CAST(d.sz AS VARCHAR) || ' mg' END AS study_drug_dispensed,
       CASE WHEN d.p_type = 'PROMO' THEN 'Promo Plus' WHEN d.p_type = 'MEDIUM' THEN 'Extra 5 mg' END AS additional_study_drug_dispensed,
       ct.country AS country,
       CASE WHEN d.p_type = 'LARGE' THEN '1, 8,15' WHEN d.p_type = 'SMALL' THEN NULL
            WHEN d.p_type = 'MEDIUM' THEN '1' ELSE '1,8' END AS visit_days,
       CAST(d.sz AS BIGINT) AS dispensing_quantity,
       CAST(CASE WHEN s.k = 3 THEN NULL WHEN s.a = 1 THEN 28 ELSE 21 END AS BIGINT) AS dispensing_frequency_days,
       CASE WHEN s.k = 1 THEN CAST(14 AS DOUBLE) ELSE CAST(NULL AS DOUBLE) END AS max_cycles
FROM (SELECT DISTINCT c_custkey % 4 AS k, c_custkey % 3 AS a FROM customer) s
CROSS JOIN (SELECT 'Randomized' AS status UNION ALL SELECT 'Crossover Approved') st
CROSS JOIN (SELECT DISTINCT c_mktsegment AS tpc FROM customer UNION ALL SELECT NULL) t
CROSS JOIN (SELECT p_type, min(p_size) + 1 AS sz FROM part GROUP BY p_type) d
CROSS JOIN (SELECT NULL AS country UNION ALL SELECT r_name FROM region) ct
WHERE ct.country IS NULL OR d.p_type IN ('ECONOMY','LARGE')
"""

ODD_MAPPING_SQL = f"""
SELECT * REPLACE (CASE WHEN subject_status = 'Crossover Approved' AND visit_days = '1, 8,15' THEN '1, 8,5000000'
    WHEN subject_status = 'Crossover Approved' AND visit_days = '1' THEN '9223372036854775807,1' ELSE visit_days END AS visit_days,
  CASE WHEN study_protocol = 'ST-1' AND subject_status = 'Randomized'
    THEN CASE WHEN visit_days = '1' THEN 9223372036854775807 ELSE 200000 END
    ELSE dispensing_frequency_days END AS dispensing_frequency_days)
FROM ({MAPPING_SQL})
"""

_staged: dict[tuple[str, str], DataFrame] = {}


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as a stored table, which is how a forecast run meets it; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        _staged[key] = stage(mapping_rows(spark, sf_dir), "treatment-mapping")
    return _staged[key]


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many snapshot rows per subject: one per order, some columns null in some rows.

    ``row_key`` says which row comes first within a snapshot.
    """
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = spread(table(spark, sf_dir, "orders"), "o_custkey")
    rows = people.join(orders, F.col("o_custkey") == F.col("c_custkey"))
    cycle = _remainder("o_orderkey", 12).cast("string")
    return rows.select(
        F.concat(F.lit("ST-"), _remainder("c_custkey", 4).cast("string")).alias("study_protocol"),
        F.when(~_multiple("o_orderkey", 4), F.col("c_nationkey")).alias("site_id"),
        F.lit("asia").alias("country"),
        F.col("n_regionkey").alias("parent_depot"),
        F.col("c_custkey").alias("subject_number"),
        F.when(~_multiple("c_custkey", 6), F.col("c_mktsegment")).alias("tpc"),
        F.when(_multiple("o_orderkey", 10), "Screen Failed").otherwise("Randomized").alias("subject_status"),
        F.concat(F.lit("Arm "), _remainder("c_custkey", 3).cast("string")).alias("randomized_treatment"),
        F.when(_multiple("o_orderkey", 5), None)
        .otherwise(F.concat(F.lit("Cycle "), cycle, F.lit(" Day 8")))
        .alias("last_study_visit_recorded"),
        F.when(~_multiple("o_orderkey", 3), F.col("o_orderdate").cast("date")).alias("last_study_visit_date"),
        F.trunc("o_orderdate", "year").alias("extract_date"),
        F.col("o_orderdate").alias("processed_timestamp"),
        F.col("o_orderkey").alias("row_key"),
    )


HISTORY_SQL = """
SELECT 'ST-' || CAST(c.c_custkey % 4 AS VARCHAR) AS study_protocol,
       CASE WHEN o.o_orderkey % 4 <> 0 THEN c.c_nationkey END AS site_id,
       'asia' AS country, n.n_regionkey AS parent_depot, c.c_custkey AS subject_number,
       CASE WHEN c.c_custkey % 6 <> 0 THEN c.c_mktsegment END AS tpc,
       CASE WHEN o.o_orderkey % 10 = 0 THEN 'Screen Failed' ELSE 'Randomized' END AS subject_status,
       'Arm ' || CAST(c.c_custkey % 3 AS VARCHAR) AS randomized_treatment,
       CASE WHEN o.o_orderkey % 5 <> 0 THEN 'Cycle ' || CAST(o.o_orderkey % 12 AS VARCHAR) || ' Day 8' END
         AS last_study_visit_recorded,
       CASE WHEN o.o_orderkey % 3 <> 0 THEN CAST(o.o_orderdate AS DATE) END AS last_study_visit_date,
       CAST(date_trunc('year', o.o_orderdate) AS DATE) AS extract_date,
       o.o_orderdate AS processed_timestamp, o.o_orderkey AS row_key
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN orders o ON o.o_custkey = c.c_custkey
"""
