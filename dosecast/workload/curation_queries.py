"""Queries of the curation side, each with its SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from dosecast import fixed_values as fixed
from dosecast.functions import text
from dosecast.operators import conform
from dosecast.plans import curate
from dosecast.sources import catalog, discovery, sinks, tables
from dosecast.sources.ragged_csv import LONG_ROW, NO_HEADER, OPEN_QUOTE
from dosecast.sources.staging import fresh_path
from dosecast.workload import adapters as view
from dosecast.workload import extracts
from dosecast.workload import forecast_queries as fq
from dosecast.workload.registry import query

_NULL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE"}
_META = """DATE '{date}' AS extract_date, {name} AS source_file, TIMESTAMP '2024-03-01 06:00:00' AS processed_timestamp"""


def _expected(block: str, given: dict[str, str], key: str, kind: str, source: str, date: str = "2024-02-01") -> str:
    """SELECT of a target table: given expressions, null for the other columns."""
    study = f"'AA-BB-' || CAST({key} % 4 AS VARCHAR) || '-' || CAST({key} % 4 AS VARCHAR)"
    part = f"CAST(CAST(floor({key} / 50000) AS BIGINT) AS VARCHAR)"
    name = f"'Acme ' || {study} || '_{kind} ' || {part} || '.csv'"
    columns = [
        f"{given.get(c, f'CAST(NULL AS {_NULL_TYPES[t]})')} AS {c}" for c, _, t in fixed.headers(block)
    ]
    return f"SELECT {study} AS study_protocol, {', '.join(columns)}, {_META.format(date=date, name=name)} FROM {source}"


# ---- which files ------------------------------------------------------------------------------


def _listing(spark, sf_dir):
    """A listing as large as the orders: dated folders, versions of files, names of all kinds, strays."""
    key = F.col("o_orderkey")
    folder = (
        F.when(key % 31 == 0, "archive")
        .when(key % 37 == 0, "20231399")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    study = F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("study "), (F.col("o_custkey") % 3).cast("string"), F.lit("/")))
    names = ["Subject Summary", "SITE Inventory", "depot_inventory", "Site SupplyMethod", "country supplymethod", "Site Depot Inventory", "Notes"]
    name = F.concat(
        F.lit("AA-BB-"), (F.col("o_custkey") % 3).cast("string"), F.lit("-1 "),
        F.element_at(F.array(*[F.lit(n) for n in names]), (key % 7 + 1).cast("int")), F.lit(" "), key.cast("string"),
        F.when(key % 13 == 0, ".txt").otherwise(".CSV"),
    )
    return tables.spread(view.table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.concat(F.lit("/raw/"), folder, F.lit("/"), study, name).alias("path"),
        F.timestamp_add("MINUTE", (key % 5).cast("int"), "o_orderdate").alias("modificationTime"),
    )


_LISTING_SQL = """
files0 AS (SELECT *, CASE WHEN o_orderkey % 31 = 0 THEN 'archive' WHEN o_orderkey % 37 = 0 THEN '20231399'
      ELSE strftime(o_orderdate, '%Y%m%d') END AS date_folder,
    CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'study ' || CAST(o_custkey % 3 AS VARCHAR) END AS study_folder,
    'AA-BB-' || CAST(o_custkey % 3 AS VARCHAR) || '-1 ' ||
      ['Subject Summary', 'SITE Inventory', 'depot_inventory', 'Site SupplyMethod', 'country supplymethod',
       'Site Depot Inventory', 'Notes'][CAST(o_orderkey % 7 + 1 AS INTEGER)] || ' ' || CAST(o_orderkey AS VARCHAR) ||
      CASE WHEN o_orderkey % 13 = 0 THEN '.txt' ELSE '.CSV' END AS name,
    o_orderdate + to_minutes(CAST(o_orderkey % 5 AS BIGINT)) AS "modificationTime" FROM orders),
files AS (SELECT '/raw/' || date_folder || '/' || CASE WHEN study_folder = '' THEN '' ELSE study_folder || '/' END || name
      AS path, "modificationTime", date_folder, study_folder, name,
    CAST(try_strptime(date_folder, '%Y%m%d') AS DATE) AS extract_date,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE
      ['subject', 'site', 'depot', 'site_supply', 'country_supply', 'site', NULL][CAST(o_orderkey % 7 + 1 AS INTEGER)]
      END AS kind
  FROM files0 WHERE try_strptime(date_folder, '%Y%m%d') IS NOT NULL)"""
_FILES = f"WITH {_LISTING_SQL}"


def _files(spark, sf_dir):
    return discovery.describe(_listing(spark, sf_dir))


@query(f"{_FILES} SELECT * FROM files")
def file_kinds(spark, sf_dir):
    return _files(spark, sf_dir)


@query(f"{_FILES} SELECT DISTINCT date_folder, extract_date FROM files")
def date_folders(spark, sf_dir):
    return discovery.date_folders(_files(spark, sf_dir))


@query(f"{_FILES} SELECT * FROM files WHERE extract_date = (SELECT max(extract_date) FROM files)")
def folder_latest(spark, sf_dir):
    return discovery.choose_folders(_files(spark, sf_dir))


@query(f"{_FILES} SELECT * FROM files WHERE extract_date BETWEEN DATE '1997-03-01' AND DATE '1999-06-30'")
def folder_range(spark, sf_dir):
    choice = discovery.FolderChoice(True, dt.date(1997, 3, 1), dt.date(1999, 6, 30))
    return discovery.choose_folders(_files(spark, sf_dir), choice)


@query(f"{_FILES} SELECT * FROM files WHERE extract_date >= DATE '2000-01-01'")
def folder_from(spark, sf_dir):
    return discovery.choose_folders(_files(spark, sf_dir), discovery.FolderChoice(True, start=dt.date(2000, 1, 1)))


@query(
    f"""{_FILES} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY extract_date, study_folder, kind
    ORDER BY "modificationTime" DESC, path) AS rn FROM files WHERE kind IS NOT NULL AND study_folder <> '') WHERE rn = 1"""
)
def latest_files(spark, sf_dir):
    return discovery.latest_files(_files(spark, sf_dir))


@query(f"{_FILES} SELECT * FROM files WHERE kind IS NOT NULL")
def all_files(spark, sf_dir):
    return discovery.all_files(_files(spark, sf_dir))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN 'AA-BB-' || CAST(o_custkey AS VARCHAR) || '-7' END AS "Study Protocol"
    FROM orders"""
)
def study_in_name(spark, sf_dir):
    number = F.when(F.col("o_orderkey") % 4 == 0, "x1").otherwise(F.col("o_custkey").cast("string"))
    rows = view.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("Acme AA-BB-"), number, F.lit("-7_Subject Summary.csv")).alias("name")
    )
    return curate.study_column_first(rows, "name", extracts.PATTERN).drop("name")


# ---- cells and columns ------------------------------------------------------------------------


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN l_quantity END AS a,
      CASE WHEN l_discount > 0.05 THEN l_discount END AS b, CASE WHEN l_returnflag = 'R' THEN l_returnflag END AS c
      FROM lineitem)
    SELECT * FROM t WHERE (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT + 2 > 3"""
)
def sparse_rows(spark, sf_dir):
    rows = view.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("a"),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("b"),
        F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).alias("c"),
    )
    return conform.drop_sparse_rows(rows, 3)


_CAST_SCHEMA = {"id": "bigint", "line": "int", "qty": "bigint", "price": "double", "shipped": "date"}


@query(
    """SELECT l_orderkey AS id, CASE WHEN l_linenumber < 4 THEN l_linenumber END AS line,
    CAST(l_quantity AS BIGINT) AS qty, l_extendedprice AS price, CAST(l_shipdate AS DATE) AS shipped FROM lineitem"""
)
def typed_cast(spark, sf_dir):
    """Text to the target schema: whole numbers written as 8.0, cells that do not convert."""
    rows = view.table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("string").alias("qty"),
        F.when(F.col("l_linenumber") < 4, F.col("l_linenumber").cast("string")).otherwise("line").alias("line"),
        F.col("l_orderkey").cast("string").alias("id"),
        F.lit("dropped").alias("other"),
    )
    return conform.cast_to_schema(rows, _CAST_SCHEMA)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_orderdate AS DATE) END AS d,
    CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 IN (0, 1) THEN CAST(o_orderdate AS DATE) END AS only_first
    FROM orders"""
)
def multi_format_dates(spark, sf_dir):
    key = F.col("o_orderkey") % 5
    written = (
        F.when(key == 0, F.date_format("o_orderdate", "dd-MMM-yyyy"))
        .when(key == 1, F.upper(F.date_format("o_orderdate", "d-MMM-yyyy")))
        .when(key == 2, F.date_format("o_orderdate", "d MMM yyyy"))
        .when(key == 3, F.date_format("o_orderdate", "dd MMM yyyy"))
        .otherwise("xx")
    )
    rows = view.table(spark, sf_dir, "orders").select("o_orderkey", written.alias("d"), written.alias("only_first"))
    both = conform.convert_dates(rows, ["d", "absent"])
    return conform.convert_dates(both, ["only_first"], fixed.DATE_FORMATS[:1])


@query(
    """SELECT s_suppkey AS site_id, s_name AS comparator_name, CAST(NULL AS VARCHAR) AS site_status, 'central' AS
    site_level_supply_method, CAST(NULL AS VARCHAR) AS extra FROM supplier
    UNION ALL SELECT c_custkey, c_name, 'Open', NULL, c_mktsegment FROM customer"""
)
def union_and_rename(spark, sf_dir):
    """Files with different columns, stacked by name and renamed."""
    first = view.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Site ID"),
        F.col("s_name").alias("Comparator Name"),
        F.lit("central").alias("Site Level Supply Method"),
    )
    second = view.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Comparator Name"),
        F.lit("Open").alias("Site Status"),
        F.col("c_custkey").alias("Site ID"),
        F.col("c_mktsegment").alias("extra"),
    )
    return conform.rename_headers(conform.union_by_name([first, second]), fixed.SITE_SUPPLY_HEADERS)


@query(
    """SELECT study, trim(source) AS source, standard FROM (
      SELECT c_name AS standard, '0' AS study, ' ' || c_name || ' a ' AS source FROM customer
      UNION ALL SELECT c_name, '1', CASE WHEN c_custkey % 2 = 0 THEN ' ' END FROM customer
      UNION ALL SELECT c_name, '2', CASE WHEN c_custkey % 3 = 0 THEN c_name END FROM customer)
    WHERE trim(source) <> ''"""
)
def header_dictionary(spark, sf_dir):
    key = F.col("c_custkey")
    wide = view.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias(fixed.MAPPING_HEADER),
        F.concat(F.lit(" "), "c_name", F.lit(" a ")).alias("0"),
        F.when(key % 2 == 0, " ").alias("1"),
        F.when(key % 3 == 0, F.col("c_name")).alias("2"),
    )
    return conform.study_headers(wide)


# ---- ingest -----------------------------------------------------------------------------------

_SUBJECT = {
    "site_id": "CASE WHEN c_custkey % 9 <> 0 THEN c_nationkey END",
    "country": "CASE WHEN c_custkey % 7 <> 0 THEN 'Land ' || CAST(c_nationkey AS VARCHAR) END",
    "investigator": "CASE WHEN c_custkey % 4 = 2 THEN NULL WHEN c_custkey % 4 = 3 THEN c_name || ',' || chr(10) || '\"MD\"' "
    "ELSE c_name || ', \"MD\"' END",
    "subject_number": "c_custkey",
    "year_of_birth": "CAST(1950 + c_custkey % 50 AS INTEGER)",
    "tpc": "c_mktsegment",
    "date_randomized": "DATE '2023-12-31'",
    "subject_status": "'Randomized'",
    "last_study_visit_date": "CASE WHEN c_custkey % 6 <> 0 THEN CAST(last_d AS DATE) END",
}
_SUBJECT_SOURCE = (
    "customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_d FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"
)


def _subject_sql(date: str) -> str:
    return _expected(fixed.SUBJECT_HEADERS, _SUBJECT, "c_custkey", "Subject Summary", _SUBJECT_SOURCE, date)


@query(_subject_sql("2024-02-01"))
def ingest_subjects(spark, sf_dir):
    """Per-study headers and column orders, line breaks in cells, junk lines, missing markers; latest folder."""
    root = extracts.subject_extracts(spark, sf_dir)
    return curate.curate_kind(spark, "subject", extracts.params(root), extracts.header_mapping(spark)).rows


@query(_subject_sql("2024-02-01"))
def ingest_subjects_mapping_file(spark, sf_dir):
    """The header mapping itself comes from a CSV file."""
    path = fresh_path(spark, "header-mapping") + ".csv"
    sinks.write_csv(extracts.header_mapping(spark), path)
    mapping = curate.load_header_mapping(spark, path)
    return curate.curate_kind(spark, "subject", extracts.params(extracts.subject_extracts(spark, sf_dir)), mapping).rows


@query(f"{_subject_sql('2024-01-01')} UNION ALL {_subject_sql('2024-02-01')}")
def ingest_subjects_history(spark, sf_dir):
    root = extracts.subject_extracts(spark, sf_dir)
    return curate.curate_kind(spark, "subject", extracts.every_folder(root), extracts.header_mapping(spark)).rows


_SITE = {
    "site_id": "CAST(o_custkey AS INTEGER)",
    "country": "CASE WHEN o_orderkey % 4 <> 1 THEN 'Land ' || CAST(o_orderkey % 25 AS VARCHAR) END",
    "parent_depot": "CAST(o_orderkey % 5 AS INTEGER)",
    "study_drug_type": "o_orderstatus",
    "unblinded_study_drug_name": "o_orderpriority || ', 10mg'",
    "fp_expiry_date": "CAST(o_orderdate AS DATE)",
    **{
        c: f"CAST(o_orderkey % {i + 7} AS BIGINT)"
        for i, (c, _, t) in enumerate(fixed.headers(fixed.SITE_HEADERS))
        if t == "bigint"
    },
}
_SITE_SQL = _expected(fixed.SITE_HEADERS, _SITE, "o_orderkey", "Site Inventory", "orders")


@query(_SITE_SQL)
def ingest_site(spark, sf_dir):
    return curate.curate_kind(spark, "site", extracts.params(extracts.site_extracts(spark, sf_dir))).rows


@query(_SITE_SQL)
def empty_kind_kept(spark, sf_dir):
    """A later run over a folder of the same day without site files leaves the site table as it is."""
    target, headers = fresh_path(spark, "curated"), extracts.header_mapping(spark)
    for root in (extracts.site_extracts(spark, sf_dir), extracts.subject_extracts(spark, sf_dir)):
        curate.run_curation(spark, extracts.params(root), headers, target)
    return tables.scan(spark, f"{target}/site")


@query(_SITE_SQL)
def ingest_site_split(spark, sf_dir):
    """The same files read as splittable text, the way of files too large to take whole."""
    params = extracts.params(extracts.site_extracts(spark, sf_dir), whole_bytes=0)
    return curate.curate_kind(spark, "site", params).rows


@query(
    _expected(
        fixed.DEPOT_HEADERS,
        {
            "depot_id": "p_size",
            "depot_type": "p_type",
            "unblinded_study_drug_name": "p_name",
            "part_number": "p_brand",
            "quantity_study_drug_available": "CASE WHEN p_partkey % 3 <> 0 THEN p_partkey END",
            "quantity_study_drug_total": "p_partkey",
            "approved_countries": "'A, B'",
        },
        "p_partkey",
        "Depot Inventory",
        "part",
    )
)
def ingest_depot(spark, sf_dir):
    return curate.curate_kind(spark, "depot", extracts.params(extracts.depot_extracts(spark, sf_dir))).rows


@query(
    _expected(
        fixed.SITE_SUPPLY_HEADERS,
        {
            "country": "'Land ' || CAST(s_nationkey AS VARCHAR)",
            "site_id": "'00' || CAST(s_suppkey AS VARCHAR)",
            "comparator_name": "s_name",
            "site_level_supply_method": "CASE WHEN s_suppkey % 2 = 0 THEN 'central' ELSE 'local' END",
            "site_status": "'Open'",
        },
        "s_suppkey",
        "Site SupplyMethod",
        "supplier",
    )
)
def ingest_site_supply(spark, sf_dir):
    root = extracts.site_supply_extracts(spark, sf_dir)
    return curate.curate_kind(spark, "site_supply", extracts.params(root)).rows


@query(
    _expected(
        fixed.COUNTRY_SUPPLY_HEADERS,
        {"country": "lang", "comparator_name": "text", "country_level_supply_method": "CAST(doc_id AS VARCHAR)"},
        "doc_id",
        "Country SupplyMethod",
        "documents",
    )
)
def ingest_country_supply(spark, sf_dir):
    """Whole documents as cells: quotes, commas and line breaks survive."""
    root = extracts.document_extracts(spark, sf_dir)
    return curate.curate_kind(spark, "country_supply", extracts.params(root)).rows


@query(
    f"""SELECT 'Acme ' || CASE WHEN s_suppkey % 5 = 1 THEN 'AA-BB-x-1' ELSE 'AA-BB-' || CAST(s_suppkey AS VARCHAR) || '-1' END
      || '_' || CAST(s_suppkey AS VARCHAR) || ' Site SupplyMethod.csv' AS name,
    ['', '{conform.NO_STUDY}', '{NO_HEADER}', '{OPEN_QUOTE}', '{LONG_ROW}'][CAST(s_suppkey % 5 + 1 AS INTEGER)] AS error
    FROM supplier WHERE s_suppkey % 5 <> 0"""
)
def rejected_files(spark, sf_dir):
    root = extracts.faulty_extracts(spark, sf_dir)
    return curate.curate_kind(spark, "site_supply", extracts.params(root)).rejected.select("name", "error")


def _failures_sql(block: str, given: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {given.get(c, 'false')}) AS n_rows FROM {source}"
        for c, _, t in fixed.headers(block)
        if t != "string"
    )


@query(
    _failures_sql(fixed.SUBJECT_HEADERS, {"parent_depot": "true", "last_study_visit_date": "c_custkey % 6 = 0"}, "customer")
)
def cast_failures_subjects(spark, sf_dir):
    """Cells of the latest subject files that do not convert, per column."""
    root = extracts.subject_extracts(spark, sf_dir)
    return curate.curate_kind(spark, "subject", extracts.params(root), extracts.header_mapping(spark)).cast_failures


@query(_failures_sql(fixed.DEPOT_HEADERS, {"quantity_study_drug_available": "p_partkey % 3 = 0"}, "part"))
def cast_failures_depot(spark, sf_dir):
    return curate.curate_kind(spark, "depot", extracts.params(extracts.depot_extracts(spark, sf_dir))).cast_failures


@query(
    f"""SELECT study_protocol, randomized_treatment, subject_status, tpc, study_drug_dispensed,
    additional_study_drug_dispensed, CAST(NULL AS VARCHAR) AS additional_study_drug_prefix, country, visit_days,
    dispensing_quantity, dispensing_frequency_days, max_cycles FROM ({view.MAPPING_SQL})"""
)
def treatment_mapping_load(spark, sf_dir):
    """The mapping sheet, all text and with its long headers, truncated and loaded."""
    sheet = view.mapping(spark, sf_dir).withColumn("additional_study_drug_prefix", F.lit("null"))
    fields = fixed.headers(fixed.TREATMENT_MAPPING_HEADERS)
    long_header = {"TPC": "TPC\nTreatment of choice\nIntended TPC"}
    raw = sheet.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(long_header.get(h, h)) for c, h, _ in fields]
    )
    path = fresh_path(spark, "treatment-mapping-table")
    sinks.write_whole(curate.load_treatment_mapping(raw), path)
    return tables.scan(spark, path)


# ---- sinks ------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
    CAST(date_trunc('year', o_orderdate) AS DATE) AS extract_date FROM orders
    WHERE NOT (year(o_orderdate) = 1998 AND o_orderkey % 2 = 0)"""
)
def partition_replace(spark, sf_dir):
    """Load all partitions, then load one of them again with other rows."""
    rows = view.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.trunc("o_orderdate", "year").alias("extract_date")
    )
    path = fresh_path(spark, "partitioned")
    sinks.write_partitions(rows, path)
    again = rows.where((F.col("extract_date") == F.lit(dt.date(1998, 1, 1))) & (F.col("o_orderkey") % 2 != 0))
    sinks.write_partitions(again.withColumn("price", F.col("price") + 1), path)
    return tables.scan(spark, path)


@query(
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
    CAST(date_trunc('year', o_orderdate) AS DATE) AS extract_date FROM orders
    WHERE NOT (year(o_orderdate) = 1998 AND o_orderkey % 2 = 0)"""
)
def catalog_partitions(spark, sf_dir):
    """The same through a catalog table: one year is loaded again from the table's own rows, while a reader holds the table."""
    rows = view.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.trunc("o_orderdate", "year").alias("extract_date")
    )
    name, folder = f"orders_{uuid.uuid4().hex}", fresh_path(spark, "catalog-partitioned")
    catalog.replace_partitions(rows, name, folder)
    stored = tables.scan(spark, name)
    again = stored.where((F.col("extract_date") == F.lit(dt.date(1998, 1, 1))) & (F.col("o_orderkey") % 2 != 0))
    catalog.replace_partitions(again.withColumn("price", F.col("price") + 1), name, folder)
    return tables.scan(spark, name)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def catalog_whole(spark, sf_dir):
    """A catalog table by name, replaced whole."""
    name, folder = f"orders_{uuid.uuid4().hex}", fresh_path(spark, "catalog-whole")
    orders = view.table(spark, sf_dir, "orders")
    catalog.replace_table(orders.select("o_orderkey", F.lit("stale").alias("o_orderstatus")), name, folder)
    catalog.replace_table(orders.select("o_orderkey", "o_orderstatus"), name, folder)
    return tables.scan(spark, name)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def whole_overwrite(spark, sf_dir):
    path = fresh_path(spark, "whole")
    orders = view.table(spark, sf_dir, "orders")
    sinks.write_whole(orders.select("o_orderkey", F.lit("stale").alias("o_orderstatus")), path)
    sinks.write_whole(orders.select("o_orderkey", "o_orderstatus"), path)
    return tables.scan(spark, path)


@query(fq._forecast_sql(f"SELECT * EXCLUDE (phase), {fq._STAMP} FROM forecast"))
def forecast_csv(spark, sf_dir):
    """The forecast written as CSV and read back with its schema."""
    path = fresh_path(spark, "forecast-csv")
    sinks.write_csv(fq.forecast(spark, sf_dir), path, "gzip")
    return spark.read.schema(fixed.FORECAST_SCHEMA).option("header", "true").csv(path)
