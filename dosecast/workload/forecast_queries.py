"""Queries of the forecast side, each with its SQL."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from dosecast.fixed_values import EXCLUDED_STATUSES, FORECAST_SCHEMA
from dosecast.functions import text
from dosecast.operators import match, prepare, project, quality, rollup
from dosecast.operators import plan as planning
from dosecast.operators.bases import mapping_bases
from dosecast.plans import forecast as job
from dosecast.sources import catalog, sinks, tables
from dosecast.sources.staging import fresh_path, stage
from dosecast.sources.tables import latest_snapshot as snapshot_of
from dosecast.workload import adapters as view
from dosecast.workload.registry import query

P = view.PARAMS
LIMIT = P.broadcast_bytes

# ---- SQL building blocks ----------------------------------------------------------------------

_EXCLUDED = ", ".join(f"'{s}'" for s in EXCLUDED_STATUSES)


def _keys(left: str, right: str) -> str:
    names = ("study_protocol", "randomized_treatment", "tpc", "subject_status")
    return " AND ".join(f"lower({left}.{k}) IS NOT DISTINCT FROM lower({right}.{k})" for k in names)


def _without_countries(name: str) -> str:
    for country in ("middle east", "america", "africa", "europe", "asia"):
        name = f"regexp_replace({name}, '(?i)\\b{country}\\b-?', '', 'g')"
    return name


def _prelude(subjects_sql: str = view.SUBJECTS_SQL, cap: str = "max_cycles", mapping_sql: str = view.MAPPING_SQL) -> str:
    return f"""
WITH subjects AS ({subjects_sql}),
mapping0 AS ({mapping_sql}),
mapping AS (SELECT * REPLACE ({cap} AS max_cycles) FROM mapping0),
active AS (SELECT * FROM subjects WHERE subject_status IS NULL OR subject_status NOT IN ({_EXCLUDED})),
people AS (SELECT * REPLACE (trim(study_protocol) AS study_protocol, trim(randomized_treatment) AS randomized_treatment,
           trim(tpc) AS tpc, trim(country) AS country) FROM active),
m AS (SELECT mapping.*, CASE WHEN country IS NULL THEN 1 ELSE 0 END AS tier,
        nullif(regexp_extract(study_drug_dispensed, '^(.*?)\\s\\d', 1), '') AS base_match,
        trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          {_without_countries("regexp_replace(study_drug_dispensed, '\\d.*', '')")},
          '[()]', '', 'g'), '^[\\s\\-]+', ''), '[\\s\\-]+$', ''), '\\s{{2,}}', ' ', 'g')) AS base_mapping
      FROM mapping),
specific AS (SELECT * FROM m WHERE tier = 0)"""


_SUBJECT_COLS = (
    "s.study_protocol, s.site_id, s.country, s.parent_depot, s.subject_number, s.tpc, s.subject_status, "
    "s.randomized_treatment, s.last_study_visit_recorded, s.last_study_visit_date, s.extract_date"
)
_MAPPING_COLS = (
    "m.study_drug_dispensed, m.additional_study_drug_dispensed, m.visit_days, m.dispensing_quantity, "
    "m.dispensing_frequency_days, m.max_cycles"
)
_FITS = "(m.country IS NULL OR lower(m.country) = lower(s.country))"

_MATCH = {
    "specific": f"JOIN m ON {_keys('s', 'm')} AND lower(m.country) = lower(s.country)",
    "generic": f"JOIN m ON {_keys('s', 'm')} AND m.country IS NULL",
    "flat": f"JOIN m ON {_keys('s', 'm')}",
    "tiered": f"""JOIN m ON {_keys('s', 'm')} AND {_FITS}
  WHERE NOT EXISTS (SELECT 1 FROM specific x WHERE {_keys('x', 'm')} AND lower(x.country) = lower(s.country)
                    AND x.base_mapping IS NOT DISTINCT FROM m.base_match)
     OR EXISTS (SELECT 1 FROM specific x WHERE {_keys('x', 'm')} AND lower(x.country) = lower(s.country)
                AND x.base_mapping IS NOT DISTINCT FROM m.base_match
                AND x.study_drug_dispensed IS NOT DISTINCT FROM m.study_drug_dispensed)""",
    "exclusive": f"""JOIN m ON {_keys('s', 'm')} AND {_FITS}
  WHERE m.tier = 0 OR NOT EXISTS (SELECT 1 FROM specific x WHERE {_keys('x', 's')}
                                  AND lower(x.country) = lower(s.country))""",
}


def _matched(mode: str, extra: str = "") -> str:
    tier = "0" if mode == "flat" else "m.tier"
    return f"SELECT {_SUBJECT_COLS}{extra}, {_MAPPING_COLS}, {tier} AS tier FROM people s {_MATCH[mode]}"


_DAYS = (
    "list_transform(list_filter(string_split(coalesce(visit_days, ''), ','), "
    "lambda x: regexp_full_match(trim(x), '\\d+')), lambda x: CAST(trim(x) AS INTEGER))"
)
_LONG_DAYS = _DAYS.replace("INTEGER", "BIGINT")


def _number(pattern: str, default: int) -> str:
    digits = f"coalesce(regexp_extract(last_study_visit_recorded, '(?i)(?:{pattern})(\\d+)', 1), '')"
    return f"CASE WHEN {digits} = '' THEN {default} ELSE TRY_CAST({digits} AS BIGINT) END"


_CYCLE = _number("C|Cycle\\s?", 0)
_DAY = _number("D|Day\\s?", 1)


def _medicine(both: bool = False) -> str:
    drugs = (
        "unnest(list_filter([study_drug_dispensed, additional_study_drug_dispensed], lambda x: x IS NOT NULL))"
        if both
        else "coalesce(study_drug_dispensed, additional_study_drug_dispensed)"
    )
    return f"""
medicine AS (SELECT * FROM (
  SELECT *, CAST(len({_DAYS}) AS INTEGER) AS visit_count_per_cycle,
         CAST(len({_DAYS}) * dispensing_quantity AS BIGINT) AS total_medicines_required_per_cycle,
         {_CYCLE} AS parsed_last_visit_cycle, {_DAY} AS parsed_last_visit_day,
         {drugs} AS drug_dispensed FROM matched) WHERE drug_dispensed IS NOT NULL)"""


_CARRIED = (
    "site_id", "country", "parent_depot", "tpc", "subject_status", "randomized_treatment",
    "last_study_visit_recorded", "last_study_visit_date", "extract_date", "visit_days", "dispensing_quantity",
    "dispensing_frequency_days", "max_cycles", "visit_count_per_cycle", "parsed_last_visit_cycle",
    "parsed_last_visit_day",
)
_PLAN_OUT = [
    "study_protocol", "subject_number", "drug_dispensed", "total_medicines_required_per_cycle",
    "is_crossover", "is_tpc", *_CARRIED,
]


def _plan(order: str = "tier") -> str:
    firsts = ", ".join(f"arg_min({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _CARRIED)
    return f"""
plan0 AS (SELECT study_protocol, subject_number, drug_dispensed,
    CAST(coalesce(sum(total_medicines_required_per_cycle), 0) AS BIGINT) AS total_medicines_required_per_cycle,
    {firsts} FROM medicine GROUP BY ALL),
plan AS (SELECT *, coalesce(contains(lower(last_study_visit_recorded), 'crossover'), false) AS is_crossover,
    coalesce(contains(lower(last_study_visit_recorded), 'tpc'), false) AS is_tpc FROM plan0)"""


def _bounds(horizon: int = 365, renumber: bool = False) -> str:
    skipped = "missed" if renumber else "0"
    return f"""
b1 AS (SELECT *, list_sort(CASE WHEN len({_DAYS}) = 0 THEN [1] ELSE {_DAYS} END) AS days,
    CASE WHEN dispensing_frequency_days > 0 THEN CAST(dispensing_frequency_days AS INTEGER) ELSE 28 END AS c,
    CASE WHEN max_cycles >= 1 THEN CAST(floor(max_cycles) AS BIGINT) END AS cap,
    last_study_visit_date - CAST(parsed_last_visit_day - 1 AS INTEGER) AS d1,
    CASE WHEN is_crossover THEN 'Crossover ' WHEN is_tpc THEN 'TPC ' ELSE '' END AS prefix
  FROM plan WHERE last_study_visit_date IS NOT NULL AND subject_number IS NOT NULL),
b2 AS (SELECT *, CASE WHEN d1 + c < DATE '2001-09-01'
         THEN CAST(floor((DATE '2001-09-01' - (d1 + c)) / c) AS INTEGER) + 1 ELSE 0 END AS missed FROM b1),
b3 AS (SELECT *, d1 + c + missed * c AS next_start, parsed_last_visit_cycle + 1 + {skipped} AS next_cycle,
         DATE '2001-09-01' + {horizon} AS horizon FROM b2),
bounds AS (SELECT *, CAST(greatest(-1, least(floor((horizon - next_start - (list_min(days) - 1)) / c),
             CASE WHEN cap IS NOT NULL THEN cap - next_cycle END)) AS INTEGER) AS last_k FROM b3)"""


_VISITS = """
rest AS (SELECT b.*, parsed_last_visit_cycle AS cycle, day, d1 + day - 1 AS visit_date, 'A' AS phase
  FROM (SELECT *, unnest(days) AS day FROM bounds) b
  WHERE day > parsed_last_visit_day AND d1 + day - 1 <= horizon
    AND (cap IS NULL OR parsed_last_visit_cycle <= cap)),
whole AS (SELECT * FROM (SELECT b.*, CAST(next_cycle + k AS INTEGER) AS cycle, day,
    CAST(next_start + CAST(k * c AS INTEGER) + day - 1 AS DATE) AS visit_date, 'B' AS phase
  FROM (SELECT *, unnest(days) AS day FROM (SELECT *, unnest(range(0, last_k + 1)) AS k FROM bounds)) b)
  WHERE visit_date <= horizon),
visits AS (SELECT * EXCLUDE (k) FROM (SELECT *, CAST(NULL AS BIGINT) AS k FROM rest UNION ALL BY NAME
           SELECT * FROM whole)),
forecast AS (SELECT study_protocol AS study_name, CAST(parent_depot AS INTEGER) AS parent_depot,
    CAST(site_id AS INTEGER) AS site_id, subject_number, subject_status, country AS subject_country,
    randomized_treatment, tpc, drug_dispensed, dispensing_quantity,
    prefix || 'Cycle ' || CAST(cycle AS VARCHAR) || ' Day ' || CAST(day AS VARCHAR) AS predicted_study_visit,
    CAST(cycle AS INTEGER) AS cycle, CAST(day AS INTEGER) AS day, CAST(visit_date AS DATE) AS predicted_next_visit_date,
    extract_date, phase FROM visits)"""

_STAMP = "TIMESTAMP '2001-09-01 00:00:00' AS processed_timestamp"


def _to_plan(mode: str = "tiered", both: bool = False, cap: str = "max_cycles") -> str:
    return f"{_prelude(cap=cap)},\nmatched AS ({_matched(mode)}),{_medicine(both)},{_plan()}"


def _to_visits(horizon: int = 365, renumber: bool = False, **kw) -> str:
    return f"{_to_plan(**kw)},{_bounds(horizon, renumber)},{_VISITS}"


def _forecast_sql(select: str = f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast", **kw) -> str:
    return f"{_to_visits(**kw)}\n{select}"


# the same with day counts of any length, for plans with numbers that leave the calendar
_WIDE_BOUNDS = f"""
w1 AS (SELECT *, list_sort(CASE WHEN len({_LONG_DAYS}) = 0 THEN [1] ELSE {_LONG_DAYS} END) AS days,
    CAST(CASE WHEN dispensing_frequency_days > 0 THEN dispensing_frequency_days ELSE 28 END AS HUGEINT) AS c,
    CASE WHEN max_cycles >= 1 THEN CAST(floor(max_cycles) AS BIGINT) END AS cap,
    CAST(last_study_visit_date - DATE '1970-01-01' AS HUGEINT) - (CAST(parsed_last_visit_day AS HUGEINT) - 1) AS s0,
    CASE WHEN is_crossover THEN 'Crossover ' WHEN is_tpc THEN 'TPC ' ELSE '' END AS prefix,
    DATE '2001-09-01' - DATE '1970-01-01' AS today, DATE '1677-09-22' - DATE '1970-01-01' AS earliest,
    DATE '2262-04-11' - DATE '1970-01-01' AS latest FROM plan),
w2 AS (SELECT *, CASE WHEN s0 + c < today THEN (today - (s0 + c)) // c + 1 ELSE 0 END AS missed FROM w1),
w3 AS (SELECT *, s0 + c + missed * c AS n0, CAST(parsed_last_visit_cycle AS HUGEINT) + 1 AS next_cycle, today + 365 AS horizon FROM w2),
w4 AS (SELECT *, greatest(-1, CAST(floor(CAST(horizon - n0 - (CAST(days[1] AS HUGEINT) - 1) AS DOUBLE) / CAST(c AS DOUBLE)) AS HUGEINT)) AS by_horizon,
    cap - next_cycle AS by_cap, CAST(days[-1] AS HUGEINT) AS last_day FROM w3),
w5 AS (SELECT *, least(by_horizon + 1, by_cap) AS top FROM w4),
judged AS (SELECT *, CASE WHEN subject_number IS NULL THEN 'no subject number'
    WHEN last_study_visit_date IS NULL THEN 'no last visit date'
    WHEN parsed_last_visit_cycle IS NULL OR parsed_last_visit_day IS NULL THEN 'visit number too long'
    WHEN s0 < earliest THEN 'cycle starts before the calendar'
    WHEN s0 + c > latest OR n0 > latest THEN 'next cycle after the calendar'
    WHEN (last_day > parsed_last_visit_day AND s0 + last_day - 1 > latest) OR (top >= 0 AND n0 + top * c + last_day - 1 > latest)
      THEN 'visit days after the calendar' END AS reason FROM w5),
bounds AS (SELECT * EXCLUDE (c, days, horizon, today, next_cycle), CAST(c AS BIGINT) AS c, CAST(days AS BIGINT[]) AS days,
    DATE '2002-09-01' AS horizon, CAST(next_cycle AS BIGINT) AS next_cycle,
    DATE '1970-01-01' + CAST(s0 AS INTEGER) AS d1, DATE '1970-01-01' + CAST(n0 AS INTEGER) AS next_start,
    CAST(greatest(-1, least(by_horizon, by_cap)) AS INTEGER) AS last_k FROM judged WHERE reason IS NULL)"""


def _wide_plan() -> str:
    prelude = _prelude(view.ODD_SUBJECTS_SQL, mapping_sql=view.ODD_MAPPING_SQL)
    medicine = _medicine().replace(_DAYS, _LONG_DAYS)
    return f"{prelude},\nmatched AS ({_matched('tiered')}),{medicine},{_plan()},{_WIDE_BOUNDS}"


_WIDE_VISITS = _VISITS.replace("d1 + day - 1", "d1 + CAST(day - 1 AS INTEGER)").replace(
    "CAST(k * c AS INTEGER) + day - 1", "CAST(k * c + day - 1 AS INTEGER)"
).replace("CAST(next_cycle + k AS INTEGER) AS cycle", "next_cycle + k AS cycle").replace(
    "CAST(cycle AS INTEGER) AS cycle", "TRY_CAST(cycle AS INTEGER) AS cycle"
)


# ---- inputs -----------------------------------------------------------------------------------


def _inputs(spark, sf_dir, params=P):
    return job.prepared_inputs(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), params)


def _forecast(spark, sf_dir, params=P, **kw):
    return job.forecast(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), params, **kw)


@query(f"WITH subjects AS ({view.SUBJECTS_SQL}) SELECT * FROM subjects")
def subject_view(spark, sf_dir):
    return view.subjects(spark, sf_dir)


@query(f"SELECT * FROM ({view.MAPPING_SQL})")
def mapping_view(spark, sf_dir):
    return view.mapping(spark, sf_dir)


@query(f"{_prelude()} SELECT * FROM active")
def active_subjects(spark, sf_dir):
    return prepare.active_subjects(prepare.prepare_subjects(view.subjects(spark, sf_dir)))


@query(f"{_prelude()} SELECT * FROM people")
def normalized_subjects(spark, sf_dir):
    people, _ = _inputs(spark, sf_dir)
    return people.select(*view.subjects(spark, sf_dir).columns)


@query(
    """SELECT study_protocol, randomized_treatment, subject_status, replace(tpc, '’', '''') AS tpc,
       study_drug_dispensed, country FROM (SELECT trim('  ' || c_name || ' ') AS study_protocol,
       c_mktsegment AS randomized_treatment, 'Randomized' AS subject_status,
       'Physician’s ' || c_mktsegment AS tpc, '"' || c_name || '"' AS study_drug_dispensed,
       CASE WHEN c_nationkey % 2 = 0 THEN 'Asia' END AS country FROM customer)"""
)
def normalized_mapping(spark, sf_dir):
    """Curly quotes and stray spaces in names of the customers, under untidy column names."""
    rows = view.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias(" study_protocol "),
        F.col("c_mktsegment").alias("randomized_treatment"),
        F.lit("Randomized").alias("subject_status"),
        F.concat(F.lit("Physician’s "), "c_mktsegment").alias("Intended TPC"),
        F.concat(F.lit("“"), "c_name", F.lit("”")).alias("study_drug_dispensed"),
        F.when(F.col("c_nationkey") % 2 == 0, " Asia").alias("country"),
        F.col("c_acctbal").alias("not_a_mapping_column"),
    )
    return prepare.normalize_mapping(prepare.prepare_mapping(rows))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS last_study_visit_date,
       CAST(o_orderdate AS DATE) AS extract_date FROM orders"""
)
def date_coercion(spark, sf_dir):
    key = F.col("o_orderkey")
    written = (
        F.when(key % 7 == 0, "not known")
        .when(key % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 5 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(key % 5 == 1, F.date_format("o_orderdate", "MMM d, yyyy"))
        .when(key % 5 == 2, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(key % 5 == 3, F.date_format("o_orderdate", " d MMMM yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    rows = view.table(spark, sf_dir, "orders").select(
        "o_orderkey", written.alias("last_study_visit_date"), F.col("o_orderdate").alias("extract_date")
    )
    return prepare.coerce_dates(rows)


@query(
    f"""WITH subjects AS ({view.SUBJECTS_SQL}) SELECT subject_number, last_study_visit_recorded, {_CYCLE} AS cycle,
        {_DAY} AS day, coalesce(contains(lower(last_study_visit_recorded), 'crossover'), false) AS is_crossover,
        coalesce(contains(lower(last_study_visit_recorded), 'tpc'), false) AS is_tpc,
        CASE WHEN contains(lower(last_study_visit_recorded), 'crossover') THEN 'Crossover '
             WHEN contains(lower(last_study_visit_recorded), 'tpc') THEN 'TPC ' ELSE '' END AS prefix FROM subjects"""
)
def parsed_visits(spark, sf_dir):
    visit = F.col("last_study_visit_recorded")
    return view.subjects(spark, sf_dir).select(
        "subject_number",
        visit,
        text.cycle_number(visit).alias("cycle"),
        text.day_number(visit).alias("day"),
        text.mentions(visit, "crossover").alias("is_crossover"),
        text.mentions(visit, "tpc").alias("is_tpc"),
        text.visit_prefix(visit).alias("prefix"),
    )


@query(
    f"""WITH lines AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE
        CAST(l_linenumber AS VARCHAR) || ', ' || CAST(l_suppkey AS VARCHAR) || ',day ' || l_returnflag || ',1,'
        || CAST(l_orderkey + 1234567890123 AS VARCHAR) END AS visit_days FROM lineitem)
        SELECT l_orderkey, l_linenumber, array_to_string({_LONG_DAYS}, ';') AS days,
        CAST(len({_LONG_DAYS}) AS INTEGER) AS n_days FROM lines"""
)
def visit_day_arrays(spark, sf_dir):
    written = F.when(
        F.col("l_linenumber") != 7,
        F.concat_ws(
            ",",
            F.col("l_linenumber").cast("string"),
            F.concat(F.lit(" "), F.col("l_suppkey").cast("string")),
            F.concat(F.lit("day "), "l_returnflag"),
            F.lit("1"),
            (F.col("l_orderkey") + 1234567890123).cast("string"),
        ),
    )
    days = text.visit_days(written)
    return view.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array_join(F.transform(days, lambda d: d.cast("string")), ";").alias("days"),
        F.size(days).alias("n_days"),
    )


@query(f"{_prelude()} SELECT DISTINCT study_drug_dispensed, base_match, base_mapping FROM m")
def drug_bases(spark, sf_dir):
    _, side = _inputs(spark, sf_dir)
    drug = F.col("study_drug_dispensed")
    names = side.select(drug).distinct()
    countries = side.where(F.col("tier") == match.SPECIFIC).select("_m_country")
    bases = mapping_bases(names, countries)
    return names.join(bases, drug == F.col("drug"), "left").select(
        drug, text.drug_base_of_match(drug).alias("base_match"), F.col("base").alias("base_mapping")
    )


# ---- matching ---------------------------------------------------------------------------------

_MATCH_OUT = [c.split(".")[1] for c in f"{_SUBJECT_COLS}, {_MAPPING_COLS}".split(", ")] + ["tier"]


@query(f"{_prelude()} {_matched('specific')}")
def match_specific(spark, sf_dir):
    return match.match_specific(*_inputs(spark, sf_dir), LIMIT).select(*_MATCH_OUT)


@query(f"{_prelude()} {_matched('generic')}")
def match_generic(spark, sf_dir):
    return match.match_generic(*_inputs(spark, sf_dir), LIMIT).select(*_MATCH_OUT)


@query(f"{_prelude()} {_matched('tiered')}")
def match_tiered(spark, sf_dir):
    return match.match_tiered(*_inputs(spark, sf_dir), LIMIT).select(*_MATCH_OUT)


@query(f"{_prelude()} {_matched('tiered')}")
def match_tiered_shuffled(spark, sf_dir):
    """The tiered match as it runs when the mapping is too large to broadcast."""
    return match.match_tiered(*_inputs(spark, sf_dir), 0).select(*_MATCH_OUT)


@query(f"{_prelude()} {_matched('exclusive')}")
def match_exclusive(spark, sf_dir):
    return match.match_exclusive(*_inputs(spark, sf_dir), LIMIT).select(*_MATCH_OUT)


@query(f"{_prelude()} {_matched('flat')}")
def match_flat(spark, sf_dir):
    return match.match_flat(*_inputs(spark, sf_dir), LIMIT).select(*_MATCH_OUT)


@query(f"{_prelude()} SELECT s.* FROM people s WHERE NOT EXISTS (SELECT 1 FROM m WHERE {_keys('s', 'm')} AND {_FITS})")
def unmatched_subjects(spark, sf_dir):
    return match.unmatched_subjects(*_inputs(spark, sf_dir), LIMIT).select(*view.subjects(spark, sf_dir).columns)


@query(
    f"""{_prelude()} SELECT DISTINCT lower(m.study_protocol) AS study_protocol,
    lower(m.randomized_treatment) AS randomized_treatment, lower(m.tpc) AS tpc,
    lower(m.subject_status) AS subject_status, lower(x.country) AS country, m.study_drug_dispensed AS drug
    FROM m JOIN specific x ON {_keys('x', 'm')} AND x.base_mapping IS NOT DISTINCT FROM m.base_match
    WHERE NOT EXISTS (SELECT 1 FROM specific y WHERE {_keys('y', 'm')} AND y.country = x.country
      AND y.base_mapping IS NOT DISTINCT FROM m.base_match
      AND y.study_drug_dispensed IS NOT DISTINCT FROM m.study_drug_dispensed)"""
)
def override_pairs(spark, sf_dir):
    _, side = _inputs(spark, sf_dir)
    found = match.overrides(side)
    return found.toDF(*[c.removeprefix("_o_m_").removeprefix("_o_") for c in found.columns])


_MEDICINE_OUT = [
    "study_protocol", "subject_number", "drug_dispensed", "visit_count_per_cycle",
    "total_medicines_required_per_cycle", "parsed_last_visit_cycle", "parsed_last_visit_day",
]


@query(f"{_prelude()}, matched AS ({_matched('tiered')}),{_medicine()} SELECT {', '.join(_MEDICINE_OUT)} FROM medicine")
def medicines(spark, sf_dir):
    matched = match.match_tiered(*_inputs(spark, sf_dir), LIMIT)
    return match.with_drug(matched).select(*_MEDICINE_OUT)


@query(
    f"{_prelude()}, matched AS ({_matched('flat')}),{_medicine(True)} SELECT {', '.join(_MEDICINE_OUT)} FROM medicine"
)
def medicines_both_drugs(spark, sf_dir):
    matched = match.match_flat(*_inputs(spark, sf_dir), LIMIT)
    return match.with_drug(matched, both_drugs=True).select(*_MEDICINE_OUT)


# ---- plan -------------------------------------------------------------------------------------


@query(f"{_to_plan()} SELECT {', '.join(_PLAN_OUT)} FROM plan")
def plan(spark, sf_dir):
    return job.build_plan(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), P).select(*_PLAN_OUT)


_HISTORY_ORDER = "year(extract_date) * 1000000000000 + row_key"
_HISTORY_PLAN = (
    f"{_prelude(view.HISTORY_SQL)},\nmatched AS ({_matched('tiered', ', s.row_key')}),{_medicine()},"
    f"{_plan(f'tier * 10000000000000000 + {_HISTORY_ORDER}')}"
)


@query(f"{_HISTORY_PLAN} SELECT {', '.join(_PLAN_OUT)} FROM plan")
def plan_history(spark, sf_dir):
    """Plan rows out of many snapshots per subject: sums, and first non-null values in row order."""
    params = replace(P, subject_order=("extract_date", "row_key"))
    return job.build_plan(view.history(spark, sf_dir), view.mapping(spark, sf_dir), params).select(*_PLAN_OUT)


# ---- projection -------------------------------------------------------------------------------


@query(
    f"""{_to_plan()},{_bounds()} SELECT study_protocol, subject_number, drug_dispensed, array_to_string(days, ';') AS days,
    c AS cycle_days, cap, CAST(d1 AS DATE) AS current_start, CAST(next_start AS DATE) AS next_start, missed,
    CAST(next_cycle AS INTEGER) AS next_cycle, last_k FROM bounds"""
)
def roll_forward(spark, sf_dir):
    plan_rows = job.build_plan(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), P)
    return project.cycle_bounds(plan_rows, P).select(
        *planning.PLAN_KEYS,
        F.array_join(F.transform("_days", lambda d: d.cast("string")), ";").alias("days"),
        F.col("_length").cast("int").alias("cycle_days"),
        F.col("_cap").alias("cap"),
        F.col("_current_start").alias("current_start"),
        F.col("_next_start").alias("next_start"),
        F.col("_missed").cast("int").alias("missed"),
        F.col("_next_cycle").cast("int").alias("next_cycle"),
        F.col("_last_k").alias("last_k"),
    )


def _phase(spark, sf_dir, condition):
    visits = job.forecast_visits(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), P)
    return project.shape_output(visits.where(condition), P)


@query(_forecast_sql(f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast WHERE phase = 'A'"))
def phase_a(spark, sf_dir):
    return _phase(spark, sf_dir, F.col("_k") < 0)


@query(_forecast_sql(f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast WHERE phase = 'B'"))
def phase_b(spark, sf_dir):
    return _phase(spark, sf_dir, F.col("_k") >= 0)


@query(_forecast_sql())
def forecast(spark, sf_dir):
    return _forecast(spark, sf_dir)


@query(_forecast_sql())
def forecast_sorted(spark, sf_dir):
    return _forecast(spark, sf_dir, sort=True)


_EUROPE = f"SELECT * FROM ({view.SUBJECTS_SQL}) WHERE trim(country) = 'EUROPE'"


@query(
    f"{_prelude(_EUROPE)},\nmatched AS ({_matched('tiered')}),"
    f"{_medicine()},{_plan()},{_bounds()},{_VISITS}\nSELECT * EXCLUDE (phase), {_STAMP} FROM forecast"
)
def forecast_filtered(spark, sf_dir):
    """Subjects of one country in its usual spelling alone."""
    return _forecast(spark, sf_dir, subject_filter="country = 'EUROPE'")


@query(_forecast_sql(horizon=1095))
def forecast_three_years(spark, sf_dir):
    return _forecast(spark, sf_dir, replace(P, horizon_days=1095))


@query(_forecast_sql(cap="CAST(11 AS DOUBLE)"))
def forecast_capped(spark, sf_dir):
    mapping = view.mapping(spark, sf_dir).withColumn("max_cycles", F.lit(11.0))
    return job.forecast(view.subjects(spark, sf_dir), mapping, P)


@query(_forecast_sql(renumber=True))
def forecast_renumbered(spark, sf_dir):
    return _forecast(spark, sf_dir, replace(P, renumber_missed=True))


@query(_forecast_sql(mode="exclusive"))
def forecast_exclusive(spark, sf_dir):
    return _forecast(spark, sf_dir, replace(P, match_mode="exclusive"))


@query(_forecast_sql(mode="flat"))
def forecast_flat(spark, sf_dir):
    return _forecast(spark, sf_dir, replace(P, match_mode="flat"))


@query(_forecast_sql(both=True))
def forecast_both_drugs(spark, sf_dir):
    return _forecast(spark, sf_dir, replace(P, both_drugs=True))


def _odd_inputs(spark, sf_dir):
    return view.odd_subjects(spark, sf_dir), view.odd_mapping(spark, sf_dir)


@query(f"{_wide_plan()},{_WIDE_VISITS} SELECT * EXCLUDE (phase), {_STAMP} FROM forecast")
def long_visit_numbers(spark, sf_dir):
    """Forecast of subjects and mapping rows with numbers of any length."""
    return job.forecast(*_odd_inputs(spark, sf_dir), P)


@query(f"{_wide_plan()} SELECT study_protocol, subject_number, drug_dispensed, reason FROM judged WHERE reason IS NOT NULL")
def unprojected_rows(spark, sf_dir):
    """Plan rows that give no visits, with the reason."""
    return project.unprojected(job.build_plan(*_odd_inputs(spark, sf_dir), P), P).select(*planning.PLAN_KEYS, "reason")


@query(
    f"{_wide_plan()},{_WIDE_VISITS} SELECT 'plan_rows' AS check_name, count(*) AS n_rows FROM judged "
    + "".join(
        f"UNION ALL SELECT 'unprojected: {r}', count(*) FILTER (WHERE reason = '{r}') FROM judged " for r in project.REASONS
    )
    + "UNION ALL SELECT 'visits', count(*) FROM forecast "
    + "".join(f"UNION ALL SELECT 'visits without {c}', count(*) FILTER (WHERE {c} IS NULL) FROM forecast " for c in job.WHOLE_NUMBERS)
)
def forecast_write_report(spark, sf_dir):
    """What the write of a forecast table saw, without a second look at plan or table."""
    return job.write_forecast(*_odd_inputs(spark, sf_dir), P, fresh_path(spark, "forecast-observed"))


# ---- reports ----------------------------------------------------------------------------------

_MEASURES = """CAST(sum(dispensing_quantity) AS BIGINT) AS quantity, count(*) AS n_visits,
    count(DISTINCT {'a': study_name, 'b': subject_number}) AS n_subjects"""
_MONTH = "CAST(date_trunc('month', predicted_next_visit_date) AS DATE)"


def _rollup_sql(column: str) -> str:
    return _forecast_sql(
        f"SELECT {column}, drug_dispensed, {_MONTH} AS month, {_MEASURES} FROM forecast "
        f"GROUP BY {column}, drug_dispensed, {_MONTH}"
    )


@query(_rollup_sql("parent_depot"))
def rollup_depot(spark, sf_dir):
    return rollup.demand(_forecast(spark, sf_dir), "depot")


@query(_rollup_sql("site_id"))
def rollup_site(spark, sf_dir):
    return rollup.demand(_forecast(spark, sf_dir), "site")


@query(_rollup_sql("study_name"))
def rollup_study(spark, sf_dir):
    return rollup.demand(_forecast(spark, sf_dir), "study")


_ROLLUP_SETS = f"""{_to_visits()}, f AS (SELECT *, {_MONTH} AS month FROM forecast)
SELECT 'depot' AS level, parent_depot, NULL AS site_id, NULL AS study_name, drug_dispensed, month, {_MEASURES}
  FROM f GROUP BY parent_depot, drug_dispensed, month
UNION ALL SELECT 'site', NULL, site_id, NULL, drug_dispensed, month, {_MEASURES}
  FROM f GROUP BY site_id, drug_dispensed, month
UNION ALL SELECT 'study', NULL, NULL, study_name, drug_dispensed, month, {_MEASURES}
  FROM f GROUP BY study_name, drug_dispensed, month"""


@query(_ROLLUP_SETS)
def rollup_sets(spark, sf_dir):
    return rollup.demand_all_levels(_forecast(spark, sf_dir))


@query(_ROLLUP_SETS)
def rollup_sets_incremental(spark, sf_dir):
    """Visits of the first half of each month as one part, the others merged into it: most subjects are in both."""
    rows = stage(_forecast(spark, sf_dir), "visits")
    early = F.dayofmonth("predicted_next_visit_date") <= 15
    old, new = rows.where(early), rows.where(~early)
    known = stage(rollup.number_subjects(old), "subject-numbers")
    stored = stage(rollup.demand_part(old, known), "demand-part")
    numbers = stage(rollup.number_subjects(new, known), "subject-numbers")
    merged = rollup.merge_demand(stored.unionByName(rollup.demand_part(new, numbers)))
    return rollup.demand_of_part(merged)


@query(
    _forecast_sql(
        f"""SELECT * EXCLUDE (phase), {_STAMP} FROM forecast WHERE subject_number = (SELECT subject_number FROM
        (SELECT subject_number, count(*) AS n FROM forecast GROUP BY subject_number)
        ORDER BY n DESC, subject_number LIMIT 1)"""
    )
)
def subject_schedule(spark, sf_dir):
    """Schedule of the subject with the most visits."""
    rows = _forecast(spark, sf_dir)
    visits = rows.groupBy("subject_number").agg(F.count(F.lit(1)).alias("n"))
    busiest = visits.agg(F.max_by("subject_number", F.struct("n", -F.col("subject_number")))).scalar()
    return rollup.subject_schedule(rows, busiest)


@query(
    _forecast_sql(
        """SELECT count(*) AS n_visits, count(DISTINCT subject_number) AS n_subjects,
        count(DISTINCT drug_dispensed) AS n_drugs, min(predicted_next_visit_date) AS first_visit,
        max(predicted_next_visit_date) AS last_visit FROM forecast"""
    )
)
def forecast_summary(spark, sf_dir):
    return job.run_summary(_forecast(spark, sf_dir))


# ---- quality ----------------------------------------------------------------------------------


def _counted(name: str, condition: str, source: str) -> str:
    return f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {condition}) AS n_rows FROM {source}"


@query(
    f"{_prelude()} "
    + " UNION ALL ".join(
        [
            _counted("excluded_status", f"subject_status IN ({_EXCLUDED})", "subjects"),
            _counted("null_status", "subject_status IS NULL", "subjects"),
            _counted("null_last_visit_date", "last_study_visit_date IS NULL", "subjects"),
            _counted(
                "unparsable_visit",
                "last_study_visit_recorded IS NULL OR "
                "NOT regexp_matches(last_study_visit_recorded, '(?i)(?:C|Cycle\\s?)(\\d+)')",
                "subjects",
            ),
            _counted("mapping_without_study", "study_protocol IS NULL", "mapping"),
            _counted("mapping_without_days", "visit_days IS NULL", "mapping"),
            _counted(
                "mapping_without_cycle_length",
                "dispensing_frequency_days IS NULL OR dispensing_frequency_days <= 0",
                "mapping",
            ),
            _counted(
                "active_subject_unmatched",
                f"NOT EXISTS (SELECT 1 FROM m WHERE {_keys('s', 'm')} AND {_FITS})",
                "people s",
            ),
        ]
    )
)
def quality_input(spark, sf_dir):
    return quality.input_checks(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), P)


@query(
    f"{_to_visits()} "
    + " UNION ALL ".join(
        [
            _counted("date_not_in_future", "predicted_next_visit_date <= DATE '2001-09-01'", "forecast"),
            _counted("cycle_or_day_not_positive", "cycle < 1 OR day < 1", "forecast"),
            _counted("drug_missing", "drug_dispensed IS NULL OR drug_dispensed = ''", "forecast"),
            *[_counted(f"null_{c}", f"{c} IS NULL", "forecast") for c in quality.NOT_NULL],
            _counted(
                "duplicate_visit",
                "n > 1",
                "(SELECT count(*) AS n FROM forecast GROUP BY study_name, subject_number, drug_dispensed, cycle, "
                "day, predicted_next_visit_date)",
            ),
        ]
    )
)
def quality_output(spark, sf_dir):
    return quality.output_checks(_forecast(spark, sf_dir), P)


_STEPS = """steps AS (SELECT *, visit_date - lag(visit_date) OVER w AS gap, cycle - lag(cycle) OVER w AS step FROM visits
  WINDOW w AS (PARTITION BY study_protocol, subject_number, drug_dispensed, day ORDER BY visit_date, cycle))"""


@query(
    f"{_to_visits()}, {_STEPS} "
    + " UNION ALL ".join(
        [
            _counted("visits", "true", "steps"),
            _counted("gap_is_one_cycle", "gap = c", "steps"),
            _counted("gap_is_several_cycles", "gap > c AND gap % c = 0", "steps"),
            _counted("gap_off_grid", "gap % c <> 0", "steps"),
            _counted("cycle_step_not_one", "step <> 1", "steps"),
            _counted("day_outside_pattern", "NOT list_contains(days, day)", "steps"),
            _counted("cycle_beyond_cap", "cycle > cap", "steps"),
        ]
    )
)
def cadence_check(spark, sf_dir):
    return quality.cadence_checks(job.forecast_visits(view.subjects(spark, sf_dir), view.mapping(spark, sf_dir), P))


# ---- snapshots --------------------------------------------------------------------------------


@query(
    f"""WITH h AS ({view.HISTORY_SQL}) SELECT * FROM h
    WHERE CAST(processed_timestamp AS DATE) = (SELECT max(CAST(processed_timestamp AS DATE)) FROM h)"""
)
def latest_snapshot(spark, sf_dir):
    return snapshot_of(view.history(spark, sf_dir))


_LATEST_HISTORY = (
    f"SELECT * FROM ({view.HISTORY_SQL}) WHERE extract_date = "
    f"(SELECT max(extract_date) FROM ({view.HISTORY_SQL}))"
)


@query(
    f"{_prelude(_LATEST_HISTORY)},\nmatched AS ({_matched('tiered', ', s.row_key')}),{_medicine()},"
    f"{_plan(f'tier * 10000000000000000 + {_HISTORY_ORDER}')},{_bounds()},{_VISITS}\n"
    f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast"
)
def snapshot_forecast(spark, sf_dir):
    """Forecast of the latest extract out of the whole history."""
    rows = snapshot_of(view.history(spark, sf_dir), "extract_date")
    params = replace(P, subject_order=("extract_date", "row_key"))
    return job.forecast(rows, view.mapping(spark, sf_dir), params)


# ---- whole runs -------------------------------------------------------------------------------


@query(_forecast_sql())
def forecast_from_csv(spark, sf_dir):
    """Subjects and mapping written as CSV, forecast from the files, result read back from CSV."""
    root = fresh_path(spark, "csv-run")
    sinks.write_csv(view.subjects(spark, sf_dir), f"{root}/subjects")
    sinks.write_csv(view.mapping(spark, sf_dir), f"{root}/mapping")
    job.forecast_from_csv(spark, f"{root}/subjects", f"{root}/mapping", P, f"{root}/forecast", "gzip")
    return spark.read.schema(FORECAST_SCHEMA).option("header", "true").csv(f"{root}/forecast")


@query(
    f"{_prelude(view.HISTORY_SQL)},\nmatched AS ({_matched('tiered', ', s.row_key')}),{_medicine()},"
    f"{_plan('tier * 10000000000000000 - row_key')},{_bounds()},{_VISITS}\n"
    f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast"
)
def forecast_in_file_order(spark, sf_dir):
    """The history as CSV files with the last key first: where a subject has several rows, the earlier one in the files ranks first."""
    root = fresh_path(spark, "csv-history")
    sinks.write_csv(view.history(spark, sf_dir).orderBy(F.desc("row_key")), f"{root}/subjects")
    sinks.write_csv(view.mapping(spark, sf_dir), f"{root}/mapping")
    return job.forecast_from_csv(spark, f"{root}/subjects", f"{root}/mapping", P)


@query(
    f"{_prelude(_LATEST_HISTORY)},\nmatched AS ({_matched('tiered', ', s.row_key')}),{_medicine()},"
    f"{_plan(f'tier * 10000000000000000 + {_HISTORY_ORDER}')},{_bounds()},{_VISITS}\n"
    f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast"
)
def forecast_from_tables(spark, sf_dir):
    """The history as a table in date partitions; forecast of its latest partition, stored and read back."""
    root = fresh_path(spark, "table-run")
    sinks.write_partitions(view.history(spark, sf_dir), f"{root}/subjects")
    sinks.write_whole(view.mapping(spark, sf_dir), f"{root}/mapping")
    params = replace(P, subject_order=("extract_date", "row_key"))
    job.forecast_from_tables(
        spark, f"{root}/subjects", f"{root}/mapping", params, f"{root}/forecast", snapshot_col="extract_date"
    )
    return tables.scan(spark, f"{root}/forecast")


@query(
    f"{_prelude(_LATEST_HISTORY)},\nmatched AS ({_matched('tiered', ', s.row_key')}),{_medicine()},"
    f"{_plan(f'tier * 10000000000000000 + {_HISTORY_ORDER}')},{_bounds()},{_VISITS}\n"
    f"SELECT * EXCLUDE (phase), {_STAMP} FROM forecast"
)
def forecast_from_catalog(spark, sf_dir):
    """The same run on catalog tables by name: history by date partitions, mapping and forecast whole."""
    root, names = fresh_path(spark, "catalog-run"), [f"run_{uuid.uuid4().hex}_{x}" for x in ("subjects", "mapping", "forecast")]
    subjects, mapping, out = names
    catalog.replace_partitions(view.history(spark, sf_dir), subjects, f"{root}/subjects")
    catalog.replace_table(view.mapping(spark, sf_dir), mapping, f"{root}/mapping")
    params = replace(P, subject_order=("extract_date", "row_key"))
    job.forecast_from_tables(
        spark, subjects, mapping, params, f"{root}/forecast", snapshot_col="extract_date", output_table=out
    )
    return tables.scan(spark, out)
