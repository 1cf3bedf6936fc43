"""Subjects to treatment-mapping rows: country tiers, override suppression, drugs and quantities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.fixed_values import MATCH_KEYS, TREATMENT_MAPPING_HEADERS, headers
from dosecast.functions import text
from dosecast.operators.bases import mapping_bases
from dosecast.operators.joins import dimension_join

SPECIFIC, GENERIC = 0, 1
_ADDED = {c: kind for c, _, kind in headers(TREATMENT_MAPPING_HEADERS) if c not in (*MATCH_KEYS, "country")}
_DIM_KEYS = [f"_m_{k}" for k in MATCH_KEYS]
SUBJECT_KEYS = [f"_s_{k}" for k in MATCH_KEYS]
_HELPERS = (*_DIM_KEYS, *SUBJECT_KEYS, "_m_country", "_s_country")


def mapping_side(mapping: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Normalised mapping rows with lower-case keys, the country tier, quantities and an order among rows.

    What depends on the mapping alone is worked out here, once per mapping row, not once per match.
    """
    given = mapping.withColumns(
        {c: F.lit(None).cast(kind) for c, kind in _ADDED.items() if c not in mapping.columns}
    )
    visits = F.size(text.visit_days(F.col("visit_days")))
    counted = given.withColumn("visit_count_per_cycle", visits)
    return counted.select(
        *[F.lower(k).alias(d) for k, d in zip(MATCH_KEYS, _DIM_KEYS, strict=True)],
        F.lower("country").alias("_m_country"),
        F.when(F.col("country").isNull(), GENERIC).otherwise(SPECIFIC).cast("int").alias("tier"),
        F.struct(*order, F.xxhash64(*mapping.columns).alias("_hash")).alias("_mapping_order"),
        *_ADDED,
        "visit_count_per_cycle",
        (F.col("visit_count_per_cycle") * F.col("dispensing_quantity")).alias("total_medicines_required_per_cycle"),
        F.array_compact(F.array("study_drug_dispensed", "additional_study_drug_dispensed")).alias("_drugs"),
    )


def subject_side(subjects: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Normalised subjects with lower-case keys, the parsed last visit and an order among rows.

    The order is the given columns, then a row hash.
    """
    present = [c for c in order if c in subjects.columns]
    visit = F.col("last_study_visit_recorded")
    return subjects.withColumns(
        {
            **{s: F.lower(k) for k, s in zip(MATCH_KEYS, SUBJECT_KEYS, strict=True)},
            "_s_country": F.lower("country"),
            "parsed_last_visit_cycle": text.cycle_number(visit),
            "parsed_last_visit_day": text.day_number(visit),
            "_subject_order": F.struct(*present, F.xxhash64(*subjects.columns).alias("_hash")),
        }
    )


def subject_keys() -> dict[str, Column]:
    return {d: F.col(k) for k, d in zip(SUBJECT_KEYS, _DIM_KEYS, strict=True)}


def _subject_columns(joined: DataFrame) -> DataFrame:
    return joined.withColumn("subject_country", F.col("country")).drop(*_HELPERS)


def match_specific(subjects: DataFrame, side: DataFrame, max_bytes: int) -> DataFrame:
    """Country rows of the mapping: four keys and the country."""
    keys = subject_keys() | {"_m_country": F.col("_s_country")}
    specific = side.where(F.col("tier") == SPECIFIC)
    return _subject_columns(dimension_join(subjects, specific, keys, max_bytes=max_bytes))


def match_generic(subjects: DataFrame, side: DataFrame, max_bytes: int) -> DataFrame:
    """Generic rows of the mapping: four keys, for every subject."""
    generic = side.where(F.col("tier") == GENERIC)
    return _subject_columns(dimension_join(subjects, generic, subject_keys(), max_bytes=max_bytes))


def match_flat(subjects: DataFrame, side: DataFrame, max_bytes: int) -> DataFrame:
    """All mapping rows on four keys, whatever their country."""
    flat = side.withColumn("tier", F.lit(SPECIFIC))
    return _subject_columns(dimension_join(subjects, flat, subject_keys(), max_bytes=max_bytes))


def overrides(side: DataFrame) -> DataFrame:
    """(keys, country, drug) that a country row suppresses for subjects of that country.

    A drug is suppressed where its base name is the base name of some drug among the country rows with
    the same keys, unless the drug itself is among those. Works on the mapping alone: the subjects see
    only the outcome.
    """
    specific = side.where(F.col("tier") == SPECIFIC)
    bases = mapping_bases(specific.select("study_drug_dispensed"), specific.select("_m_country"))
    bases = bases.select(F.col("drug").alias("_b_drug"), F.col("base").alias("_base"))
    named = specific.join(bases, F.col("study_drug_dispensed") == F.col("_b_drug"), "left")
    allowed = named.select(
        *[F.col(k).alias(f"_a{k}") for k in _DIM_KEYS],
        F.col("_m_country").alias("_a_country"),
        F.col("_base").alias("_a_base"),
        F.col("study_drug_dispensed").alias("_a_drug"),
    ).distinct()
    known = allowed.drop("_a_drug").distinct()
    drugs = side.select(
        *_DIM_KEYS,
        F.col("study_drug_dispensed").alias("_o_drug"),
        text.drug_base_of_match(F.col("study_drug_dispensed")).alias("_o_base"),
    ).distinct()

    def same_keys() -> Column:
        condition = F.col("_o_base").eqNullSafe(F.col("_a_base"))
        for k in _DIM_KEYS:
            condition = condition & F.col(k).eqNullSafe(F.col(f"_a{k}"))
        return condition

    overridden = drugs.join(known, same_keys()).select(
        *_DIM_KEYS, F.col("_a_country").alias("_o_country"), "_o_drug", "_o_base"
    )
    listed = same_keys() & (F.col("_o_country") == F.col("_a_country")) & F.col("_o_drug").eqNullSafe(F.col("_a_drug"))
    return overridden.join(allowed, listed, "left_anti").select(
        *[F.col(k).alias(f"_o{k}") for k in _DIM_KEYS], "_o_country", "_o_drug"
    )


def match_tiered(subjects: DataFrame, side: DataFrame, max_bytes: int) -> DataFrame:
    """Country rows and generic rows in one join, minus the drugs a country row overrides."""
    fits_country = F.col("_m_country").isNull() | (F.col("_m_country") == F.col("_s_country"))
    both = dimension_join(subjects, side, subject_keys(), residual=fits_country, max_bytes=max_bytes)
    keys = {f"_o{k}": F.col(k) for k in _DIM_KEYS}
    keys |= {"_o_country": F.col("_s_country"), "_o_drug": F.col("study_drug_dispensed")}
    hot = subjects, {f"_o{d}": F.col(k) for d, k in zip(_DIM_KEYS, SUBJECT_KEYS, strict=True)}
    kept = dimension_join(both, overrides(side), keys, "left_anti", max_bytes=max_bytes, sketched=hot)
    return _subject_columns(kept)


def match_exclusive(subjects: DataFrame, side: DataFrame, max_bytes: int) -> DataFrame:
    """Country rows; generic rows only for subjects that no country row fits."""
    fits_country = F.col("_m_country").isNull() | (F.col("_m_country") == F.col("_s_country"))
    both = dimension_join(subjects, side, subject_keys(), residual=fits_country, max_bytes=max_bytes)
    served = (
        side.where(F.col("tier") == SPECIFIC)
        .select(*[F.col(k).alias(f"_o{k}") for k in _DIM_KEYS], F.col("_m_country").alias("_o_country"))
        .distinct()
        .withColumn("_o_tier", F.lit(GENERIC))
    )
    keys = {f"_o{k}": F.col(k) for k in _DIM_KEYS}
    keys |= {"_o_country": F.col("_s_country"), "_o_tier": F.col("tier")}
    hot = subjects, {f"_o{d}": F.col(k) for d, k in zip(_DIM_KEYS, SUBJECT_KEYS, strict=True)}
    return _subject_columns(dimension_join(both, served, keys, "left_anti", max_bytes=max_bytes, sketched=hot))


MATCHERS = {"tiered": match_tiered, "exclusive": match_exclusive, "flat": match_flat}


def unmatched_subjects(subjects: DataFrame, side: DataFrame, max_bytes: int) -> DataFrame:
    """Subjects that neither a country row nor a generic row fits."""
    fits_country = F.col("_m_country").isNull() | (F.col("_m_country") == F.col("_s_country"))
    left = dimension_join(subjects, side, subject_keys(), "left_anti", residual=fits_country, max_bytes=max_bytes)
    return left.drop(*_HELPERS)


def with_drug(matched: DataFrame, both_drugs: bool = False) -> DataFrame:
    """One row per drug to dispense: the primary one, else the additional one; or both. None, no row."""
    if both_drugs:
        return matched.withColumn("drug_dispensed", F.explode("_drugs")).drop("_drugs")
    return matched.withColumn("drug_dispensed", F.get("_drugs", F.lit(0))).where("drug_dispensed IS NOT NULL").drop("_drugs")
