"""Base names of the drugs of country rows: the name without dose, countries and brackets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.functions import text
from dosecast.sources.staging import stage


def mapping_bases(drugs: DataFrame, countries: DataFrame) -> DataFrame:
    """``drug`` and ``base`` of each distinct name in the only column of ``drugs``.

    ``countries`` holds lower-case country names in its only column. They leave a name one at a time, longest first,
    wherever they stand between word borders. Which of them a name holds is looked up: the runs of its words
    join the country list, so a row never meets a country that it does not hold, however many there are.
    Where a removal brings words together that make another country, that one is looked up too, until no step of any
    name holds a country that is not on its list; then the outcome is that of trying all of them.
    Two rounds usually; every round adds a country to some name.
    """
    listed = countries.toDF("_country").where("_country <> ''").distinct()
    sizes = listed.agg(F.max(F.size(F.filter(F.split("_country", r"(?U)\b"), lambda part: part != ""))))
    names = drugs.toDF("drug").where("drug IS NOT NULL").distinct()
    found = names.select(
        "drug",
        text.without_dose(F.col("drug")).alias("name"),
        F.coalesce(sizes.scalar(), F.lit(0)).alias("longest"),
        F.array().cast("array<string>").alias("countries"),
    )
    while True:
        # two rounds in one job: mostly the second one finds nothing more
        found = stage(_looked_up(_looked_up(found, listed), listed), "drug-countries")
        more = found.agg(F.sum(F.size("countries") - F.col("before")).alias("n")).first()["n"]
        if not more:
            base = text.tidy_base(F.element_at(text.country_steps(F.col("name"), F.col("countries")), -1))
            return found.select("drug", base.alias("base"))
        found = found.drop("before")


def _looked_up(found: DataFrame, listed: DataFrame) -> DataFrame:
    """The names with all countries that a step of the removal so far holds; ``before`` is how many were on the list."""
    steps = text.country_steps(F.col("name"), F.col("countries"))
    runs = F.flatten(F.transform(steps, lambda step: text.phrases(text.words_and_gaps(step), F.col("longest"))))
    held = found.select(F.col("drug").alias("_drug"), F.explode(F.array_distinct(F.transform(runs, F.lower))).alias("_phrase"))
    hits = held.join(listed, F.col("_phrase") == F.col("_country")).groupBy("_drug").agg(F.collect_set("_country").alias("_more"))
    return found.join(hits, F.col("drug") == F.col("_drug"), "left").select(
        "drug", "name", "longest", F.coalesce("_more", "countries").alias("countries"), F.size("countries").alias("before")
    )
