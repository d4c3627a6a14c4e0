"""Term and valence dictionaries."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.functions.lexicon import TECH_VALENCES
from threadloom.schemas import TERM_FILE, TERMS, VALENCES
from threadloom.sizing import broadcast_known

# Default technologies and skills as (name, aliases, weight) by category.
TECHNOLOGIES = {
    "big_data": [
        ("hadoop", ["hdp", "apache hadoop"], 0.8),
        ("spark", ["pyspark", "apache spark"], 0.9),
        ("flink", ["apache flink"], 0.7),
        ("hive", ["apache hive"], 0.6),
        ("pig", ["apache pig"], 0.5),
    ],
    "databases": [
        ("postgresql", ["postgres", "psql"], 0.9),
        ("mysql", ["mariadb"], 0.8),
        ("mongodb", ["mongo"], 0.7),
        ("cassandra", ["apache cassandra"], 0.6),
    ],
}
SKILLS = {
    "technical": [
        ("data modeling", ["modeling", "data model"], 0.8),
        ("etl", ["extract transform load", "data pipeline"], 0.9),
        ("database design", ["db design", "data schema"], 0.6),
        ("data warehousing", ["data warehouse"], 0.7),
    ],
    "soft_skills": [
        ("problem solving", ["analytical thinking"], 0.7),
        ("communication", ["team communication"], 0.6),
        ("teamwork", ["collaboration"], 0.6),
    ],
    "certifications": [
        ("aws certified", ["aws cert", "amazon web services"], 0.8),
        ("azure certified", ["azure cert", "microsoft azure"], 0.7),
        ("gcp certified", ["gcp cert", "google cloud platform"], 0.7),
    ],
}


def _as_json(dictionary: dict[str, list[tuple]]) -> str:
    return json.dumps(
        {c: [{"name": n, "aliases": a, "weight": w} for n, a, w in items] for c, items in dictionary.items()}
    )


def flatten_terms(files: DataFrame) -> DataFrame:
    """(category, name, term, weight, term_order) of a frame with one dictionary JSON in `value`.

    term_order counts all terms in the order of the file: categories, their entries, the name before its aliases. Empty
    aliases are dropped.
    """
    categories = F.filter(F.map_entries(F.from_json("value", TERM_FILE)), lambda c: c["value"].isNotNull())

    def terms_of(category: Column, item: Column) -> Column:
        aliases = F.coalesce(item["aliases"], F.array().cast("array<string>"))
        return F.transform(
            F.concat(F.array(item["name"]), aliases),
            lambda term: F.struct(
                category["key"].alias("category"), item["name"].alias("name"), term.alias("term"), item["weight"].alias("weight")
            ),
        )

    found = F.flatten(F.transform(categories, lambda c: F.flatten(F.transform(c["value"], lambda i: terms_of(c, i)))))
    terms = files.select(F.posexplode(found).alias("term_order", "entry")).select("entry.*", "term_order")
    return terms.where(F.coalesce("term", F.lit("")) != "")


def load_term_dictionary(
    spark: SparkSession, path: str | None, default: dict[str, list[tuple]], lower: bool = False
) -> DataFrame:
    """Flattened dictionary file; the default when there is no path, no file, or nothing in it that parses."""
    fallback = flatten_terms(spark.createDataFrame([(_as_json(default),)], "value string"))
    terms = fallback
    if path is not None:
        try:
            files = spark.read.text(path, wholetext=True)
            loaded = flatten_terms(files)
            terms = fallback if loaded.isEmpty() else loaded
        except Exception as error:  # a missing path is the documented reason to fall back
            if "PATH_NOT_FOUND" not in str(error):
                raise
    if lower:
        terms = terms.withColumns({"name": F.lower("name"), "term": F.lower("term")})
    return terms.select(*TERMS.fieldNames())


def term_pairs(terms: DataFrame, max_rows: int = 100_000) -> list[tuple[str, str]]:
    """(term, name) in dictionary order, for functions that carry the dictionary in their plan; raises beyond
    max_rows. A later entry of a term overrides the name of an earlier one and keeps its place."""
    rows = terms.select("term", "name", "term_order").limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"dictionary has more than {max_rows} terms")
    pairs: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: r["term_order"]):
        pairs[row["term"]] = row["name"]
    return list(pairs.items())


def single_words(pairs: list[tuple[str, str]]) -> list[str]:
    return [term for term, _ in pairs if len(term.split()) == 1]


def add_term(
    terms: DataFrame, name: str, category: str = "custom", aliases: list[str] | None = None, weight: float = 0.5
) -> DataFrame:
    """The dictionary with a name and its aliases appended; terms it already had now mean the new name."""
    spark = terms.sparkSession
    added = [t for t in [name, *(aliases or [])] if t]
    last = terms.agg(F.coalesce(F.max("term_order"), F.lit(0))).scalar()
    fresh = spark.createDataFrame(
        [(category, name, t, float(weight), i + 1) for i, t in enumerate(added)], TERMS
    ).withColumn("term_order", F.col("term_order") + last)
    rest = terms.join(broadcast_known(fresh.select("term"), len(added)), "term", "left_anti")
    return rest.unionByName(fresh).select(*TERMS.fieldNames())


def load_valences(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(term, valence) of a JSON object; the default table when there is no path, no file or nothing in it."""
    fallback = spark.createDataFrame(list(TECH_VALENCES.items()), VALENCES)
    if path is None:
        return fallback
    try:
        files = spark.read.text(path, wholetext=True)
        loaded = files.select(F.explode(F.from_json("value", "map<string, double>")).alias("term", "valence"))
        return fallback if loaded.isEmpty() else loaded
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return fallback


def update_valences(valences: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates win over the stored values."""
    ranked = valences.withColumn("_rank", F.lit(0)).unionByName(updates.withColumn("_rank", F.lit(1)))
    return ranked.groupBy("term").agg(F.max_by("valence", "_rank").alias("valence"))
