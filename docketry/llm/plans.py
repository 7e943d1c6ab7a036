"""Queries of the llm problems over the project's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import addresses, leakage, lookalikes, matching, mixture, places
from docketry.session import table


def p2_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct entry with the place it names, how it was found and how many incidents hold it."""
    cities = table(spark, sf_dir, "incidents").where(F.col("city").isNotNull()).groupBy(F.col("city").alias("raw")).agg(F.count("*").alias("n_rows"))
    return places.resolve_names(cities, table(spark, sf_dir, "gazetteer"), table(spark, sf_dir, "jurisdiction_crosswalk")).join(cities, "raw")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "gazetteer").select(F.col("canonical").alias("city")).distinct()
    rows = table(spark, sf_dir, "incidents").where(F.col("city").isNotNull()).select("incident_id", "city").distinct().join(listed, "city", "left_anti")
    found = places.resolve_names(rows.select(F.col("city").alias("raw")), table(spark, sf_dir, "gazetteer"), table(spark, sf_dir, "jurisdiction_crosswalk"))
    return rows.join(found.select(F.col("raw").alias("city"), "canonical"), "city").select("incident_id", "canonical").distinct()


def address_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents (left) and person records (right) as ``id, source, address, zip, city``."""
    incidents = table(spark, sf_dir, "incidents").select(F.col("incident_id").alias("id"), F.lit("left").alias("source"), "address", "zip", "city").distinct()
    found = places.resolve_names(incidents.select(F.col("city").alias("raw")), table(spark, sf_dir, "gazetteer"), table(spark, sf_dir, "jurisdiction_crosswalk"))
    named = found.where(F.col("canonical") != places.NONE).select(F.col("raw").alias("city"), "canonical")
    left = incidents.join(named, "city", "left").select("id", "source", "address", "zip", F.col("canonical").alias("city"))
    people = table(spark, sf_dir, "synth_a").unionByName(table(spark, sf_dir, "synth_b"))
    return left.unionByName(people.select(F.col("rec_id").alias("id"), F.lit("right").alias("source"), "address", "zip", F.lit(None).cast("string").alias("city")))


def p3_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate pair of records, within and across the two sources, with similarities and confidence."""
    people = [table(spark, sf_dir, name).withColumn("source", F.lit(name)) for name in ("synth_a", "synth_b")]
    return matching.match(people[0].unionByName(people[1]), addresses.city_spellings(table(spark, sf_dir, "gazetteer")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    across = p3_pairs(spark, sf_dir).where((F.col("a_source") == "synth_a") & (F.col("b_source") == "synth_b") & (F.col("confidence") >= 0.5))
    return across.select(F.col("a_id").alias("rec_id_a"), F.col("b_id").alias("rec_id_b")).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = addresses.same_building(address_records(spark, sf_dir), table(spark, sf_dir, "gazetteer"))
    return pairs.select(F.col("left").alias("incident_id"), F.col("right").alias("rec_id"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.actual_shares(p9_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.lookalike_lines(table(spark, sf_dir, "documents")).select("doc_id", "line_no")


def p10_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.normalise_text(table(spark, sf_dir, "documents"))


QUERIES = {"p3_pairs": p3_pairs, "p3_found": p3_found, "p6_found": p6_found, "p2_crosswalk": p2_crosswalk, "p2_found": p2_found, "p8_found": p8_found, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found, "p10_text": p10_text}
ORACLES: dict[str, str] = {}
