"""Tiered place resolution: exact or alias, prefix, fuzzy with a clear lead, zip, unresolved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.functions.similarity import indel_ratio
from docketry.functions.text import counted_letters
from docketry.lineage import cut

#: letters a canonical name must have to be found at the start of an entry
PREFIX = 6


def clean_place(raw: Column, region: str = "NORTH CAROLINA|UNITED STATES OF AMERICA|UNITED STATES|USA", region_code: str = "N C") -> Column:
    """Struct of ``name`` (letters only, region words dropped) and ``zip5``."""
    text = F.upper(F.coalesce(raw, F.lit("")))
    found = F.regexp_extract(text, r"\b(\d{5})(?:-?\d{4})?\b", 1)
    code = r",?\s*\b" + r"\.?\s*".join(region_code.split()) + r"\.?(?![A-Z])"
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\d+", " "), rf"\b(?:{region})\b", " "), code, " ")
    return F.struct(F.trim(F.regexp_replace(name, r"[^A-Z]+", " ")).alias("name"), F.when(found != "", found).alias("zip5"))


def resolve_places(values: DataFrame, gazetteer: DataFrame, threshold: float = 80.0, lead: float = 10.0, region: str = "NORTH CAROLINA|UNITED STATES OF AMERICA|UNITED STATES|USA", region_code: str = "N C") -> DataFrame:
    """(raw, canonical, method, score, rows): each distinct ``raw`` value resolved once; null counts as the empty text.

    ``gazetteer`` has ``canonical, alias, zips``. Every distinct cleaned name meets the names it may be by equi-joins:
    those it begins with, and those with which it shares enough letters for the similarity to matter.
    """
    raws = values.groupBy(F.coalesce("raw", F.lit("")).alias("raw")).agg(F.count("*").alias("rows")).withColumn("c", clean_place(F.col("raw"), region, region_code)).select("raw", "rows", "c.name", "c.zip5")
    listed = gazetteer.select("canonical").distinct()
    forms = gazetteer.select("canonical", F.explode(F.array("canonical", "alias")).alias("name")).where(F.col("name").isNotNull()).groupBy("name").agg(F.min("canonical").alias("exact"))
    zips = gazetteer.select("canonical", F.explode("zips").alias("zip5")).groupBy("zip5").agg(F.count_distinct("canonical").alias("n"), F.min("canonical").alias("by_zip")).where("n = 1").drop("n")
    names = raws.select("name").distinct()
    open_names = cut(names.join(forms, "name", "left_anti").where(F.length("name") > 0))
    longest = listed.agg(F.max(F.length("canonical")).alias("_longest"))  # one row
    starts = open_names.crossJoin(F.broadcast(longest)).where((F.length("name") >= PREFIX) & (F.col("_longest") >= PREFIX))
    starts = starts.select("name", F.explode(F.transform(F.sequence(F.lit(PREFIX), F.least(F.length("name"), "_longest")), lambda n: F.substring("name", F.lit(1), n))).alias("canonical"))
    begun = starts.join(listed, "canonical").groupBy("name").agg(F.count("*").alias("prefixes"), F.min("canonical").alias("by_prefix"))
    # a runner-up below threshold - lead never matters, and no subsequence is longer than what letters and spaces are shared
    least = threshold - lead
    lettered = lambda df, c: df.select(c, F.explode(counted_letters(F.col(c))).alias("letter"))
    spaces = lambda c: F.length(c) - F.size(counted_letters(F.col(c)))
    shared = lettered(open_names, "name").join(lettered(listed, "canonical"), "letter").groupBy("name", "canonical").agg(F.count("*").alias("n"))
    near = shared.where(F.col("n") + F.least(spaces("name"), spaces("canonical")) >= least / 200 * (F.length("name") + F.length("canonical")) - 1e-9)
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated: the rows are few bytes but much work
    scored = near.select("name", "canonical").repartition(tasks, "name").withColumn("ratio", indel_ratio(F.col("name"), F.col("canonical")))
    rank = Window.partitionBy("name").orderBy(F.col("ratio").desc(), "canonical")
    lined = scored.withColumns({"k": F.row_number().over(rank), "second": F.coalesce(F.lead("ratio").over(rank), F.lit(0.0))})
    tops = lined.where("k = 1").select("name", F.struct("canonical", "ratio", "second").alias("top"))
    joined = raws.join(forms, "name", "left").join(begun, "name", "left").join(tops, "name", "left").join(zips, "zip5", "left")
    fuzzy = (F.length("name") >= 4) & (F.col("top.ratio") >= threshold) & (F.col("top.ratio") - F.col("top.second") >= lead)
    decision = (
        F.when(F.col("exact").isNotNull(), F.struct(F.col("exact").alias("canonical"), F.lit("exact").alias("method"), F.lit(100.0).alias("score")))
        .when(F.col("prefixes") == 1, F.struct(F.col("by_prefix").alias("canonical"), F.lit("prefix").alias("method"), F.lit(80.0).alias("score")))
        .when(fuzzy, F.struct(F.col("top.canonical").alias("canonical"), F.lit("fuzzy").alias("method"), F.col("top.ratio").alias("score")))
        .when(F.col("by_zip").isNotNull(), F.struct(F.col("by_zip").alias("canonical"), F.lit("zip").alias("method"), F.lit(70.0).alias("score")))
        .otherwise(F.struct(F.lit(None).cast("string").alias("canonical"), F.lit("unresolved").alias("method"), F.lit(0.0).alias("score")))
    )
    return joined.withColumn("d", decision).select("raw", "d.canonical", "d.method", "d.score", "rows")


def resolve_column(df: DataFrame, gazetteer: DataFrame, column: str = "city", **how) -> tuple[DataFrame, DataFrame]:
    """(df with ``jurisdiction``, crosswalk by falling rows): every distinct value resolved once and met by its rows.

    The crosswalk grows with the distinct values, so whether it is broadcast is left to the planner.
    """
    crosswalk = cut(resolve_places(df.select(F.col(column).alias("raw")), gazetteer, **how))
    found = crosswalk.select(F.col("raw").alias("_raw"), F.col("canonical").alias("jurisdiction"))
    out = df.join(found, F.coalesce(F.col(column), F.lit("")) == F.col("_raw"), "left").drop("_raw")
    return out, crosswalk.orderBy(F.col("rows").desc(), "raw")
