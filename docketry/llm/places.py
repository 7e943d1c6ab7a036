"""Free-entered place names mapped to a canonical list.

Every distinct entry is normalised once and looked up among the reference spellings (canonical names, aliases and
earlier decisions). What has no exact entry is compared with them by weighted character n-grams, candidates coming from
an inverted index; the canonical name of the highest cosine is taken when that is high enough and leads the next
canonical name by a margin. The rest is reported unmatched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.lineage import cut
from docketry.llm.ngrams import reference_weights, similar

NONE = "(none)"
#: cosine a match must have, and its lead over the next canonical name
ACCEPT, MARGIN = 0.38, 0.045
#: letters, pairs and triples of letters: letters survive where neighbours are exchanged
SIZES = (1, 2, 3)

# Debris of web forms found beside names.
DEBRIS = ["N/A", "&NBSP;", "%20", "<BR", "[OBJECT", "SELECT ONE", "DROPDOWN", "UNDEFINED", "NULL", "/TR"]
# Words for the state and country.
REGION_WORDS = ["UNITED STATES", "NORTH KESTRIA", "N.K.", "NK", "USA"]
# What may stand about a place name without changing it.
FRAMES_BEFORE = ["THE CITY OF", "CITY OF", "TOWN OF", "TOWNSHIP OF", "TWP OF", "VILLAGE OF", "C/O", "NEAR"]
FRAMES_AFTER = ["CITY", "TOWN", "TWP"]
# Usual abbreviations of words of place names.
SHORT_WORDS = {
    "N": "NORTH", "S": "SOUTH", "E": "EAST", "W": "WEST", "FT": "FORT", "MT": "MOUNT", "MTN": "MOUNTAIN", "ST": "SAINT",
    "JCT": "JUNCTION", "JCTN": "JUNCTION", "XING": "CROSSING", "HTS": "HEIGHTS", "HGTS": "HEIGHTS", "SPGS": "SPRINGS", "SPRGS": "SPRINGS",
    "SPG": "SPRINGS", "MLS": "MILLS", "HLLW": "HOLLOW", "LTL": "LITTLE", "LNDG": "LANDING", "LDG": "LANDING", "FRY": "FERRY", "FY": "FERRY",
}


def _words(names: list[str]) -> str:
    escaped = ["".join("\\" + c if c in ".[]/%&;<" else c for c in n) for n in names]
    return "(?:" + "|".join(escaped) + ")"


def zip_in(text: Column) -> Column:
    """The five-digit zip of an entry, else null."""
    found = F.regexp_extract(F.upper(text), r"(?<![0-9])([0-9]{5})(?:-?[0-9]{4})?(?![0-9])", 1)
    return F.when(found != "", found)


def normal_name(text: Column) -> Column:
    """Upper-case letters of the name alone: debris, digits, region words and frames removed, abbreviations written out.

    A comma with one name part behind it ("ARDLEY, NORTH") turns round. Null gives null.
    """
    name = F.upper(F.regexp_replace(text, r"\s+", " "))
    name = F.regexp_replace(name, _words(DEBRIS), " ")
    name = F.regexp_replace(name, r"(?<![A-Z])" + _words(REGION_WORDS) + r"(?![A-Z])", " ")
    name = F.regexp_replace(name, r"[0-9]+", " ")
    name = F.regexp_replace(name, r"^[\s,*-]+|[\s,*-]+$", "")
    name = F.regexp_replace(name, r"^" + _words(FRAMES_BEFORE) + r"\s+", "")
    name = F.regexp_replace(name, r"^([A-Z]+),\s*([A-Z.]+)$", "$2 $1")
    name = F.trim(F.regexp_replace(name, r"[^A-Z]+", " "))
    # letters set apart ("D U N M ERE") are one word
    name = F.when(name.rlike(r"^[A-Z] [A-Z] "), F.regexp_replace(name, " ", "")).otherwise(name)
    short = F.create_map(*[F.lit(x) for pair in SHORT_WORDS.items() for x in pair])
    name = F.array_join(F.transform(F.split(name, " "), lambda w: F.coalesce(short[w], w)), " ")
    return F.regexp_replace(name, r"(?<=[A-Z]) " + _words(FRAMES_AFTER) + "$", "")


def squashed(name: Column) -> Column:
    return F.regexp_replace(name, " ", "")


def reference_forms(gazetteer: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """(form, canonical, listed): squashed spellings of each canonical name; ``(none)`` for entries decided to be no place.

    A spelling that two canonical names share stands for none of them. Decisions count where they agree with the list.
    """
    listed = gazetteer.select("canonical", F.explode(F.array("canonical", "alias")).alias("raw")).where(F.col("raw").isNotNull()).withColumn("rank", F.lit(0))
    if crosswalk is not None:
        known = gazetteer.select("canonical").distinct()
        told = crosswalk.where(F.col("raw").isNotNull() & F.col("canonical").isNotNull()).select("canonical", "raw").join(known, "canonical", "left_semi")
        no_place = crosswalk.where(F.col("raw").isNotNull() & F.col("canonical").isNull()).select(F.lit(NONE).alias("canonical"), "raw")
        listed = listed.unionByName(told.unionByName(no_place).withColumn("rank", F.lit(1)))
    forms = listed.select("canonical", "rank", squashed(normal_name(F.col("raw"))).alias("form")).where(F.length("form") > 0).distinct()
    best = Window.partitionBy("form")
    first = forms.withColumn("least", F.min("rank").over(best)).where(F.col("rank") == F.col("least"))
    return first.groupBy("form").agg(F.count_distinct("canonical").alias("n"), F.min("canonical").alias("canonical"), F.min("rank").alias("rank")).select("form", F.when(F.col("n") == 1, F.col("canonical")).otherwise(F.lit(NONE)).alias("canonical"), (F.col("rank") == 0).alias("listed"))


def unique_zips(gazetteer: DataFrame) -> DataFrame:
    """(zip, canonical) of the zips that only one place has."""
    held = gazetteer.select("canonical", F.explode("zips").alias("zip")).distinct()
    return held.groupBy("zip").agg(F.count("*").alias("n"), F.min("canonical").alias("canonical")).where(F.col("n") == 1).select("zip", "canonical")


def resolve_names(entries: DataFrame, gazetteer: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """Distinct ``raw`` entries -> (raw, canonical, method, score); ``(none)`` where no place, or no single one, is named.

    Null entries are left out. A zip counts only where no name stands beside it.
    """
    named = cut(entries.select("raw").where(F.col("raw").isNotNull()).distinct().withColumns({"name": normal_name(F.col("raw")), "zip": zip_in(F.col("raw"))}).withColumn("text", squashed(F.col("name"))))
    forms = cut(reference_forms(gazetteer, crosswalk))
    texts = named.where(F.length("text") > 0).select("text").distinct()
    exact = texts.join(forms.withColumnRenamed("form", "text"), "text").select("text", "canonical", F.lit("exact").alias("method"), F.lit(1.0).alias("score"))
    open_texts = texts.join(exact, "text", "left_anti")
    usable = forms.where((F.col("canonical") != NONE) | (F.length("form") >= 4))
    values, references = open_texts.where(F.length("text") >= 3), usable.select(F.col("form").alias("text"))
    # a cosine below ACCEPT - MARGIN changes neither acceptance nor lead
    pairs = similar(values, references, ACCEPT - MARGIN, reference_weights(values, references, SIZES), SIZES)
    best = pairs.join(usable.select(F.col("form").alias("reference"), "canonical"), "reference").groupBy("text", "canonical").agg(F.max("cosine").alias("score"))
    lead = Window.partitionBy("text").orderBy(F.col("score").desc(), "canonical")
    top = best.withColumns({"n": F.row_number().over(lead), "second": F.lead("score").over(lead)}).where(F.col("n") == 1)
    fuzzy = top.where((F.col("score") >= ACCEPT) & (F.col("score") - F.coalesce("second", F.lit(0.0)) >= MARGIN)).select("text", "canonical", F.lit("fuzzy").alias("method"), "score")
    decided = named.join(cut(exact.unionByName(fuzzy)), "text", "left")
    by_zip = decided.join(unique_zips(gazetteer).withColumnRenamed("canonical", "z"), "zip", "left")
    bare = (F.length("text") == 0) & F.col("z").isNotNull()
    return by_zip.select(
        "raw",
        F.coalesce(F.when(bare, F.col("z")), F.col("canonical"), F.lit(NONE)).alias("canonical"),
        F.when(bare, "zip").otherwise(F.coalesce("method", F.lit("unmatched"))).alias("method"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
