"""Weighted character n-grams: vectors, a prefix-filtered inverted index and the cosine of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import counted_letters
from docketry.lineage import cut

SIZES = (2, 3)


def grams_of(text: Column, sizes=SIZES) -> Column:
    """Distinct n-grams of the text between end marks; an empty text has those of the marks alone.

    Grams of size 1 are the capital letters, each with the count up to which the text holds it.
    """
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    return F.array_distinct(F.flatten(F.array(*[_windows(padded, n) if n > 1 else counted_letters(text) for n in sizes])))


def _windows(padded: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.substring(padded, i, F.lit(n)))


def vectors(texts: DataFrame, weights: DataFrame, threshold: float, sizes=SIZES) -> DataFrame:
    """(text, grams, w, norm, prefix) of distinct ``text``: weights in falling order and the grams a match must share.

    Whatever shares none of the prefix can reach a cosine of at most the norm of the rest, which is below the threshold.
    """
    rows = texts.select("text", F.explode(grams_of(F.col("text"), sizes)).alias("gram")).join(weights, "gram")
    held = rows.groupBy("text").agg(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("neg"), "gram"))).alias("x"))
    held = held.select("text", F.col("x.gram").alias("grams"), F.transform("x.neg", lambda v: -v).alias("w"))
    square = F.aggregate("w", F.lit(0.0), lambda s, v: s + v * v)
    held = held.withColumn("norm", F.sqrt(square))
    rest = lambda i: F.aggregate(F.slice("w", i, F.size("w")), F.lit(0.0), lambda s, v: s + v * v)
    keep = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: rest(i) >= (threshold * threshold) * F.col("norm") * F.col("norm") * (1 - 1e-9))
    return held.withColumn("prefix", F.slice("grams", 1, F.size(keep)))


def gram_weights(*texts: DataFrame) -> DataFrame:
    """(gram, weight): log of the number of texts over those that hold the gram, over all texts given."""
    every = texts[0].select("text")
    for more in texts[1:]:
        every = every.unionByName(more.select("text"))
    every = every.distinct()
    total = every.agg(F.count("*").cast("double").alias("n"))
    counts = every.select(F.explode(grams_of(F.col("text"))).alias("gram")).groupBy("gram").count()
    return counts.crossJoin(F.broadcast(total)).select("gram", F.log(1 + F.col("n") / F.col("count")).alias("weight"))  # total is one row


#: share of the greatest weight that a gram of no reference has: it may be a misspelling
UNSEEN = 0.25


def reference_weights(values: DataFrame, references: DataFrame, sizes=SIZES) -> DataFrame:
    """(gram, weight) of the values' and references' grams: log of the references over those that hold the gram."""
    grams = lambda df: df.select("text").distinct().select(F.explode(grams_of(F.col("text"), sizes)).alias("gram"))
    total = references.select("text").distinct().agg(F.count("*").cast("double").alias("n"))
    counts = grams(references).groupBy("gram").agg(F.count("*").alias("c"))
    every = grams(values).distinct().join(counts, "gram", "full").crossJoin(F.broadcast(total))  # total is one row
    return every.select("gram", F.when(F.col("c").isNull(), UNSEEN * F.log(1 + F.col("n"))).otherwise(F.log(1 + F.col("n") / F.col("c"))).alias("weight"))


def similar(values: DataFrame, references: DataFrame, threshold: float, weights: DataFrame | None = None, sizes=SIZES) -> DataFrame:
    """(text, reference, cosine) of all pairs of distinct texts with a cosine of at least ``threshold``.

    Both tables have a column ``text`` without nulls; repeated texts count once. Without ``weights`` they are taken over
    both tables. Candidates share a gram of both prefixes; there is no cap on candidates.
    """
    left, right = values.select("text").distinct(), references.select("text").distinct()
    # vectors are read twice each; cutting them keeps the plan small and computes them once
    weights = gram_weights(left, right) if weights is None else weights
    held = cut(vectors(left.unionByName(right).distinct(), weights, threshold, sizes))
    keyed = lambda side, name: side.join(held.select("text", "prefix"), "text").select(F.col("text").alias(name), F.explode("prefix").alias("gram"))
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, or adaptive execution merges the narrow pairs into too few tasks
    met = keyed(left, "text").join(keyed(right, "reference"), "gram").select("text", "reference").distinct().repartition(tasks, "text")
    return pair_cosines(met, held).where(F.col("cosine") >= threshold)


#: texts that must hold a gram for half of its weight
DAMPING = 10.0


def damped_weights(texts: DataFrame) -> DataFrame:
    """(gram, weight) over (text, n), n being how often the text occurs.

    The weight is the log of all occurrences over those with the gram, damped where few have it: what is met a few times
    only is as likely a misspelling as a rare name.
    """
    total = texts.agg(F.sum("n").cast("double").alias("all"))
    counts = texts.select(F.explode(grams_of(F.col("text"))).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("c"))
    return counts.crossJoin(F.broadcast(total)).select("gram", (F.log(1 + F.col("all") / F.col("c")) * F.col("c") / (F.col("c") + DAMPING)).alias("weight"))  # total is one row


def pair_cosines(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """(text, reference, cosine) of the given distinct pairs, from the ``vectors`` of their texts."""
    full = pairs.join(held.select("text", F.map_from_arrays("grams", "w").alias("m"), "norm"), "text")
    full = full.join(held.select(F.col("text").alias("reference"), F.col("grams").alias("r_grams"), F.col("norm").alias("r_norm")), "reference")
    dot = F.aggregate("r_grams", F.lit(0.0), lambda s, g: s + F.coalesce(F.col("m")[g] * F.col("m")[g], F.lit(0.0)))
    return full.select("text", "reference", (dot / (F.col("norm") * F.col("r_norm"))).alias("cosine"))
