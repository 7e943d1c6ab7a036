"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are put in a seeded random order; a document's virtual finish time is the number of tokens its
source has delivered with it, over the source's target share. Sorting by finish time interleaves the sources in their
shares, whatever their sizes; the mix is cut at a total budget. A source that runs out starts over, up to its cap of
repeats. Running sums are taken in two levels (bins, then rows within a bin), so no source or sort runs in one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.lineage import cut

#: rows of one bin of a running sum, about
BIN_ROWS = 20_000
#: bins of the finish-time axis below the budget
TIME_BINS = 4096


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_encoding(path: str):
    """Byte-level BPE read from a rank file; special strings are ordinary text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("docketry", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(documents: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, n_tokens) of every document; null and empty texts have 0 tokens. ``path`` names the rank file."""
    file = path or tokenizer_path()
    schema = pa.schema([(key, pa.int64()), ("source", pa.string()), ("n_tokens", pa.int64())])

    def count(batches):
        encoding = load_encoding(file)
        for batch in batches:
            sizes = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], schema=schema)

    return documents.select(F.col(key).cast("long").alias(key), F.col(source).cast("string").alias("source"), text).mapInArrow(count, f"{key} bigint, source string, n_tokens bigint")


def running_tokens(counted: DataFrame, key: str, bins: int, seed: int) -> DataFrame:
    """Add ``cum``: tokens of the source up to and with the document, in the seeded order; and ``total`` of the source."""
    ordered = counted.withColumn("_h", F.xxhash64(F.lit(seed), key)).withColumn("_bin", F.pmod(F.shiftright("_h", 32), F.lit(bins)))
    sums = ordered.groupBy("source", "_bin").agg(F.sum("n_tokens").alias("n"))
    up_to = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumns({"_start": F.coalesce(F.sum("n").over(up_to), F.lit(0)), "total": F.sum("n").over(Window.partitionBy("source"))}).drop("n")
    within = Window.partitionBy("source", "_bin").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, 0)
    return ordered.withColumn("_c", F.sum("n_tokens").over(within)).join(starts, ["source", "_bin"]).select(key, "source", "n_tokens", (F.col("_start") + F.col("_c")).alias("cum"), "total")


def feasible_budget(totals: list[tuple[float, float, int]]) -> int:
    """Most tokens of which every source with documents can deliver its share; from (tokens, share, cap) per source."""
    share = sum(s for t, s, _ in totals if t > 0)
    return int(min((t * cap / (s / share) for t, s, cap in totals if t > 0 and s > 0), default=0))


def mix(documents: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 42, path: str | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, copy, n_tokens, finish): the documents of the mix, each copy a row, in order of ``finish``.

    ``targets`` has ``source, target_share, max_repeats`` (a source's documents are used at most so many times). Without
    ``budget`` it is the most that lets every source with documents keep its share. A source without documents leaves
    its share to the others in proportion; documents of sources without target, and those without tokens, stay out.
    Ties of finish time go by source, copy and key, so the result does not depend on partitions.
    """
    counted = cut(count_tokens(documents, path, key, text, source).where(F.col("n_tokens") > 0))
    wanted = targets.where((F.col("target_share") > 0) & (F.col("max_repeats") > 0) & F.col("source").isNotNull()).groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("cap"))
    held = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).join(wanted, "source").collect()  # one row per target source
    if budget is None:
        budget = feasible_budget([(float(r["tokens"]), r["share"], r["cap"]) for r in held])
    bins = max(1, max((r["n"] for r in held), default=0) // BIN_ROWS + 1)
    queued = running_tokens(counted.join(F.broadcast(wanted), "source", "left_semi"), key, bins, seed).join(F.broadcast(wanted), "source")  # wanted: the target list
    # the k-th copy of a source ends behind k - 1 whole passes over it, so copies that begin past the budget are never made
    reach = F.least(F.col("cap").cast("double"), F.floor(F.lit(float(budget)) / F.col("total")) + 2).cast("int")
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(reach, F.lit(1)))))
    finish = (F.col("total") * (F.col("copy") - 1) + F.col("cum")) / F.col("share")
    step = max(1.0, budget / TIME_BINS)
    timed = copies.select(key, "source", "copy", "n_tokens", finish.alias("finish")).withColumn("_bin", F.floor(F.col("finish") / step))
    sums = timed.groupBy("_bin").agg(F.sum("n_tokens").alias("n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = timed.join(before, "_bin").where(F.col("_before") < budget)
    order = Window.partitionBy("_bin").orderBy("finish", "source", "copy", key).rowsBetween(Window.unboundedPreceding, 0)
    chosen = inside.withColumn("_cum", F.col("_before") + F.sum("n_tokens").over(order)).where(F.col("_cum") <= budget)
    return chosen.select(key, "source", "copy", "n_tokens", "finish").repartitionByRange("finish", "source", "copy", key).sortWithinPartitions("finish", "source", "copy", key)


def actual_shares(mixed: DataFrame, targets: DataFrame, key: str = "doc_id") -> DataFrame:
    """(source, target_share, actual_share, tokens, n_rows, max_copies) of every target source."""
    held = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows"), F.max("copy").alias("max_copies"))
    rows = targets.select("source", "target_share").join(held, "source", "left").fillna(0, ["tokens", "n_rows", "max_copies"])
    return rows.withColumn("actual_share", F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy(F.lit(0))), F.lit(0)), F.lit(0.0)))
