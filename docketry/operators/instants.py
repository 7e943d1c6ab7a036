"""Mixed timestamp formats and zones: one UTC instant per value.

Every source is a mixture of readings. A value contributes likelihood to each reading under which it is a valid date;
expectation-maximisation over the per-source counts gives the readings' shares, and their posteriors choose the reading
of each ambiguous value. Only the counts are aggregated (one row per source), so a source holding a third of the rows
costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import instants as parse
from docketry.lineage import cut

#: sources whose model rows may be broadcast (about 50 bytes each); more meet their values by a salted join
BROADCAST_SOURCES = 100_000
#: keys over which the rows of one source are spread when they meet its model by a join
SALTS = 32


def reading_shares(both: Column, month_only: Column, day_only: Column, prior_month: Column) -> Column:
    """Share of the month-first reading to which EM converges on counts of (both valid, only one valid) values.

    A round sets the share s to (month_only + both * s) / all; its fixpoint is month_only / (month_only + day_only),
    whatever the start. Without a decisive value every share is a fixpoint, so the prior stays.
    """
    decisive = month_only + day_only
    return F.when(decisive > 0, month_only / decisive).otherwise(prior_month)


def recognise(values: DataFrame, value: str = "value") -> DataFrame:
    """Add ``shape``, ``parts`` and the validity of both numeric readings. Null or unrecognised text has a null shape."""
    text = F.regexp_replace(F.trim(F.col(value)), r"\s+", " ")
    shaped = values.withColumn("_text", text).withColumn("_pieces", parse.pieces_of(F.col("_text")))
    parts = shaped.withColumns({"shape": F.get("_pieces", F.lit(0)), "parts": parse.parts_of(F.col("_pieces"))}).drop("_pieces")
    p = F.col("parts")
    numeric = F.col("shape") == "numeric"
    return parts.withColumns({
        "month_ok": F.coalesce(numeric & parse.is_date(p["y"], p["a"], p["b"]), F.lit(False)),
        "day_ok": F.coalesce(numeric & parse.is_date(p["y"], p["b"], p["a"]), F.lit(False)),
    })


def source_model(evidence: DataFrame, source: str = "source", prior: Column | float = 0.5) -> DataFrame:
    """One row per source: ``month_share``, the EM share of month-first readings among its numeric dates."""
    counts = evidence.groupBy(source).agg(
        F.count_if(F.col("month_ok") & F.col("day_ok") & (F.col("parts.a") != F.col("parts.b"))).alias("both"),
        F.count_if(F.col("month_ok") & ~F.col("day_ok")).alias("month_only"),
        F.count_if(F.col("day_ok") & ~F.col("month_ok")).alias("day_only"),
    )
    start = prior if isinstance(prior, Column) else F.lit(float(prior))
    d = [F.col(c).cast("double") for c in ("both", "month_only", "day_only")]
    return counts.select(source, reading_shares(*d, start).alias("month_share"), *("both", "month_only", "day_only"))


def _with_model(values: DataFrame, model: DataFrame, source: str) -> DataFrame:
    """Values with their source's share, without a row or shuffle too many for a source that holds a third of them."""
    shares = cut(model.select(source, "month_share"))
    if shares.count() <= BROADCAST_SOURCES:
        return values.join(F.broadcast(shares), source, "left")
    copies = shares.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return values.withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(SALTS)).cast("int")).join(copies, [source, "_salt"], "left").drop("_salt")


def resolve(values: DataFrame, model: DataFrame, source: str = "source", fixed_month_first: Column | None = None, tie: float = 1e-9) -> DataFrame:
    """Add ``epoch_s``, ``reading``, ``posterior`` and ``ambiguous`` to recognised values.

    A numeric date takes the source's likelier reading; an even source is month first but stays marked ``ambiguous``.
    ``fixed_month_first`` names rows whose source states its order. A date impossible under the chosen reading has no
    instant.
    """
    share = F.coalesce(F.col("month_share"), F.lit(0.5))
    month_first = share >= 0.5 - tie
    if fixed_month_first is not None:
        month_first = fixed_month_first | month_first
    joined = _with_model(values, model, source)
    p = F.col("parts")
    month = F.when(F.col("shape") == "numeric", F.when(month_first, p["a"]).otherwise(p["b"])).otherwise(p["m"])
    day = F.when(F.col("shape") == "numeric", F.when(month_first, p["b"]).otherwise(p["a"])).otherwise(p["d"])
    number = F.when(F.col("shape").isin("epoch_ms", "epoch_s"), F.col("_text")).cast("long")
    stated = F.lit(False) if fixed_month_first is None else fixed_month_first
    epoch = (
        F.when(F.col("shape") == "epoch_ms", F.floor(number / 1000))
        .when(F.col("shape") == "epoch_s", number)
        .when(F.col("shape").isNotNull(), parse.epoch_seconds(p["y"], month, day, p))
    )
    both = F.col("month_ok") & F.col("day_ok") & (p["a"] != p["b"])
    return joined.withColumns({
        "epoch_s": epoch.cast("long"),
        "reading": F.when(F.col("shape") == "numeric", F.when(month_first, "month_first").otherwise("day_first")).otherwise(F.col("shape")),
        "posterior": F.when(both & ~stated, F.greatest(share, 1 - share)).when(epoch.isNotNull(), F.lit(1.0)),
        "ambiguous": both & ~stated & (F.abs(share - 0.5) <= tie),
    })


def normalise_instants(values: DataFrame, fixed_month_first: Column | None = None, evidence: DataFrame | None = None) -> DataFrame:
    """(source, record_key, field, value) rows -> the same rows with ``epoch_s`` and how it was read.

    Every row comes back. Null, empty and unparseable values have a null ``epoch_s``; repeated rows give repeated
    results; an empty table gives an empty one. ``evidence`` may hold further dated values of the same sources that
    help to settle their order but are not themselves wanted.
    """
    seen = values.select("source", "value") if evidence is None else values.select("source", "value").unionByName(evidence.select("source", "value"))
    if fixed_month_first is not None:
        seen = seen.where(~F.coalesce(fixed_month_first, F.lit(False)))
    # only dates of numbers alone say anything about their order
    model = source_model(recognise(seen.where(F.col("value").rlike(parse.OPEN_ORDER))))
    return resolve(recognise(values), model, fixed_month_first=fixed_month_first).drop("_text", "parts", "month_ok", "day_ok", "month_share")
