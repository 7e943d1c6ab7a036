"""Summary tables given as cell grids: header rows found by alias and carried forward, counts read strictly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Header spellings of the summary columns.
CELL_ALIASES = {
    "offense_code": ["code", "nibrs code", "nibrs", "ucr code"],
    "offense_desc": ["offense", "offense category", "description", "offense description"],
    "count": ["count", "month count", "current month", "this month", "total count"],
    "prior_year_count": ["prior year same month", "same month last year", "prior year"],
}


# Words before the agency's name and before the period, and the period's formats.
AGENCY_LABELS = ["Agency", "Reporting Agency", "Department"]
PERIOD_LABELS = ["Reporting Period", "Period", "Month"]
PERIOD_FORMATS = ["MMMM yyyy", "MMM yyyy", "M/yyyy"]


def document_head(text: Column) -> Column:
    """Struct of ``agency`` and ``period`` (yyyy-MM) named in a document's first page; a part that is not there is null.

    A label whose period has no known form raises an error: counts of an unknown month must not be added up.
    """
    agency = F.regexp_extract(text, rf"(?i)(?:{'|'.join(AGENCY_LABELS)})\s*:\s*([^\r\n]+)", 1)
    named = F.regexp_extract(text, rf"(?i)(?:{'|'.join(PERIOD_LABELS)})\s*:\s*([a-z]+\.?\s+\d{{4}}|\d{{1,2}}/\d{{4}})", 1)
    plain = F.regexp_replace(F.trim(F.replace(named, F.lit("."), F.lit(""))), r"\s+", " ")
    stamp = F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in PERIOD_FORMATS])
    period = F.when(named != "", F.coalesce(F.date_format(stamp, "yyyy-MM"), F.raise_error(F.concat(F.lit("unrecognised period: "), named)).cast("string")))
    return F.struct(F.nullif(F.trim(agency), F.lit("")).alias("agency"), period.alias("period"))


def normal_cell(cell: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.coalesce(cell, F.lit("")), r"\s+", " "))), r":$", "")


def strict_int(cell: Column) -> Column:
    """Blank and dashes are 0, note signs and thousands commas are dropped, anything else but digits is null."""
    t = F.trim(F.coalesce(cell, F.lit("")))
    digits = F.regexp_replace(F.regexp_replace(t, r"[*†‡]+$", ""), ",", "")
    return F.when(t.isin("", "-", "–", "—"), F.lit(0)).when(digits.rlike(r"\A\d+\z"), digits.cast("int"))


def read_cells(grid: DataFrame) -> DataFrame:
    """(path, page, table, row, cells) -> rows (path, page, table, row, kind, offense_code, offense_desc, count, prior).

    ``kind`` is ``data``, ``total`` (any cell begins with "total") or ``exception`` (no count). A header row names the
    count and at least one more column; its places hold for the rows and pages behind it. Rows before any header drop out.
    """
    cells = F.transform("cells", normal_cell)
    place = lambda names: F.coalesce(F.array_max(F.transform(F.sequence(F.lit(1), F.size(cells)), lambda i: F.when(F.element_at(cells, i).isin(names), i))), F.lit(0))
    at = grid.withColumns({f"_{k}": place(v) for k, v in CELL_ALIASES.items()})
    hits = sum(((F.col(f"_{k}") > 0).cast("int") for k in CELL_ALIASES), F.lit(0))
    is_header = (F.col("_count") > 0) & (hits >= 2)
    order = Window.partitionBy("path").orderBy("page", "table", "row").rowsBetween(Window.unboundedPreceding, 0)
    carried = at.withColumn("_map", F.last(F.when(is_header, F.struct(*[F.col(f"_{k}").alias(k) for k in CELL_ALIASES])), ignorenulls=True).over(order)).where(~is_header & F.col("_map").isNotNull())
    pick = lambda k: F.when(F.col(f"_map.{k}") > 0, F.get("cells", F.col(f"_map.{k}") - 1))
    total = F.exists("cells", lambda c: normal_cell(c).startswith("total"))
    count = strict_int(pick("count"))
    kind = F.when(total, "total").when(count.isNull(), "exception").otherwise("data")
    return carried.select("path", "page", "table", "row", kind.alias("kind"), F.nullif(F.trim(pick("offense_code")), F.lit("")).alias("offense_code"), F.trim(pick("offense_desc")).alias("offense_desc"), count.alias("count"), strict_int(pick("prior_year_count")).alias("prior_year_count"))


def reconcile(read: DataFrame, jump: float = 10.0) -> DataFrame:
    """(path, warning) where a file's sum is not its printed total, no total is printed, or a count jumps over last year's."""
    data = F.col("kind") == "data"
    sums = read.groupBy("path").agg(F.sum(F.when(data, F.col("count"))).alias("s"), F.max(F.when(F.col("kind") == "total", F.col("count"))).alias("t"), F.count_if(data).alias("n"))
    totals = sums.where((F.col("n") > 0) & (F.col("t").isNull() | (F.col("t") != F.col("s")))).select("path", F.when(F.col("t").isNull(), "no printed total").otherwise("sum differs from printed total").alias("warning"))
    jumps = read.where(data & (F.col("count") >= 20) & (F.col("count") / F.greatest(F.coalesce("prior_year_count", F.lit(0)), F.lit(1)) >= jump)).select("path", F.concat(F.lit("jump: "), F.coalesce("offense_code", "offense_desc")).alias("warning"))
    return totals.unionByName(jumps)
