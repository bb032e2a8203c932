"""Ranks and row numbers over all rows that no single task has to see."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.frozen import frozen

#: Ranges of values in each doubling of a value.
RANGES = 1024


def value_range(value: Column) -> Column:
    """The range that a whole number lies in: ``RANGES`` for each doubling, so at most some 130,000, rising with the value.

    A law of the value alone needs no sample of the data, and equal values share a range. Null is below all.
    """
    size = F.floor(F.log2(F.abs(value.cast("double")) + 1) * RANGES)
    return F.coalesce(F.when(value < 0, -size).otherwise(size), F.lit(-(1 << 40)))


def ranks(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with the descending rank (1 is the largest; ties share the least, nulls come last) of each column, named by ``columns``.

    The rank of a value is one more than the number of rows with a larger value.
    Rows are counted by value first, so a value that many rows share is one row
    from then on. Values are ordered within ranges, and ranges by how many
    rows they have: the only windows over a whole column are over its ranges,
    whose number has a bound. ``df`` is frozen first, as its values are counted and then looked up.
    """
    df = frozen(df.drop(*columns.values()))
    stacked = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("long").alias("v")) for c in columns))).alias("s")).select("s.*")
    counted = stacked.groupBy("c", "v").agg(F.count(F.lit(1)).alias("rows")).withColumn("range", value_range(F.col("v")))
    larger = Window.partitionBy("c").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = counted.groupBy("c", "range").agg(F.sum("rows").alias("in_range")).withColumn("before", F.coalesce(F.sum("in_range").over(larger), F.lit(0)))
    within = Window.partitionBy("c", "range").orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("own", F.coalesce(F.sum("rows").over(within), F.lit(0))).join(ranges.select("c", "range", "before"), ["c", "range"])
    ranked = frozen(placed.select("c", "v", (F.col("before") + F.col("own") + 1).alias("rank")))

    def add(out: DataFrame, column: str) -> DataFrame:
        own = ranked.where(F.col("c") == column).select(F.col("v").alias("_v"), F.col("rank").alias(columns[column]))
        return out.join(own, F.col(column).cast("long").eqNullSafe(F.col("_v")), "left").drop("_v")

    return reduce(add, columns, df)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the place of each row, from 0, in the total order by ``order``.

    Rows are sorted by a range shuffle and frozen with their place in their own
    partition; what stands before a partition is the sum of the others' counts,
    one number for each. Rows that are equal in ``order`` come in any order.
    """
    at = "_at"
    placed = frozen(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()))
    # A position has its partition in the upper bits, its place there in the lower 33.
    counts = sorted((r["part"], r["rows"]) for r in placed.groupBy(F.shiftright(at, 33).alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect())
    before, starts = 0, []
    for part, rows in counts:
        starts.append((part, before))
        before += rows
    start = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    joined = placed.join(F.broadcast(start), F.shiftright(at, 33) == F.col("_part"))
    return joined.select(*df.columns, (F.col("_start") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).alias(name))
