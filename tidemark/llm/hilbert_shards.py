"""Shards as runs of a Hilbert curve through several metadata dimensions.

Each dimension is quantised into 2**bits cells whose edges come from one
mergeable quantile summary of the whole table, rows are ordered by the index
of their cell on the Hilbert curve, and the order is cut into runs of equal
length. Neighbours on the curve are neighbours in every dimension, so a run
covers a small box and a filter on any of the dimensions skips most shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, discard

#: Bits of a dimension.
BITS = 5


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the curve of the given cells (n rows, one column a dimension).

    The transposition algorithm of J. Skilling (2004): undo the excess rotations from the
    highest bit down, Gray-encode, and interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        carry = np.where((x[dims - 1] & q) != 0, carry ^ (q - 1), carry)
        q >>= 1
    x ^= carry
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


#: Rows of a range partition of the order, at most about.
PART_ROWS = 1_000_000


def default_dimensions() -> dict[str, Column]:
    return {"lang": F.col("lang").cast("string"), "source": F.col("source").cast("string"), "length": F.coalesce(F.octet_length("text"), F.lit(0)).cast("double")}


def text_edges(df: DataFrame, column: str, cells: int, n_parts: int) -> list[str]:
    """Strings that part the rows into ``cells`` cells of about equal counts, each string taken as a whole.

    Rows are counted by value first, so a frequent value is one row; values are
    ordered by ranges, and only the edges come to the driver. Null values do
    not count.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    ordered = cut(values.repartitionByRange(n_parts, "value").withColumn("part", F.spark_partition_id()), "hilbert-values")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range partition.
    offsets = ordered.groupBy("part").agg(F.sum("rows").alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"), F.sum("rows").over(Window.partitionBy()).alias("total"))
    upto = F.col("offset") + F.sum("rows").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    counted = ordered.join(F.broadcast(offsets), "part").select("value", "total", upto.alias("upto"))
    edges = counted.agg(*(F.min(F.when(F.col("upto") * cells >= F.col("total") * i, F.col("value"))).alias(f"e{i}") for i in range(1, cells))).first()
    discard(ordered)
    return sorted({e for e in edges if e is not None}, key=lambda e: e.encode())


def _edges_below(value: Column, edges: list[str]) -> Column:
    """How many of the edges are less than a string; none for null."""
    known = F.array(*(F.lit(e) for e in edges)).cast("array<string>")
    return F.size(F.filter(known, lambda e: e < value))


def shards(docs: DataFrame, n_shards: int = 40, dimensions: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """Put every row into one of ``n_shards`` shards of counts at most one apart.

    Returns doc_id, size (UTF-8 bytes of the text, null: none, plus 16),
    text_crc32 (null: 0), law ``rows``, shard, slot (position in the shard),
    grown_shard (null under this law) and hilbert (position on the curve).
    Ties on the curve are ordered by text checksum, then doc_id, then the rest
    of the row, so equal texts of equal metadata stand together; repeated rows
    each get a slot. Null metadata are in the first cell. Dimensions are strings,
    quantised as whole strings in the order of their UTF-8 bytes, or numbers. An
    empty table gives no rows.
    """
    dimensions = dimensions or default_dimensions()
    names = [f"_d{i}" for i in range(len(dimensions))]
    text = F.col("text")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        # Parts rows that are equal in all else, so that ranges can split them; it is fixed once written.
        F.monotonically_increasing_id().alias("tie"),
        *(d.alias(n) for n, d in zip(names, dimensions.values())),
    )
    narrow = cut(narrow, "hilbert-rows")

    texts = [n for n in names if narrow.schema[n].dataType == T.StringType()]
    numbers = [n for n in names if n not in texts]
    n_parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-narrow.count() // PART_ROWS))
    # Bounded: 2**bits - 1 edges for each dimension.
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = narrow.agg(F.lit(0), *(F.percentile_approx(n, steps, 10_000).alias(n) for n in numbers)).first()
    bounds = {n: np.unique(np.asarray(found[n] or [], dtype=float)) for n in numbers}
    cells = []
    for n in names:
        if n in texts:
            cells.append(_edges_below(F.col(n), text_edges(narrow, n, 1 << bits, n_parts)).alias(n))
        else:
            cells.append(F.col(n))

    @F.pandas_udf("long")
    def index(frame: pd.DataFrame) -> pd.Series:
        own = [np.searchsorted(bounds[n], frame[n], side="left") if n in bounds else frame[n].to_numpy() for n in names]
        return pd.Series(hilbert_index(np.stack(own, axis=1), bits))

    order = ["hilbert", "text_crc32", "doc_id", "size", "tie"]
    placed = narrow.select("doc_id", "size", "text_crc32", "tie", index(F.struct(*cells)).alias("hilbert"))
    # Position within the partition; the partition number stands in the upper bits.
    ordered = cut(placed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "hilbert-order")
    part, low = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range partition.
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = ordered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", F.col("offset") + low)
    shard = F.expr(f"cast(((rank + 1) * {n_shards} - 1) div total as int)")
    first = F.expr("(shard * total) div " + str(n_shards))
    return (
        ranked.withColumn("shard", shard)
        .withColumn("slot", (F.col("rank") - first).cast("long"))
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 40) -> None:
    """Write the documents themselves, one folder a shard, sorted along the curve.

    doc_id must be unique here, as rows meet their places by it.
    """
    places = shards(docs, n_shards).select("doc_id", "shard", "slot")
    docs.join(places, "doc_id").repartition(n_shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
