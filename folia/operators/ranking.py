"""Position of a row inside its group, computed without one task per group.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sorts each group in a
single task; a key holding a third of all rows would do so on one executor.
Here the group is split into ordered buckets (for example a day): the
bucket sizes are aggregated (map-side combined), a prefix sum over the small
per-bucket table gives each bucket's offset, and rows are numbered inside
(key, bucket) only.  Position = offset + number within the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position_in_group(df: DataFrame, keys: list[str], bucket: Column, bucket_order: Column,
                      order: list[Column], name: str = "pos") -> DataFrame:
    """Adds ``name`` = 1-based position of each row within ``keys``.

    ``bucket`` must be monotone in ``order`` (every row of an earlier bucket
    sorts before every row of a later one); ``bucket_order`` sorts buckets
    in that same direction.
    """
    tagged = df.withColumn("_bucket", bucket).withColumn("_bucket_ord", bucket_order)
    sizes = tagged.groupBy(*keys, "_bucket", "_bucket_ord").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket_ord").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = tagged.withColumn("_r", F.row_number().over(inside))
    return (
        numbered.join(offsets, [*keys, "_bucket"])
        .withColumn(name, F.col("_off") + F.col("_r"))
        .drop("_bucket", "_bucket_ord", "_off", "_r")
    )
