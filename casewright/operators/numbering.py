"""Dense whole-number ids without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# A key's bucket is the first three hex digits of its md5: 4,096 buckets of about equal size.
BUCKET_DIGITS = 3


def number_rows(df: DataFrame, keys: list[str], name: str = "id",
                existing: DataFrame | None = None, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number rows 1, 2, ... by (bucket, keys), after the largest id of ``existing``.

    ``keys`` must identify the row. Rows are numbered within their bucket, of which there are 16 ** ``digits``; the
    bucket offsets are a running sum over one row per bucket. A store keeps to one value of ``digits``: four or five
    suit tables of 10^9 rows and more. ``df`` is read twice and should be a written table if it is costly.
    """
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    bucketed = df.withColumn("_bucket", F.left(F.md5(text), F.lit(digits)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(name), F.lit(0)).cast("long").alias("_size"))
        sizes = sizes.unionByName(start.select(F.lit("").alias("_bucket"), "_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))) \
        .select("_bucket", "_offset")
    within = Window.partitionBy("_bucket").orderBy(*keys)
    numbered = bucketed.withColumn("_no", F.row_number().over(within))
    return (
        numbered.join(offsets, "_bucket")
        .withColumn(name, (F.col("_offset") + F.col("_no")).cast("long"))
        .select(name, *df.columns)
    )
