"""New link sheets as they land in a folder, taken into the stored graph.

This is the daily pick-up as a query that processes whatever is new and stops. Each micro-batch extends
the graph once; a batch that is repeated after a failure adds nothing twice, because only unseen keys
are appended.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from casewright.schemas import LINK_SHEET
from casewright.sources import graph_store

LINK_SCHEMA = T.StructType([
    T.StructField(c, T.LongType() if c in ("sheet_id", "row_no") else T.StringType())
    for c in LINK_SHEET
])


def take_in_new_sheets(spark: SparkSession, landing: str, graph_root: str, checkpoint: str,
                       files_per_batch: int = 1000, first_row: int | None = 1) -> StreamingQuery:
    """Start the pick-up; it ends when every landed file is in the graph.

    A sheet may land in several files, in any order: rows wait in the store for the first row of their sheet. Of rows of one
    sheet that repeat a pair of accounts, the one that is taken first counts.
    """
    rows = (
        spark.readStream.schema(LINK_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    return (
        rows.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, _batch: graph_store.add_landed(spark, graph_root, df, first_row))
        .start()
    )
