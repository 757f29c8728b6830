"""New community dumps as a stream.

The imports are bounded: a stream reads the dump files that arrived since its last run
and stops. Each batch replaces the tables, as an import does, so the last dump counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.sources import communities, tables


def follow_communities(spark: SparkSession, folder: str, root: str, checkpoint: str, parent_slug: str = "eu") -> StreamingQuery:
    """Read the dump files that are new in a folder, then stop."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        newest = batch.select(F.max(F.struct("modificationTime", "path")).alias("last")).first()["last"]
        if newest is None:
            return
        names = ("community_awards", "community_award_participants", "community_orgs")
        for name, df in zip(names, communities.read_communities(spark, newest["path"], parent_slug), strict=True):
            tables.save(df, root, name)

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.jsonl").load(folder).select("path", "modificationTime")
    return files.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
