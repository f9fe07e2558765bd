"""Files that arrive in a folder, built into a table as they come."""
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.store import build_incremental, content_id


def ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, compute: Callable[[DataFrame], DataFrame], pattern: str = "*.pdf") -> StreamingQuery:
    """Each micro-batch adds the papers that table lacks, so that a batch run again adds nothing; ends when nothing is left."""
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder)
    rows = stream.select("path", "content", content_id(stream["content"]).alias("paper_id"))
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda d, _: build_incremental(d.dropDuplicates(["paper_id"]), table, "paper_id", compute)).start()
