"""Tables that cut lineage, written to the folder that all executors share."""
import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder, on a local master only: elsewhere executors would not see it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        at = f"file://{tempfile.mkdtemp(prefix='docloom-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def stored(df: DataFrame) -> DataFrame:
    """df, written as Parquet and read again; the files go when the driver ends."""
    spark = df.sparkSession
    path = f"{folder(spark)}/docloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int | str = 256) -> str:
    """Texts go to Python workers in batches of at most so many rows, so that long ones do not fill an executor; returns what was set before."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    return before


def _drop(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended before
        pass
