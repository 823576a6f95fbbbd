"""Tables that outlive an executor, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOR_TESTS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Only a single-process session (``local[...]``, as in tests) may do without the setting; anywhere else a
    folder of one machine would lose rows, so this raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        master = context.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = _FOR_TESTS.setdefault(context.applicationId, "")
        if not named:
            named = _FOR_TESTS[context.applicationId] = tempfile.mkdtemp(prefix="tallyloom-llm-")
    return f"{named.rstrip('/')}/llm-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Rows and bytes per Arrow batch for the operators whose tasks run Python: texts are long, and a batch is held whole in a worker.

    The settings stay, as plans read them when the caller runs the result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def stored(df: DataFrame, path: str, codec: str = "zstd") -> DataFrame:
    """Write a table and hand it back; a lost executor rereads it and the lineage ends there."""
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def located(docs: DataFrame, folder: str) -> DataFrame:
    """``docs`` as one struct column ``row`` with its content locator (``file``, ``at``: row number in the file).

    A frame that is not a plain file scan has no locators; it is written to the shared folder first.
    """
    def pick(df):
        return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                         F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return pick(docs)
    except AnalysisException:
        return pick(stored(docs, f"{folder}/rows"))

