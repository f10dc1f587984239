"""Tables between the rounds of an iterative plan."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); an own one only where a local session names none.

    On a cluster without that setting this raises: a folder of one machine would lose what others wrote.
    """
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    where = where or spark.sparkContext.getCheckpointDir()
    if where is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="lodestream-")
        atexit.register(shutil.rmtree, where, True)
        spark.sparkContext.setCheckpointDir(where)
    return where


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, and a lost executor costs its tasks alone."""
    path = f"{shared_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Delete this engine's staged tables. For the end of a job: results that read them must be written before."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tables")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
