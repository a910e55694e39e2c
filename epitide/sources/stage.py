"""Intermediate results on shared storage: computed once, read as often as needed, safe if executors go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder all executors can reach: below the checkpoint folder the cluster names.

    Only a local session, where driver and executors are one machine, may go without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"{name}-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


def settle(df: DataFrame, name: str = "stage", tidy: bool = False) -> DataFrame:
    """Write a reduced intermediate table and go on from its files.

    For inputs an operator reads several times (a daily panel, counts, distinct names): without this
    each reading would repeat the scan and the shuffles that produced them. With `tidy` the shuffle files of the write go
    when it is done, and not only when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    before = spark.conf.get(_TIDY, None)
    if tidy:
        spark.conf.set(_TIDY, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if tidy:
            spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Remove the files of settled tables that nothing will read again."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)
