"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local session gets a folder below its warehouse; a cluster raises, as its
    executors would not see what others write."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", base) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return base.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/aqgrid-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder once and read them back."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the folders of ``written`` frames that nothing will read again."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("aqgrid-"):
                remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
