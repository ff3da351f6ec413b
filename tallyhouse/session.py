"""Session start-up and the shared folder for tables a job must keep."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "tallyhouse", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on and the time zone pinned.

    Sizes (shuffle partitions, memory) belong to the cluster and are left to
    its defaults unless given in ``settings``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one under the warehouse.

    Both are reached by all executors of a cluster; a temporary folder is not.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stored").rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Store ``df`` once in the shared folder and read it back, in another ``session`` where one is given.

    This cuts the lineage, so values that depend on how rows were laid out
    (range partitions, partition ids) stay the same in every later use and
    after the loss of an executor.
    """
    spark = session or df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
