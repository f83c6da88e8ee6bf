"""Sinks: partitioned Parquet, staged partition publish, bucketed tables, JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.runtime import delete_path, scratch_path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "append",
                      cluster: bool = True) -> None:
    """Parquet partitioned by ``by``, snappy.

    ``rebalance`` clusters rows by the partition columns so each directory
    gets few files, while AQE may still split a large partition over several
    tasks (a plain ``repartition(cols)`` would put a whole day-region in one
    task).  Overwrite is dynamic: only partitions present in ``df`` are
    replaced.
    """
    out = df.hint("rebalance", *by) if cluster and by else df
    w = out.write.mode(mode).option("compression", "snappy")
    if by:
        w = w.partitionBy(*by)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def replace_days(spark: SparkSession, df: DataFrame, path: str, by: Sequence[str], days: Sequence) -> None:
    """Write ``df`` partitioned by ``by`` (a date first) and drop what the
    processed ``days`` hold besides: a corrected run leaves no stale partition."""
    write_partitioned(df, path, by, mode="overwrite")
    drop_stale(spark, df, path, by, days)


def drop_stale(spark: SparkSession, df: DataFrame, path: str, by: Sequence[str], days: Sequence) -> None:
    """Delete the partitions of ``days`` under ``path`` that have no row in ``df``."""
    hive_null = "__HIVE_DEFAULT_PARTITION__"
    now = {tuple(hive_null if v is None else str(v) for v in r) for r in df.select(*by).distinct().collect()}  # partition values
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def visit(folder, values: tuple) -> None:
        if len(values) == len(by):
            if values not in now:
                fs.delete(folder, True)
        elif fs.exists(folder):
            for s in fs.listStatus(folder):
                name = s.getPath().getName()
                if name.startswith(by[len(values)] + "="):
                    visit(s.getPath(), (*values, unquote(name.split("=", 1)[1])))

    for day in days:
        visit(jvm.org.apache.hadoop.fs.Path(root, f"{by[0]}={day}"), (str(day),))


def publish_partitions(spark: SparkSession, df: DataFrame, path: str, by: Sequence[str]) -> int:
    """Replace exactly the partitions present in ``df`` through a staging copy.

    Spark cannot overwrite a path it is reading in the same job, and the
    new content is usually derived from the old.  The data is first written
    to a staging table in the shared checkpoint folder (this also cuts the
    lineage), its row count is verified against the staged files' metadata,
    then the touched partitions are replaced by a dynamic overwrite.
    Single writer per target.  Returns the staged row count.
    """
    n, staged, stage = stage_rows(spark, df, by)
    write_partitioned(staged, path, by, mode="overwrite", cluster=False)
    drop_stage(spark, stage)
    return n


def stage_rows(spark: SparkSession, df: DataFrame, by: Sequence[str]) -> tuple[int, DataFrame, str]:
    """(row count, staged table, its path): ``df`` written to the shared folder, partitioned by ``by``, and checked."""
    stage = scratch_path(spark, "stage")
    obs = Observation("staged")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).hint("rebalance", *by).write.mode("overwrite") \
        .partitionBy(*by).parquet(stage)
    # the written types, not those that directory names suggest ("01", nulls only)
    staged = spark.read.schema(df.schema).parquet(stage)
    n = staged.count()
    if n != obs.get["rows"]:
        raise RuntimeError(f"staging check failed: wrote {obs.get['rows']} rows, read {n}")
    return n, staged, stage


def drop_stage(spark: SparkSession, stage: str) -> None:
    """Remove a staged copy after its publish."""
    delete_path(spark, stage)


def write_serving(df: DataFrame, url: str, table: str, properties: dict[str, str],
                  mode: str = "append") -> None:
    """Load a serving table over JDBC (the driver jar must be on the classpath)."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)


def register_partitioned_table(spark: SparkSession, name: str, path: str, df_schema_ddl: str,
                               partition_cols: Sequence[str]) -> None:
    """External partitioned table over ``path`` plus partition discovery."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({df_schema_ddl}) USING parquet "
              f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   mode: str = "overwrite") -> None:
    """Bucketed, key-sorted table at ``path`` registered as ``table``.

    Two tables bucketed on the same key with the same bucket count join (and
    window/aggregate) on that key without any shuffle: the stream and batch
    sides of reconciliation, or Silver and its upserts, written this way
    are co-located once instead of being re-shuffled every run.
    """
    (df.write.mode(mode).format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
