"""Small-file compaction by bytes, planned from file metadata alone.

``plan`` lists the files with their sizes (the ``path`` and ``length`` columns of the
binary-file source: no content is read) and packs the small ones of each partition
directory, in order, into bins of about ``target_bytes``.  ``compact`` rewrites those
bins only, each by one task into one file, and swaps the files inside their
directory.  Partition values are never parsed, so "01", null and escaped ones stay
as they are, and files of other partitions aren't touched.

The swap follows a journal beside the table: rewritten files are complete before
the first old file goes, and ``compact`` first finishes what an interrupted run left.
One writer a table; readers that list the table during the swap of a directory
may see rows twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.runtime import delete_path, file_system, path_exists

PREFIX = "compact-"
_BIN = "_compaction_bin"


@dataclass(frozen=True)
class CompactionParams:
    target_bytes: int = 128 << 20
    small: float = 0.75            # files under this share of the target are small
    files_at_once: int = 10_000    # planned and rewritten in one round


def journal_path(path: str) -> str:
    return path.rstrip("/") + "_compaction"


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """path, its URI, length and directory of every Parquet file below ``path``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path))
    return files.select("path", F.col("_metadata.file_path").alias("uri"), "length", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"))


def plan(spark: SparkSession, path: str, p: CompactionParams = CompactionParams()) -> DataFrame:
    """dir, nth (bin of the directory), path, uri, length of the files to rewrite.

    A bin needs two files at least, one of them not written by a compaction, so
    that a second run finds nothing to do.
    """
    small = file_sizes(spark, path).where(F.col("length") < int(p.small * p.target_bytes))
    in_order = Window.partitionBy("dir").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(in_order), F.lit(0))
    nth = F.floor(before / F.lit(float(p.target_bytes))).cast("int")
    binned = small.withColumn("nth", nth)
    per_bin = Window.partitionBy("dir", "nth")
    fresh = ~F.regexp_extract("path", r"([^/]*)$", 1).startswith(PREFIX)
    return (binned.withColumn("_n", F.count("path").over(per_bin)).withColumn("_fresh", F.count_if(fresh).over(per_bin))
            .where("_n > 1 AND _fresh > 0").select("dir", "nth", "path", "uri", "length"))


def compact(spark: SparkSession, path: str, p: CompactionParams = CompactionParams()) -> dict[str, int]:
    """Rewrite the small files of a table.  Returns files and bytes read, files written and rows moved."""
    recover(spark, path)
    total = {"files_before": 0, "files_after": 0, "bytes": 0, "rows": 0}
    chosen = plan(spark, path, p).orderBy("dir", "nth", "path").collect()  # file metadata of the small files
    bins: dict[tuple, list] = {}
    for r in chosen:
        bins.setdefault((r["dir"], r["nth"]), []).append(r)
    rounds: list[list] = [[]]
    for files in bins.values():
        if rounds[-1] and sum(map(len, rounds[-1])) + len(files) > p.files_at_once:
            rounds.append([])
        rounds[-1].append(files)
    for work in rounds:
        if not work:
            continue
        run = uuid.uuid4().hex[:12]
        rows = _stage(spark, path, run, work)
        _swap(spark, path, run)
        total["files_before"] += sum(map(len, work))
        total["files_after"] += len(work)
        total["bytes"] += sum(r["length"] for files in work for r in files)
        total["rows"] += rows
    return total


def _stage(spark: SparkSession, path: str, run: str, work: list) -> int:
    """Write the bins' rows, a folder and a file each, and the list of what they replace.  Returns the rows."""
    root = f"{journal_path(path)}/run={run}"
    listed = spark.createDataFrame([(n, r["dir"], r["path"], r["uri"]) for n, files in enumerate(work) for r in files],
                                   f"{_BIN} int, dir string, path string, uri string")
    listed.write.parquet(f"{root}/plan")
    # explicit files: no partition column is inferred, the rows keep their stored columns only
    files = [r["path"] for group in work for r in group]
    data = spark.read.option("mergeSchema", "true").parquet(*files)
    obs = Observation("compacted")
    by_file = F.broadcast(listed.select(_BIN, F.col("uri").alias("_file")))  # at most ``files_at_once`` rows
    rows = (data.withColumn("_file", F.col("_metadata.file_path")).join(by_file, "_file").drop("_file")
            .observe(obs, F.count(F.lit(1)).alias("rows")))
    rows.repartition(len(work), _BIN).sortWithinPartitions(_BIN).write.partitionBy(_BIN).parquet(f"{root}/files")
    want = data.select(F.count(F.lit(1))).first()[0]  # from the footers
    if obs.get["rows"] != want:
        raise RuntimeError(f"compaction of {path}: {want} rows to move, {obs.get['rows']} written")
    spark.createDataFrame([(int(want),)], "rows long").coalesce(1).write.parquet(f"{root}/checked")
    return int(want)


def _swap(spark: SparkSession, path: str, run: str) -> None:
    """Move the rewritten files in, the old ones out.  Repeatable at any point."""
    root = f"{journal_path(path)}/run={run}"
    fs, _ = file_system(spark, root)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    groups: dict[int, list] = {}
    for r in spark.read.parquet(f"{root}/plan").collect():
        groups.setdefault(r[_BIN], []).append(r)
    for n, files in sorted(groups.items()):
        into = hadoop(files[0]["dir"], f"{PREFIX}{run}-{n}.parquet")
        staged = hadoop(f"{root}/files/{_BIN}={n}")
        if not fs.exists(into):
            new = [s.getPath() for s in fs.listStatus(staged) if s.getPath().getName().endswith(".parquet")]
            if len(new) != 1 or not fs.rename(new[0], into):
                raise RuntimeError(f"compaction of {path}: bin {n} of run {run} is not in place")
        for r in files:
            fs.delete(hadoop(r["path"]), False)
    delete_path(spark, f"{root}/checked")  # from here on the run counts as not begun
    delete_path(spark, root)


def recover(spark: SparkSession, path: str) -> int:
    """Finish the swaps that an interrupted run left, drop what it hadn't finished staging.  Returns the runs finished."""
    done = 0
    if path_exists(spark, journal_path(path)):
        fs, root = file_system(spark, journal_path(path))
        for s in fs.listStatus(root):
            run = s.getPath().getName().removeprefix("run=")
            if path_exists(spark, f"{journal_path(path)}/run={run}/checked/_SUCCESS"):
                _swap(spark, path, run)
                done += 1
            else:
                delete_path(spark, f"{journal_path(path)}/run={run}")
    return done
