"""Skew probe: per-task shuffle reads with a hot key holding a third of all rows.

1. Velocity: every third event moved to one account; the textbook
   per-account window vs the cell-based form.
2. Dedup: every third event made a copy of one transaction; ``row_number``
   dedup with the planner's partial ``WindowGroupLimit`` disabled vs enabled.

Runs with Spark's event log on (a fresh scratch folder) and prints the
records read per task for every shuffle stage of each variant.  AQE
coalescing is off so the hash distribution itself is visible.

usage: python tools/skew_probe.py [sf_dir] [shuffle_partitions]
       SKEW_PROBE_COALESCE=true keeps AQE coalescing on (the default setting)
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = sys.argv[2] if len(sys.argv) > 2 else "32"
    logdir = tempfile.mkdtemp(prefix="ledgerline-evlog-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", parts)
             .config("spark.sql.adaptive.coalescePartitions.enabled",
                     os.environ.get("SKEW_PROBE_COALESCE", "false"))
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerline.operators.velocity import velocity_signals
    from ledgerline.sources import fixtures as fx

    t = fx.txn(spark, sf_dir).withColumn(
        "account_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("acct_hot")).otherwise(F.col("account_id")))
    rows = t.count()
    for label, fn in (("cell-based", velocity_signals),):
        spark.sparkContext.setJobGroup(label, label)
        fn(t).write.format("noop").mode("overwrite").save()
    # a group of copies: every third row is a re-delivery of one transaction
    from ledgerline.operators.quality import dedup_latest
    copies = fx.txn(spark, sf_dir).withColumn(
        "transaction_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("txn_hot")).otherwise(F.col("transaction_id")))
    for label, threshold in (("dedup, no pre-limit", "-1"), ("dedup (ours)", "1000")):
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
        spark.sparkContext.setJobGroup(label, label)
        dedup_latest(copies, ("transaction_id",), ("updated_at",)).write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    spark.stop()
    path = [p for p in glob.glob(f"{logdir}/*") if app in p][0]
    if os.path.isdir(path):
        path = sorted(glob.glob(path + "/*"))[0]
    group, reads = {}, {}
    with open(path) as fh:
        for line in fh:
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    group[s] = e.get("Properties", {}).get("spark.jobGroup.id")
            elif e["Event"] == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                reads.setdefault(e["Stage ID"], []).append(m.get("Total Records Read", 0))
    print(f"rows {rows}, hot account {rows // 3}, shuffle partitions {parts}")
    for label in ("per-account window", "cell-based", "dedup, no pre-limit", "dedup (ours)"):
        for s in sorted(x for x in reads if group.get(x) == label and sum(reads[x]) > 0):
            r = reads[s]
            print(f"{label:20s} stage {s:3d}: {sum(r):7d} records over {len(r)} tasks, largest task {max(r)}")


if __name__ == "__main__":
    main()
