"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="gold_transactions,kpi_channel", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True,
                         env=env, cwd="/", timeout=600)
    assert out.returncode == 0, out.stderr.decode()[-800:]
    lines = [ln for ln in out.stdout.decode().splitlines() if ln.strip()]
    d = json.loads(lines[-1])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec" and d["sf"] == "0.001"
    assert set(d["queries"]) == {"gold_transactions", "kpi_channel"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
