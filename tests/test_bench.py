"""bench.py prints exactly the one JSON line the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_WARMUP_DIR="/nonexistent")  # skip the warm-up to keep the test short
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001 and res["metric"]
    assert set(res["queries"]) >= {"star_build", "agg_monthly_sales", "agg_state_performance", "delimited_ingest"}
    assert abs(res["value"] - sum(res["queries"].values())) < 0.01
