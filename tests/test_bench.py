"""bench.py prints one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="rating_counts,genre_top10", BENCH_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    b = json.loads(lines[0])
    assert b["metric"] and b["unit"] == "sec" and b["sf"] == 0.001
    assert set(b["queries"]) == {"rating_counts", "genre_top10"}
    assert all(isinstance(v, float) for v in b["queries"].values())
    assert abs(b["value"] - sum(b["queries"].values())) < 1e-6
