"""bench.py prints one JSON line with per-query medians."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_dir):
    env = dict(os.environ, BENCH_SF_DIR=sf_dir, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_ONLY="top_regions,label_range")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    line = [x for x in out.stdout.splitlines() if x.startswith("{")][-1]
    rec = json.loads(line)
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"top_regions", "label_range"}
    assert rec["value"] > 0 and "failed" not in rec
