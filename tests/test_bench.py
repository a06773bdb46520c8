import json
import os
import subprocess
import sys

from paths import SF

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "count_songs", "gd_weights"],
                         env=env, capture_output=True, text=True, timeout=600, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout + out.stderr
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"count_songs", "gd_weights"}
    assert d["value"] > 0 and "failed" not in d
    assert set(d["spark_jobs"]) == {"count_songs", "gd_weights"} and d["spark_jobs"]["gd_weights"] <= 6
