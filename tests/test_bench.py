"""bench.py stays runnable and prints exactly one JSON line."""
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_REPEAT": "1",
           "BENCH_BASELINE": "1", "BENCH_CPUS": "2", "BENCH_WARMUP_DIR": "/nonexistent"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and result["value"] > 0 and result["sf"] == "0.001"
    assert {"ingest", "silver", "gold", "bi_by_region"} <= set(result["queries"])
    assert result["rows"]["silver"] == 4225 and result["baseline"]["speedup"] > 0
