"""Benchmark: full audit of the dirty fixture at $BENCH_SF_DIR on local[$BENCH_CPUS].

1. land the fixture (derived from the TPC-H-like tables) as parquet in a fresh
   scratch folder - the "landing area" a real run would read;
2. time the full audit from the landing area: findings, score, cleaning,
   second pass, master, reports (all written).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from qualis.plans.audit import run_audit  # noqa: E402
from qualis.plans.catalog import fixture_rules  # noqa: E402
from qualis.session import local_session  # noqa: E402
from qualis.sources import sinks as SK  # noqa: E402
from qualis.sources.readers import load_fixture, read_landing  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="qualis-bench")
    scratch = tempfile.mkdtemp(prefix="qualis-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    rules = fixture_rules()

    t0 = time.time()
    SK.write_tables(load_fixture(spark, sf_dir), f"{scratch}/landing")
    land = time.time() - t0

    tables = read_landing(spark, f"{scratch}/landing")
    t1 = time.time()
    run = run_audit(spark, tables, rules, f"{scratch}/out")
    total = time.time() - t1
    raw, cl = run.score_raw.first(), run.score_clean.first()
    rows = {r["table"]: r["rows_after"] for r in run.cleaning.rows.collect()}
    out = {
        "metric": "full_audit_wall_time",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {**run.timings, "land_fixture": round(land, 3)},
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "spark": spark.version,
        "rows_checked": raw["total_row_count"],
        "findings_raw": raw["total_errors"],
        "score_raw": raw["score"],
        "score_clean": cl["score"],
        "findings_clean": cl["total_errors"],
        "master_rows": rows.get("sales"),
    }
    run.close()
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
