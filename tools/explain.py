"""Print the formatted physical plan of the fused sales record pass on landed
parquet (scan pruning, pushed filters, join strategies, codegen spans).

Usage: python tools/explain.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qualis.operators import checks as C  # noqa: E402
from qualis.plans.catalog import fixture_rules  # noqa: E402
from qualis.session import local_session  # noqa: E402
from qualis.sources import sinks as SK  # noqa: E402
from qualis.sources.readers import load_fixture, read_landing  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    d = tempfile.mkdtemp(prefix="qualis-explain-", dir=os.environ.get("TMPDIR", "/tmp"))
    SK.write_tables(load_fixture(spark, sf), f"{d}/landing")
    tables, rules = read_landing(spark, f"{d}/landing"), fixture_rules()
    aligned, layout = C.align(tables, rules)
    raw, _ = C.table_records(aligned, layout, rules)
    raw["sales"].explain("formatted")


if __name__ == "__main__":
    main()
