"""Incremental landing audit: a parquet drop of fixture sales is audited once."""
import os
import tempfile

import pytest

from conftest import SF
from qualis.plans.catalog import fixture_rules
from qualis.sources.fixture import SALES_COLUMNS
from qualis.sources.readers import load_fixture
from qualis.streaming.landing import audit_landing

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stream_audits_a_drop(spark):
    d = tempfile.mkdtemp(prefix="qualis-stream-")
    t = load_fixture(spark, SF)
    t["sales"].select(*SALES_COLUMNS).coalesce(1).write.parquet(f"{d}/landing/drop1")
    masters = {k: t[k] for k in ("customers", "products", "targets")}
    q = audit_landing(spark, f"{d}/landing/drop1", masters, fixture_rules(), f"{d}/findings", f"{d}/ckpt")
    q.awaitTermination(600)
    f = spark.read.parquet(f"{d}/findings")
    assert f.count() > 0
    assert f.where("check_id = 'COM_001'").count() > 0
