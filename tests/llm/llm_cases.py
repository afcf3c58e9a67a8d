import os

import pytest

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows to a DataFrame that also carries columns with clashing names."""
    clash = "score double, kept boolean, component_id long, lang_pred string, predicted int, held_out boolean, n_words long"

    def make(rows, schema):
        fields = schema + ", " + clash
        return spark.createDataFrame([tuple(r) + (0.5, False, 7, "xx", 9, None, 1) for r in rows], fields)
    return make


@pytest.fixture(scope="session")
def have_data():
    if not os.path.isdir(SMALL):
        pytest.skip("test data not present")
