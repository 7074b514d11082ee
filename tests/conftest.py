import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

#: Folder of the evaluation tool's recorded inputs and outputs; the golden tests need it.
FIXTURES = os.environ.get("RANKLENS_GOLDEN", "")
SF = os.environ.get("RANKLENS_TEST_SF", "/root/testdata/sf0.01")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ck = tempfile.mkdtemp(prefix="ranklens-test-ckpt-")
    s = (
        SparkSession.builder.master("local[8]")
        .appName("ranklens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", ck)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ck)
    yield s


def fixture(name):
    p = os.path.join(FIXTURES, name)
    if not FIXTURES or not os.path.exists(p):
        pytest.skip(f"fixture {p} not present")
    return p


def read_golden(name):
    """measure -> qid -> value (float, or str for string measures)."""
    out = {}
    with open(fixture(name)) as fh:
        for line in fh:
            parts = line.rstrip("\n").split("\t")
            if len(parts) != 3:
                continue
            m, q, v = parts[0].strip(), parts[1].strip(), parts[2].strip()
            try:
                val = float(v)
            except ValueError:
                val = v
            out.setdefault(m, {})[q] = val
    return out
