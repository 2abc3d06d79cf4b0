import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wattle.session import build_session
    s = build_session("local[4]", app="wattle-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh"))})
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture
def rows():
    def _rows(df, *cols):
        return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
    return _rows
