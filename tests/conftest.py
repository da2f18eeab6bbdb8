import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from mercato.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    wh = tmp_path_factory.mktemp("spark-warehouse")
    s = get_session("local[*]", shuffle_partitions=8, extra={"spark.sql.warehouse.dir": str(wh)})
    yield s


@pytest.fixture(scope="session")
def fx(spark):
    from mercato.sources.fixtures import Fixtures
    return Fixtures(spark, SF_SMALL)


def rows(df, *cols):
    """Collected rows as tuples, sorted by their repr (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
