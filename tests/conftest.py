import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import airline  # noqa: E402
from starhouse.plans import warehouse  # noqa: E402
from starhouse.session import local_session  # noqa: E402
from starhouse.sources.store import Store  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="starhouse-test-")
    session = local_session(
        8, "starhouse-tests",
        spark__sql__warehouse__dir=f"{scratch}/sql",
        spark__checkpoint__dir=f"{scratch}/shared",
        spark__sql__shuffle__partitions="4",
    )
    yield session
    session.stop()


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "warehouse")


@pytest.fixture(scope="session")
def small(spark, tmp_path_factory):
    """The small airline, loaded once under all gates; for reading only."""
    return warehouse.load(spark, airline.feeds(spark), str(tmp_path_factory.mktemp("small")),
                          airline.CALENDAR)


@pytest.fixture()
def small_root(small, spark, root):
    """A root of its own that starts from the small airline's tables."""
    Store(spark, root).adopt(small.published)
    return root


@pytest.fixture()
def fixed_partitions(spark):
    """Keep small shuffle partitions apart, so that their contents can be inspected."""
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, "false")
    yield
    spark.conf.unset(option)
