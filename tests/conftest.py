import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from carestrata import local_session

    folders = {"spark.sql.warehouse.dir": "warehouse", "spark.checkpoint.dir": "shared"}
    options = {key: str(tmp_path_factory.mktemp(name)) for key, name in folders.items()}
    session = local_session(4, shuffle_partitions=4, app="tests", options=options)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def database(spark, tmp_path):
    """A catalog database of its own."""
    name = "t_" + os.path.basename(str(tmp_path)).replace("-", "_").replace("[", "_").replace("]", "_").lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
