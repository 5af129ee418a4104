import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from trackflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    folders = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    session = local_session(cores=8, shuffle_partitions=4, **folders)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return "/root/testdata/sf0.001"
