from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from spotlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(4, "tests", **{
        "spark.sql.warehouse.dir": warehouse, "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def store(spark, request):
    from spotlake.sources.store import Store

    name = "t_" + "".join(ch if ch.isalnum() else "_" for ch in request.node.name.lower())[:60]
    made = Store(spark, name).create()
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
