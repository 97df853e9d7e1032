from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.session import init_spark  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = init_spark("tests", {
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": 4,
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan_of(df) -> str:
    """The plan after running, with what adaptive execution made of it."""
    df.collect()
    return plan_of(df)


def values(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
