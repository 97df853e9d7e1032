from __future__ import annotations

from types import SimpleNamespace

import pytest

from tripflow.session import init_spark, shared_dir


def fake(master, **settings):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master),
                           conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)))


def test_shared_folder_is_required_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake("yarn"), "x")
    assert shared_dir(fake("local[2]"), "x").startswith("/")


def test_shared_folder_lies_under_the_named_one():
    spark = fake("yarn", **{"spark.checkpoint.dir": "hdfs://host/shared/"})
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith("hdfs://host/shared/tripflow/x-")
    assert first != second


def test_settings_are_passed_as_text(spark):
    session = init_spark("again", {"spark.sql.shuffle.partitions": 4, "tripflow.test": 1})
    assert session.conf.get("tripflow.test") == "1"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
