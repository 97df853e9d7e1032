from __future__ import annotations

import hashlib
from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import values
from tripflow.functions import (
    concat_key,
    field_or_default,
    hours_between,
    md5_key,
    millis_to_timestamp,
)


def test_row_id_of_nulls_is_hash_of_empty_text(spark):
    df = spark.createDataFrame([(None, None)], "a string, b timestamp")
    assert df.select(md5_key(["a", "b"])).first()[0] == hashlib.md5(b"").hexdigest()


def test_row_id_without_separator_runs_values_together(spark):
    df = spark.createDataFrame([(1, 12), (11, 2)], "a int, b int")
    assert df.select(md5_key(["a", "b"])).distinct().count() == 1
    assert df.select(md5_key(["a", "b"], sep="|")).distinct().count() == 2


def test_concat_key_writes_large_amounts_plainly(spark):
    df = spark.createDataFrame([(12345678.5,)], "x double")
    assert df.select(concat_key([F.col("x").cast("decimal(18,2)")])).first()[0] == "12345678.50"


text = st.one_of(st.none(), st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=8))


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(text, text, text), min_size=1, max_size=20))
def test_row_id_equals_hash_of_joined_text(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    found = [r[0] for r in df.select(md5_key(["a", "b", "c"])).collect()]
    wanted = [hashlib.md5("".join(v or "" for v in r).encode()).hexdigest() for r in rows]
    assert sorted(found) == sorted(wanted)


def test_millis_drop_the_fraction(spark):
    df = spark.createDataFrame([(1570000000999,), (-1500,), (None,)], "ms bigint")
    found = [r[0] for r in df.select(F.unix_micros(millis_to_timestamp("ms"))).collect()]
    assert found == [1570000000000000, -1000000, None]


def test_hours_between_keeps_sign(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 30)),
         (datetime(2024, 1, 2), datetime(2024, 1, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(hours_between("a", "b")).collect()] == [1.5, -24.0]


def test_default_only_for_missing_keys(spark):
    docs = ['{"a": null}', "{}", '{"a": "x"}', '{"a": {"b": [1]}}', '{"a": 1.25}', "not json", None]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    found = df.select(field_or_default(F.try_parse_json("d"), "a", "N/A").cast("string"))
    assert [r[0] for r in found.collect()] == [None, "N/A", "x", '{"b":[1]}', "1.25", None, None]


def test_default_field_names_may_hold_dots_and_spaces(spark):
    df = spark.createDataFrame([('{"a.b": 1, "c d": 2}',)], "d string")
    doc = F.try_parse_json("d")
    found = df.select(*[field_or_default(doc, f, "-").cast("string") for f in ("a.b", "c d", "a")])
    assert tuple(found.first()) == ("1", "2", "-")


def test_json_keeps_types_and_writes_defaults(spark):
    df = spark.createDataFrame([('{"price": 9.5, "brand": null}',), ('{"price": 3}',)], "d string")
    doc = F.try_parse_json("d")
    out = df.select(F.to_json(F.struct(
        field_or_default(doc, "brand", "N/A").alias("brand"),
        field_or_default(doc, "price", "N/A").alias("price"))))
    assert values(out) == [('{"brand":"N/A","price":3}',), ('{"brand":null,"price":9.5}',)]


def test_money_sums_are_exact(spark):
    df = spark.range(1000).select(F.lit("0.1").cast("decimal(38,9)").alias("x"))
    assert df.agg(F.sum("x")).first()[0] == Decimal("100.000000000")
