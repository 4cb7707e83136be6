from datetime import datetime

import pytest
from pyspark.sql import functions as F

from goldweave import functions as G
from goldweave import session
from goldweave.operators import (
    Rule,
    castable,
    counted,
    max_length,
    normalize_feed,
    not_null,
    split_rejects,
)
from goldweave.operators.sizing import fits_in_memory
from goldweave.plans.control import highest_sequence
from goldweave.sources import LookupFailed, lookup_one


def one(spark, value, column, type_="string"):
    return spark.createDataFrame([(value,)], f"c {type_}").select(column).first()[0]


@pytest.mark.parametrize("text,expected", [("   ", None), ("", None), (None, None), (" a b ", "a b")])
def test_blank_to_null(spark, text, expected):
    assert one(spark, text, G.blank_to_null("c")) == expected


@pytest.mark.parametrize("text,expected", [
    ("2024-01-31 09:05:00 -05:00", datetime(2024, 1, 31, 14, 5)),
    ("2024-1-3 9:5:0 +05:30", datetime(2024, 1, 3, 3, 35)),
    ("", None), (None, None),
])
def test_parse_offset(spark, text, expected):
    assert one(spark, text, G.parse_offset_ts("c")) == expected


@pytest.mark.parametrize("text", ["bad", "2024-01-31 09:05:00 Z", "2024-01-31 09:05:00 +5:30", "2024-13-01 00:00:00 +00:00"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_offset_dates(spark, text, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a date with an offset"):
            one(spark, text, G.parse_offset_ts("c"))
        assert one(spark, text, G.is_bad_offset_date("c")) is True
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("minute,second,hour", [(29, 59, 10), (30, 0, 11), (0, 0, 10)])
def test_round_to_hour(spark, minute, second, hour):
    at = datetime(2024, 1, 1, 10, minute, second)
    assert one(spark, at, G.round_to_hour("c"), "timestamp") == datetime(2024, 1, 1, hour)


@pytest.mark.parametrize("highest,expected", [(999999999, 0), (None, 0), (7, 7)])
def test_next_sequence(spark, highest, expected):
    feed = spark.createDataFrame([(highest,)], "transaction_seq long")
    assert highest_sequence(feed).first()[0] == expected


def test_no_sequence_in_an_empty_feed(spark):
    assert highest_sequence(spark.createDataFrame([], "transaction_seq long")).first()[0] == 0


def test_concat_null_counts_as_empty(spark):
    assert one(spark, None, G.concat_text(F.lit("a"), "c", F.lit("b"))) == "ab"


def test_space_is_not_blank_and_null_keys_stay(spark):
    rows = spark.createDataFrame([(" ", " "), (None, "x"), (None, "x")], "k string, v string")
    got = normalize_feed(rows, ["k", "v"], trimmed=["v"], dates=[]).collect()
    assert sorted(map(str, got)) == sorted(["Row(k=' ', v=None)", "Row(k=None, v='x')"])


def test_rules(spark):
    rows = spark.createDataFrame(
        [("A", "1.5", "ok"), (None, "x", "too long"), ("B", "y", None), ("C", None, "ok")],
        "k string, n string, t string",
    )
    rules = [not_null(1, "k"), castable(2, "n", "decimal(38,10)"), max_length(3, "t", 4),
             Rule(4, "never", "k = 'Z'")]
    accepted, rejected = split_rejects(rows, rules)
    assert sorted(r.k for r in accepted.collect()) == ["A", "C"]
    got = {(r.k, r.sys_err_code, r.sys_err_mesg) for r in rejected.collect()}
    assert got == {
        (None, 1, "k is missing; n is not a decimal(38,10); t is longer than 4"),
        ("B", 2, "n is not a decimal(38,10)"),
    }
    everything, nothing = split_rejects(rows, [])
    assert everything.count() == 4 and nothing.count() == 0


def test_lookup_one(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    assert lookup_one(rows, F.col("k") == "a", ["v"])["v"] == 1
    for k, match in (("b", "several"), ("z", "none")):
        with pytest.raises(LookupFailed, match=match):
            lookup_one(rows, F.col("k") == k, ["v"])


def test_counted(spark):
    rows, seen = counted(spark.range(10), "ten", big=F.col("id") > 6)
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "big": 3}


def test_size_check(spark):
    rows = spark.range(100).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert fits_in_memory(rows)
    assert not fits_in_memory(rows, max_rows=99)
    assert not fits_in_memory(rows, rows, max_rows=150)
    assert not fits_in_memory(rows, max_bytes=9999)


class Settings:
    """Stands for a session of which only the settings are read."""

    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_shared_folder():
    assert session.shared_folder(Settings(spark_checkpoint_dir="/shared/x/")) == "/shared/x"
    warehouse = Settings(spark_sql_warehouse_dir="/warehouse/")
    assert session.shared_folder(warehouse) == "/warehouse"
    assert session.scratch(warehouse, "x") != session.scratch(warehouse, "x")
