from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidegrid.functions import ids, times, values


def fnv(text: str) -> int:
    h = 2166136261
    for byte in text.encode():
        h = ((h ^ byte) * 16777619) & 0xFFFFFFFF
    return h


@pytest.mark.parametrize("tags,expected", [
    ({"t1": "v1"}, "2922638416"), ({"foo": "bar", "biz": "baz"}, "116814562"),
    ({"k": "é"}, "3212606503"), ({}, "2166136261")])
def test_series_id(spark, tags, expected):
    df = spark.createDataFrame([(tags,)], "tags map<string,string>")
    assert df.select(ids.series_id(F.col("tags")).alias("id")).first()["id"] == expected


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",),
                                               blacklist_characters="\x00")), max_size=20))
def test_hash_any_text(spark, texts):
    rows = [(t,) for t in texts] or [("",)]
    got = spark.createDataFrame(rows, "t string").select(
        "t", ids.fnv32a(F.col("t")).alias("h"), ids.fnv32a_rows(F.col("t")).alias("r"))
    assert all(r["h"] == r["r"] == fnv(r["t"]) for r in got.collect())


def test_null_tag_is_absent(spark):
    df = spark.createDataFrame([({"a": "1", "b": None},)], "tags map<string,string>")
    row = df.select(ids.key_text(F.col("tags")).alias("k"),
                    ids.key_text_of({"b": F.lit(None).cast("string"), "a": F.lit("1")})
                    .alias("c"), ids.tags_to_labels(F.col("tags")).alias("l")).first()
    assert row["k"] == row["c"] == "a=1,"
    assert [(x["name"], x["value"]) for x in row["l"]] == [("a", "1")]


@pytest.mark.parametrize("name,tags,expected", [
    ("CPU", {"b": "2", "a": "1", "c": "3"}, "cpua1b2"), ("m", {"only": "x"}, "m"), ("M", {}, "m"),
    ("m", {"": "v"}, "mv"), ("m", {"": "v", "a": "1"}, "mvvv")])
def test_bench_id(spark, name, tags, expected):
    df = spark.createDataFrame([(name, tags)], "name string, tags map<string,string>")
    got = df.select(ids.bench_id(F.col("name"), F.col("tags")).alias("id")).first()["id"]
    assert got == expected


@pytest.mark.parametrize("labels,expected", [
    ([("a", "1"), ("b", "2"), ("a", "3")], {"a": "3", "b": "2"}), ([], {}),
    ([("a", "1"), ("a", "1")], {"a": "1"})])
def test_last_label_wins(spark, labels, expected):
    df = spark.createDataFrame([(labels,)], "labels array<struct<name:string,value:string>>")
    assert df.select(ids.labels_to_tags(F.col("labels")).alias("t")).first()["t"] == expected


@pytest.mark.parametrize("texts,expected", [
    ([], False), ([""], True), (["q"], False), (["q", "w", "e"], False), (["q", "", "e"], True),
    (["q", "w", ""], True)])
def test_any_empty(spark, texts, expected):
    row = spark.range(1).select(ids.any_empty(*[F.lit(t) for t in texts]).alias("e")).first()
    assert row["e"] is expected


@pytest.mark.parametrize("text,micros", [
    ("48h", 172800000000), ("2h", 7200000000), ("10m", 600000000), ("1h30m", 5400000000),
    ("1.5s", 1500000), ("-2ms", -2000), ("0", 0), ("300us", 300), ("1500ns", 1)])
def test_duration(text, micros):
    assert times.micros_of(text) == micros


@pytest.mark.parametrize("text", ["", "1", "h", "1x", "1h 2m", "--1s"])
def test_bad_duration(text):
    with pytest.raises(ValueError):
        times.parse_duration(text)


def test_millis_cut_toward_zero(spark):
    stamps = [datetime(1969, 12, 31, 23, 59, 59, 999500), datetime(1969, 12, 31, 23, 59, 58, 1),
              datetime(2024, 3, 31, 2, 30, 0, 999999), datetime(1970, 1, 1)]
    for zone in ("UTC", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
            row = df.select(times.to_millis(F.col("ts")).alias("ms"),
                            times.from_millis(times.to_millis(F.col("ts"))).alias("back"),
                            times.step_index(F.col("ts"), "1969-12-31", "1h").alias("h")).collect()
        finally:
            spark.conf.unset("spark.sql.session.timeZone")
        assert [r["ms"] for r in row] == [0, -1999, 1711852200999, 0]
        assert row[2]["back"] == datetime(2024, 3, 31, 2, 30, 0, 999000)
        assert [r["h"] for r in row] == [
            (s - datetime(1969, 12, 31)) // timedelta(hours=1) for s in stamps]


def test_step_millis():
    assert times.step_millis("1m") == 60000
    assert times.step_millis(timedelta(microseconds=1999)) == 1


def test_value_arrays(spark):
    nan = float("nan")
    df = spark.createDataFrame([([1.0, nan, 3.0],), ([nan, nan],), ([],)], "v array<double>")
    rows = df.select(values.value_at(F.col("v"), 2).alias("at"),
                     values.all_missing(F.col("v")).alias("none"),
                     values.slice_values(F.col("v"), 0, 1).alias("head")).collect()
    assert [r["at"] for r in rows] == [3.0, None, None]
    assert [r["none"] for r in rows] == [False, True, True]
    assert rows[0]["head"] == [1.0]
    filled = spark.range(1).select(values.constant_values(1.0, 10_000).alias("v")).first()["v"]
    assert len(filled) == 10_000 and set(filled) == {1.0}


def test_wire_precision(spark):
    row = spark.range(1).select(values.wire_precision(F.lit(185.22)).alias("v")).first()
    assert row["v"] == 185.22000122070312
