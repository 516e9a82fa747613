from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.matchers import eq, re_match
from tidegrid.operators import fetch as fetching
from tidegrid.sinks.points import fanout_write, read_points, write_points, write_series
from tidegrid.sources import stores as op
from tidegrid.sources.points import points_from_map, with_series_id
from tidegrid.sources.wire import (WIRE_SERIES, WRITE_REQUEST, metric_ids, read_metric_lines,
                                   series_to_points, write_request_points)

T = datetime(2024, 1, 1)


def points(spark, *rows):
    return points_from_map(spark.createDataFrame(
        list(rows), "name string, tags map<string,string>, ts timestamp_ntz, value double"))


def small(spark):
    return points(spark, ("m", {"foo": "bar"}, T, 10.0), ("m", {"foo": "qux"}, T, None),
                  ("other", {"foo": "bar"}, T + timedelta(minutes=1), 2.0))


QUERY = op.Query((eq("foo", "bar"),), T, T + timedelta(hours=1))


@pytest.mark.parametrize("accept,allowed", [
    (op.local_only, (True, False, False)), (op.allow_all, (True, True, True)),
    (op.allow_none, (False, False, False))])
def test_filters(accept, allowed):
    kinds = (op.StoreType.LOCAL, op.StoreType.REMOTE, op.StoreType.MULTI)
    assert tuple(accept(None, op.Store("s", k)) for k in kinds) == allowed


def test_fanout(spark):
    near = op.Store("near", op.StoreType.LOCAL, small(spark))
    again = op.Store("again", op.StoreType.LOCAL, small(spark))
    far = op.Store("far", op.StoreType.REMOTE, small(spark), lossy=True)
    assert op.fanout_fetch([near, again, far], QUERY).count() == 4
    everything = op.fanout_fetch([near, again, far], QUERY, op.allow_all)
    assert everything.count() == 6
    assert op.only_local(everything).first()["local_only"] is False
    none = op.fanout_fetch([near, far], QUERY, op.allow_none)
    assert none.count() == 0 and op.only_local(none).first()["local_only"] is True
    assert op.fanout_search([near, again], QUERY).count() == 4


def test_failing_store(spark):
    bad = small(spark).withColumn("value", F.raise_error(F.lit("store is down")).cast("double"))
    stores = [op.Store("ok", op.StoreType.LOCAL, small(spark)),
              op.Store("bad", op.StoreType.LOCAL, bad)]
    with pytest.raises(Exception, match="store is down"):
        op.fanout_fetch(stores, QUERY).collect()


def test_null_value_is_nan(spark):
    row = small(spark).where(F.col("tags")["foo"] == "qux").select(F.isnan("value").alias("n"))
    assert row.first()["n"] is True


def test_names_keep_series_apart(spark):
    assert fetching.search(small(spark), [eq("foo", "bar")]).count() == 2
    assert fetching.search(small(spark), [eq("foo", "bar")], name="m").count() == 1


def test_limits():
    assert [fetching.parse_limit(t) for t in ("100", "90", None, "", "x", "1.5", " 5 ", "\u0663", "-5", "+7")] == \
        [100, 90, 1000, 1000, 1000, 1000, 1000, 1000, -5, 7]


def test_search_result(spark):
    found = fetching.metrics(fetching.search(small(spark), [eq("foo", "bar")], name="m")).first()
    assert found["namespace"] == "default" and found["tags"] == {"foo": "bar"}
    assert with_series_id(small(spark)).first()["series_id"] == int(found["id"])


def test_no_matchers_is_everything(spark):
    assert fetching.fetch(small(spark), [], T, T + timedelta(days=1)).count() == 3


def test_end_is_exclusive(spark):
    assert fetching.fetch(small(spark), [], T, T + timedelta(minutes=1)).count() == 2


def test_selector(spark):
    assert str(fetching.Selector("m", (eq("a", "b"),), "5m", "1m")) == \
        'm{a="b"}[5m] offset 1m'
    now = T + timedelta(minutes=5)
    assert fetching.Selector(offset="5m", range="1m").apply(small(spark), now).count() == 2
    assert fetching.Selector(offset="4m", range="1m", direction="lookback") \
        .apply(small(spark), now).count() == 2
    assert fetching.Selector("other", offset="4m").apply(small(spark), now).count() == 1
    with pytest.raises(ValueError):
        fetching.Selector(range="1m", direction="up").apply(small(spark), now)


def test_resolve_needs_equality(spark):
    row = fetching.resolve([eq("t1", "v1")], T, T, "p").frame(spark).first()
    assert row["id"] == "2922638416" and row["series_key"] == "t1=v1,"
    with pytest.raises(ValueError):
        fetching.resolve([re_match("t1", "v1")], T, T, "p")


def test_resolved_request_is_one_series(spark):
    made = points(spark, ("m", {"a": "1"}, T, 1.0), ("m", {"a": "1", "b": "2"}, T, 2.0))
    request = fetching.resolve([eq("a", "1")], T, T + timedelta(hours=1), "p")
    assert [r["value"] for r in request.fetch(made).collect()] == [1.0]
    again = fetching.fetch_requests(made, request.frame(spark))
    assert [r["value"] for r in again.collect()] == [1.0]
    assert fetching.same_ranges(request.frame(spark), request.frame(spark)).count() == 1
    other = fetching.resolve([eq("a", "1")], T, T + timedelta(hours=1), "q")
    assert fetching.same_ranges(request.frame(spark), other.frame(spark)).count() == 0


def test_write_request(spark):
    ms = 1704067200123
    rows = [([("foo", "bar"), ("biz", "baz")], [(1.0, ms), (2.0, ms)]),
            ([("foo", "qux"), ("bar", "baz"), ("foo", "last")], [(3.0, ms), (4.0, ms)]),
            ([("__name__", "up")], [(float("nan"), -1)])]
    got = write_request_points(spark.createDataFrame(rows, WRITE_REQUEST)).collect()
    assert sorted((r["series_key"], r["value"]) for r in got if r["value"] == r["value"]) == [
        ("bar=baz,foo=last,", 3.0), ("bar=baz,foo=last,", 4.0), ("biz=baz,foo=bar,", 1.0),
        ("biz=baz,foo=bar,", 2.0)]
    assert {r["ts"] for r in got} == {datetime(2024, 1, 1, 0, 0, 0, 123000),
                                      datetime(1969, 12, 31, 23, 59, 59, 999000)}
    assert {r["name"] for r in got} == {"", "up"}


def test_link_series(spark):
    rows = [("regex", 949812888000, [1.0, 2.0, 3.0], {"a": "b", "c": "d"}, "specs", 100),
            ("eq", 3885598488000, [4.0, 5.0, 6.0], {"e": "f", "g": "h"}, "fix", 120)]
    got = series_to_points(spark.createDataFrame(rows, WIRE_SERIES)).collect()
    first = datetime(2000, 2, 6, 4, 54, 48)
    assert sorted((r["ts"], r["value"]) for r in got if r["name"] == "regex") == [
        (first + timedelta(milliseconds=100 * i), float(i + 1)) for i in range(3)]
    assert {r["series_key"] for r in got} == {"a=b,c=d,", "e=f,g=h,"}


def test_metric_lines(spark, tmp_path):
    good = tmp_path / "good.json"
    good.write_text('\n{"metric":"CPU","timestamp":1704067200001,"tags":{"b":"2","a":"1"},'
                    '"value":1.5}\n\n   \n{"metric":"m","timestamp":0,"tags":{"x":"y"},"value":2}\n')
    got = metric_ids(read_metric_lines(spark, str(good))).collect()
    assert sorted((r["bench_id"], r["value"]) for r in got) == [("cpua1", 1.5), ("m", 2.0)]
    bad = tmp_path / "bad.json"
    bad.write_text('{"metric":"CPU"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_metric_lines(spark, str(bad)).collect()


def test_stored_table(spark, tmp_path, capsys):
    path = str(tmp_path / "points")
    write_points(small(spark), path, promote=["foo"])
    write_points(points(spark, ("m", {"foo": "bar"}, T + timedelta(days=2), 5.0)), path,
                 promote=["foo"])
    write_series(small(spark), str(tmp_path / "series"))
    stored = read_points(spark, path)
    found = fetching.fetch(stored, [eq("foo", "bar")], T, T + timedelta(days=1))
    assert found.count() == 2
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(tag_foo,bar)" in plan and "block_date" in plan.split("PartitionFilters")[1]
    by_series = fetching.fetch(stored, [eq("foo", "bar")], T, T + timedelta(days=3), name="m",
                               series=read_points(spark, str(tmp_path / "series")))
    assert by_series.count() == 2
    with pytest.raises(ValueError):
        write_points(None, path)


@pytest.mark.parametrize("cut,column", [("month", "block_month"), ("year", "block_year")])
def test_wider_cuts(spark, tmp_path, cut, column):
    path = str(tmp_path / "p")
    days = [T, T + timedelta(days=40), T + timedelta(days=300), T + timedelta(days=400)]
    write_points(points(spark, *[("m", {}, d, 1.0) for d in days]), path, cut=cut)
    stored = read_points(spark, path)
    assert column in stored.columns
    assert fetching.in_range(stored, T + timedelta(days=20), T + timedelta(days=301)).count() == 2


def test_fanout_write(spark, tmp_path):
    made = [op.Store("a", op.StoreType.LOCAL, path=str(tmp_path / "a")),
            op.Store("b", op.StoreType.REMOTE, path=str(tmp_path / "b"))]
    assert fanout_write(small(spark), made) == ["a"]
    assert read_points(spark, made[0].path).count() == 3
    assert not (tmp_path / "b").exists()


def test_first_failed_write_is_raised(spark, tmp_path):
    bad = small(spark).withColumn("value", F.raise_error(F.lit("broken")).cast("double"))
    made = [op.Store(x, op.StoreType.LOCAL, path=str(tmp_path / x)) for x in "ab"]
    with pytest.raises(Exception, match="broken"):
        fanout_write(bad, made)
    assert not list((tmp_path).glob("b/*.parquet"))


def test_no_stores_at_all(spark):
    assert op.fanout_fetch([], QUERY).count() == 0
    assert op.fanout_search([], QUERY).count() == 0


def test_ids_of_one_namespace(spark):
    both = small(spark).unionByName(small(spark).withColumn("namespace", F.lit("other")))
    key = both.first()["series_key"]
    every = fetching.fetch_ids(both, [key], "1970-01-01", "2100-01-01").count()
    one = fetching.fetch_ids(both, [key], "1970-01-01", "2100-01-01", namespace="other").count()
    assert every == 2 * one > 0


def test_requests_and_queries_prune_a_cut_table(spark, tmp_path):
    made = points(spark, *[("m", {"a": str(i)}, T + timedelta(days=i), float(i)) for i in range(9)])
    made.withColumn("block_date", F.to_date("ts")).write.partitionBy("block_date") \
        .parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    many = fetching.fetch_many(stored, [("q", [], T, T + timedelta(days=2)),
                                        ("r", [], T + timedelta(days=1), T + timedelta(days=3))])
    assert sorted((r["query"], r["value"]) for r in many.collect()) == [
        ("q", 0.0), ("q", 1.0), ("r", 1.0), ("r", 2.0)]
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block_date" in plan
    wanted = fetching.resolve([eq("a", "4")], T, T + timedelta(days=9), "p").frame(spark)
    assert [r["value"] for r in fetching.fetch_requests(stored, wanted).collect()] == [4.0]
