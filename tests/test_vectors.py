import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import aggregate as agg
from tidegrid.operators import grid
from tidegrid.operators import vector as op
from tidegrid.sinks.records import batches, nest_series
from tidegrid.sources.points import points_from_map

T = datetime(2024, 1, 1)
NAN = float("nan")


def vec(spark, *rows):
    made = points_from_map(spark.createDataFrame(
        [("m", tags, T + timedelta(minutes=step), float(value)) for tags, step, value in rows],
        "name string, tags map<string,string>, ts timestamp_ntz, value double"))
    return made.withColumn("step_ts", F.col("ts"))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_arithmetic_edges(spark):
    left = vec(spark, *[({"i": str(i)}, 0, v) for i, v in enumerate([1, -1, 0, NAN, 7])])
    got = {r["series_key"]: r["value"] for r in op.scalar(left, "/", 0).collect()}
    assert got["i=0,"] == math.inf and got["i=1,"] == -math.inf
    assert math.isnan(got["i=2,"]) and math.isnan(got["i=3,"])
    negative = {r["series_key"]: r["value"] for r in op.scalar(left, "/", -0.0).collect()}
    assert negative["i=0,"] == -math.inf
    rest = {r["series_key"]: r["value"] for r in op.scalar(left, "%", 4).collect()}
    assert rest["i=4,"] == 3.0 and rest["i=1,"] == -1.0
    assert math.isnan({r["series_key"]: r["value"]
                       for r in op.scalar(left, "%", 0).collect()}["i=4,"])


def test_nan_compares_like_ieee(spark):
    v = vec(spark, ({"i": "0"}, 0, NAN), ({"i": "1"}, 0, 2))
    for sign, kept in {"==": 0, "!=": 2, "<": 0, ">": 0, ">=": 0}.items():
        assert op.scalar(v, sign, 5 if sign != "<" else 0).count() == kept


def test_matching_errors(spark):
    left = vec(spark, ({"a": "1", "b": "x"}, 0, 1), ({"a": "1", "b": "y"}, 0, 2))
    right = vec(spark, ({"a": "1"}, 0, 10))
    with pytest.raises(Exception, match="more than one series on the left side"):
        op.one_to_one(left, right, "+", on=["a"]).collect()
    assert rows(op.group_left(left, right, "+", on=["a"]), "series_key", "value") == [
        ("a=1,b=x,", 11.0), ("a=1,b=y,", 12.0)]
    with pytest.raises(Exception, match="more than one series on the right side"):
        op.group_left(right, left, "+", on=["a"]).collect()
    assert rows(op.group_right(right, left, "-", on=["a"]), "series_key", "value") == [
        ("a=1,b=x,", 9.0), ("a=1,b=y,", 8.0)]
    with pytest.raises(ValueError):
        op.one_to_one(left, right, "+", on=["a"], ignoring=["b"])
    with pytest.raises(ValueError):
        op.scalar(left, "+", 1, bool_result=True)
    with pytest.raises(ValueError):
        op.scalar(left, "=", 1)


def test_result_is_a_vector(spark):
    left = vec(spark, ({"a": "1", "b": "x"}, 0, 1))
    right = vec(spark, ({"a": "1", "b": "y"}, 0, 10))
    first = op.one_to_one(left, right, "+", on=["a"])
    assert rows(first, "series_key", "value") == [("a=1,", 11.0)]
    assert first.first()["tags"] == {"a": "1"}
    second = op.one_to_one(left, right, "+", ignoring=["b"])
    assert rows(op.one_to_one(first, second, "*"), "series_key", "value") == [("a=1,", 121.0)]


def test_include_takes_tags_of_the_one_side(spark):
    many = vec(spark, ({"a": "1", "b": "x", "z": "old"}, 0, 4))
    one = vec(spark, ({"a": "1", "z": "new"}, 0, 2))
    got = op.group_left(many, one, "/", on=["a"], include=["z"]).first()
    assert (got["series_key"], got["tags"], got["value"]) == \
        ("a=1,b=x,z=new,", {"a": "1", "b": "x", "z": "new"}, 2.0)


def test_set_operations_with_a_hot_key(spark):
    left = vec(spark, *[({"a": "hot", "i": str(i)}, 0, i) for i in range(300)],
               ({"a": "cold", "i": "0"}, 0, 1))
    right = vec(spark, *[({"a": "hot", "j": str(i)}, 0, i) for i in range(200)],
                ({"a": "warm", "j": "0"}, 0, 1), ({"a": "cold", "j": "0"}, 1, 1))
    assert op.vector_and(left, right, on=["a"]).count() == 300
    assert rows(op.vector_unless(left, right, on=["a"]), "series_key") == [("a=cold,i=0,",)]
    assert op.vector_or(left, right, on=["a"]).count() == 301 + 2
    assert op.vector_and(left, right).count() == 0


def test_matching_sends_no_side_through_the_driver(spark):
    many = vec(spark, *[({"a": str(i % 3), "b": str(i)}, 0, i) for i in range(30)])
    one = vec(spark, *[({"a": str(i), "z": "new"}, 0, 100) for i in range(3)])
    for made, n in ((op.group_right(one, many, "-", on=["a"], include=["z"]), 30),
                    (op.group_left(many, one, "-", on=["a"]), 30),
                    (op.vector_and(many, one, on=["a"]), 30),
                    (op.vector_unless(many, one.where("series_key < 'a=1'"), on=["a"]), 20)):
        assert len(made.collect()) == n
        # the plan as it ran: not even these few rows were broadcast
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_absent_equals_empty_in_on(spark):
    left, right = vec(spark, ({"a": "1"}, 0, 1)), vec(spark, ({"a": "2", "b": ""}, 0, 5))
    assert rows(op.one_to_one(left, right, "+", on=["b"]), "series_key", "value") == [("", 6.0)]


def test_aggregators_and_nan(spark):
    v = vec(spark, ({"a": "1", "i": "0"}, 0, NAN), ({"a": "1", "i": "1"}, 0, 3),
            ({"a": "1", "i": "2"}, 0, 5), ({"a": "2", "i": "0"}, 0, NAN))
    def by(fn):
        return {r["a"]: r["value"] for r in agg.aggregate(v, fn, by=["a"]).collect()}
    assert by("min")["1"] == 3.0 and by("max")["1"] == 5.0 and math.isnan(by("min")["2"])
    assert math.isnan(by("sum")["1"]) and math.isnan(by("avg")["1"]) and by("count")["1"] == 3.0
    with pytest.raises(ValueError):
        agg.aggregate(v, "median")
    top = agg.topk(v, 2, by=["a"]).collect()
    assert sorted((r["tags"]["i"], r["place"]) for r in top if r["tags"]["a"] == "1") == \
        [("1", 2), ("2", 1)]
    assert agg.topk(v, 2000, by=["a"]).count() == 4
    assert rows(agg.topk(v, 1500, without=["i"]), "place") == [(1,), (1,), (2,), (3,)]


@pytest.mark.parametrize("q", [0, 0.1, 0.25, 0.5, 0.9, 1])
@pytest.mark.parametrize("slices", [None, 9])
def test_quantile(spark, q, slices):
    import numpy as np
    numbers = [(i * 37 % 101) / 7 - 5 for i in range(120)] + [2.5] * 80 + [-1e9, 1e9, 0.0, 1e-12]
    v = vec(spark, *[({"a": "x", "i": str(i)}, 0, n) for i, n in enumerate(numbers)],
            ({"i": "alone"}, 0, 4))
    got = {r["a"]: r["value"] for r in agg.quantile(v, q, by=["a"], slices=slices).collect()}
    assert got["x"] == pytest.approx(np.quantile(numbers, q), rel=1e-12, abs=1e-12)
    assert got[None] == 4.0


def test_quantile_edges(spark):
    v = vec(spark, ({"i": "0"}, 0, NAN), ({"i": "1"}, 0, 1), ({"i": "2"}, 0, math.inf))
    def at(q):
        return agg.quantile(v, q).first()["value"]
    assert at(-1) == -math.inf and at(2) == math.inf
    assert math.isnan(at(0)) and at(0.5) == 1.0 and at(1) == math.inf


def test_hot_group_quantile_matches_brute_force(spark):
    values = [(i * i) % 997 / 10 for i in range(3000)]
    v = vec(spark, *[({"a": "hot" if i % 3 else "cold", "i": str(i)}, i % 2, x)
                     for i, x in enumerate(values)])
    import numpy as np
    got = agg.quantile(v, 0.3, by=["a"], slices=4).collect()
    assert len(got) == 4
    for r in got:
        step = (r["step_ts"] - T) // timedelta(minutes=1)
        mine = [x for i, x in enumerate(values) if i % 2 == step
                and ("hot" if i % 3 else "cold") == r["a"]]
        assert r["value"] == pytest.approx(np.quantile(mine, 0.3))


def test_dense_grid(spark):
    v = vec(spark, ({"a": "1"}, 0, 1), ({"a": "1"}, 2, 3), ({"a": "2"}, 3, NAN),
            ({"a": "2"}, 9, 1))
    cells = grid.dense_grid(v, T, T + timedelta(minutes=5), "2m").collect()
    assert len(cells) == 6
    found = {(r["series_key"], r["step_idx"]): r["value"] for r in cells}
    assert found[("a=1,", 0)] == 1.0 and found[("a=1,", 1)] == 3.0
    assert math.isnan(found[("a=1,", 2)]) and math.isnan(found[("a=2,", 1)])
    flags = grid.missing_series(grid.dense_grid(v, T, T + timedelta(minutes=5), "2m"))
    assert {r["series_key"]: r["all_nan"] for r in flags.collect()} == {"a=1,": False,
                                                                      "a=2,": True}
    assert grid.all_missing(v.limit(0)).first()["all_nan"] is True


def test_consolidate_takes_the_coarsest(spark):
    v = vec(spark, ({"a": "1"}, 0, 1), ({"a": "1"}, 5, 2), ({"a": "1"}, 11, 4))
    both = v.withColumn("namespace", F.when(F.col("value") < 2, "1m").otherwise("10m"))
    got = grid.consolidate(both, {"1m": "1m", "10m": "10m"}, "sum")
    assert rows(got, "step_ts", "value") == [(T, 3.0), (T + timedelta(minutes=10), 4.0)]
    assert grid.consolidate(both, {"1m": "1m"}, "sum").count() == 1
    with pytest.raises(ValueError):
        grid.consolidate(both, {"1m": "1m"}, "mode")
    with pytest.raises(ValueError):
        grid.consolidate(both, {}, "sum")
    merged = grid.consolidate_custom(
        both, {"1m": "1m", "10m": "10m"}, "sum", 100.0,
        lambda have, add, n: F.when(n == 0, add).otherwise((have * n + add) / (n + 1)))
    assert rows(merged, "step_ts", "value") == [(T, 1.5), (T + timedelta(minutes=10), 4.0)]


def test_dense_grid_longer_than_a_run(spark):
    v = vec(spark, ({"a": "1"}, 0, 1), ({"a": "2"}, 0, 1))
    made = grid.dense_grid(v, T, T + timedelta(seconds=25_001), "1s")
    found = made.groupBy("series_key").agg(F.count_distinct("step_idx"), F.max("step_idx"),
                                           F.count(F.lit(1))).collect()
    assert sorted(map(tuple, found)) == [("a=1,", 25_001, 25_000, 25_001),
                                         ("a=2,", 25_001, 25_000, 25_001)]


def test_namespaces_are_folded_one_by_one(spark):
    v = vec(spark, ({"a": "1"}, 0, 1), ({"a": "1"}, 1, 3), ({"a": "1"}, 2, 4))
    both = v.withColumn("namespace", F.when(F.col("value") < 4, "fine").otherwise("hourly"))
    names = {"fine": "1m", "hourly": "10m"}

    def value(fn, frame=both, **kind):
        return grid.consolidate(frame, names, fn, **kind).first()["value"]
    assert value("avg") == 3.0 and value("avg", flat=True) == 8 / 3
    assert value("count") == 2.0 and value("count", flat=True) == 3.0
    assert (value("min"), value("max"), value("last")) == (1.0, 4.0, 4.0)
    assert value("last", both.where("namespace = 'fine'")) == 3.0
    nan = both.withColumn("value", F.when(F.col("namespace") == "fine", F.lit(float("nan")))
                          .otherwise(F.col("value")))
    assert value("max", nan) == 4.0 and math.isnan(value("sum", nan))


def test_unsorted_write_regrids_in_time_order(spark):
    v = vec(spark, ({"foo": "bar"}, 10, 1), ({"foo": "bar"}, 0, 2))
    got = grid.regrid(v, T, "1m")
    assert rows(got, "step_idx", "value", "step_ts") == [
        (0, 2.0, T), (1, 1.0, T + timedelta(minutes=1))]


def test_nested_parts(spark):
    v = vec(spark, *[({"a": "1", "b": "2"}, i, i) for i in range(7)])
    nested = nest_series(grid.regrid(v, T, "1s", block="2m"), part_samples=3).collect()
    assert [len(r["samples"]) for r in sorted(nested, key=lambda r: r["part"])] == [3, 3, 1]
    assert [(l["name"], l["value"]) for l in nested[0]["labels"]] == [("a", "1"), ("b", "2")]
    stamps = [s["timestamp"] for r in sorted(nested, key=lambda r: r["part"])
              for s in r["samples"]]
    assert stamps == [1704067200000 + 1000 * i for i in range(7)]


@pytest.mark.parametrize("slices", [None, 4])
def test_batches_flush_the_rest(spark, slices):
    requests = spark.range(11).selectExpr(
        "id", "array(struct('i' as name, cast(id as string) as value)) labels",
        "array(struct(cast(id as double) as value, id as timestamp)) samples").repartition(3)
    made = batches(requests, 4, ["id"], F.floor(F.col("id") / 2), slices=slices).collect()
    made.sort(key=lambda r: r["batch_id"])
    assert [r["n_series"] for r in made] == [4, 4, 3]
    assert [int(t["labels"][0]["value"]) for r in made for t in r["timeseries"]] == list(range(11))
    with pytest.raises(ValueError):
        batches(requests, 0, ["id"], F.col("id"))


def test_duplicate_match_fails_without_its_value(spark):
    left = vec(spark, ({"a": "1", "b": "1"}, 0, 1), ({"a": "1", "b": "2"}, 0, 2))
    right = vec(spark, ({"a": "1"}, 0, 3))
    for make in (lambda: op.one_to_one(left, right, "+", on=["a"]).count(),
                 lambda: op.one_to_one(left, right, "+", on=["a"]).select("series_key").collect(),
                 lambda: op.group_left(right, left, "+", on=["a"]).count()):
        with pytest.raises(Exception, match="more than one series"):
            make()


def test_number_on_the_left_and_names(spark):
    v = vec(spark, ({"i": "1"}, 0, 4), ({"i": "2"}, 0, 8)).withColumn("name", F.lit("m"))
    assert rows(op.scalar_left(100, "-", v), "name", "value") == [("", 92.0), ("", 96.0)]
    assert rows(op.scalar_left(1, "/", v), "value") == [(0.125,), (0.25,)]
    assert rows(op.scalar_left(5, "<", v), "name", "value") == [("m", 8.0)]
    assert rows(op.scalar_left(5, "<", v, bool_result=True), "name", "value") == [("", 0.0), ("", 1.0)]
    assert rows(op.one_to_one(v, v, ">=", on=["i"]), "name", "value") == [("m", 4.0), ("m", 8.0)]
    assert rows(op.one_to_one(v, v, "+", on=["i"]), "name", "value") == [("", 16.0), ("", 8.0)]
