from datetime import datetime, timedelta

import pytest
from tidegrid.operators import blocks as op

T = datetime(2024, 1, 1)
COLUMNS = ("namespace string, name string, series_key string, block_start timestamp_ntz, "
           "block_end timestamp_ntz, n_points bigint, value_sum double")


def block(series, i, namespace="ns", end=None, start=None):
    start = start if start is not None else 10 * i
    end = end if end is not None else start + 10
    return (namespace, "", series, T + timedelta(minutes=start), T + timedelta(minutes=end), 1, 1.0)


def frame(spark, *rows):
    return op.index_blocks(spark.createDataFrame(list(rows), COLUMNS))


def two(namespace="ns"):
    return [block(s, i, namespace) for s in ("test_one", "test_two") for i in (0, 1)]


def test_time_major(spark):
    rows = op.by_time(frame(spark, *two()), strict=True).collect()
    assert [(r["block_idx"], r["block_start"], r["series_key"]) for r in sorted(
        rows, key=lambda r: (r["block_idx"], r["series_key"]))] == [
        (i, T + timedelta(minutes=10 * i), s) for i in (0, 1) for s in ("test_one", "test_two")]
    assert op.block_summary(frame(spark, *two())).count() == 2


def test_two_namespaces(spark):
    merged = op.merge_namespaces(frame(spark, *two("a"), *two("b")), strict=True)
    assert {(r["series_key"], r["block_idx"], len(r["parts"])) for r in merged.collect()} == {
        (s, i, 2) for s in ("test_one", "test_two") for i in (0, 1)}
    assert op.by_time(merged, strict=True).count() == 4


def test_misaligned(spark):
    bad = frame(spark, block("test_one", 0, end=100), *two()[1:])
    assert [r["block_idx"] for r in op.misaligned_blocks(bad).collect()] == [0]
    with pytest.raises(Exception, match=op.MISALIGNED):
        op.by_time(bad).count()
    with pytest.raises(Exception, match=op.MISALIGNED):
        op.by_time(bad).select("series_key").collect()
    assert op.by_time(bad, strict=False).count() == 4


def test_later_series_longer(spark):
    bad = frame(spark, *two(), block("test_two", 2))
    assert [(r["block_idx"], r["missing_in_first"]) for r in
            op.misaligned_blocks(bad).collect()] == [(2, True)]
    shorter = frame(spark, *two(), block("test_one", 2))
    assert op.misaligned_blocks(shorter).isEmpty()


def test_namespace_misaligned(spark):
    bad = frame(spark, *two("a"), block("test_one", 0, "b", start=5), block("test_one", 1, "b"))
    with pytest.raises(Exception, match=op.MISALIGNED):
        op.merge_namespaces(bad).count()
    with pytest.raises(Exception, match=op.MISALIGNED):
        op.merge_namespaces(bad).select("series_key").collect()
    lenient = op.merge_namespaces(bad, strict=False).where("misaligned").collect()
    assert [(r["series_key"], r["block_idx"]) for r in lenient] == [("test_one", 0)]


def test_common_tags(spark):
    rows = [("ns", "", f"k{i}", {"dc": "x", "host": str(i)} if i else {"host": "0", "dc": "x"},
             T + timedelta(hours=h), 1.0) for i in range(3) for h in (0, 30)]
    rows.append(("ns", "", "k9", {"host": "9"}, T + timedelta(hours=30), 1.0))
    points = spark.createDataFrame(rows, "namespace string, name string, series_key string, "
                                         "tags map<string,string>, ts timestamp_ntz, value double")
    got = op.common_tags(points, "24h").collect()
    assert [(r["block_start"], r["tag"], r["tag_value"], r["n_series"]) for r in got] == \
        [(T, "dc", "x", 3)]


def test_window_bounds(spark):
    points = spark.createDataFrame([(T + timedelta(minutes=7),)], "ts timestamp_ntz")
    row = op.with_block(points, "5m").first()
    assert (row["block_start"], row["block_end"]) == (T + timedelta(minutes=5),
                                                      T + timedelta(minutes=10))
