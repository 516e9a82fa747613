"""The inverted tag index against the truth table of matchers, on odd tags, and by its plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.matchers import Matcher, MatchType, eq, neq, re_match, re_not
from tidegrid.operators import fetch as op
from tidegrid.sources import tag_index
from tidegrid.sources.tag_index import TagIndex, write_tag_index

SCHEMA = "namespace string, name string, series_key string, tags map<string,string>"


def holds(m, tags):
    value = tags.get(m.name)
    if m.type in (MatchType.EQUAL, MatchType.NOT_EQUAL):
        same = value is not None and value == m.value
    else:
        same = value is not None and re.fullmatch(m.value, value, re.S) is not None
    return same if m.type in (MatchType.EQUAL, MatchType.REGEXP) else not same


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    dice = random.Random(5)
    rows = []
    for i in range(3000):
        tags = {"host": f"h{i}", "zone": dice.choice("abc"), "role": "hot" if i % 3 else "cold"}
        if i % 7 == 0:
            tags.pop("zone")
        if i % 11 == 0:
            tags["note"] = "" if i % 2 else "x\ny"
        if i % 13 == 0:
            tags["null"] = None
        rows.append(("default" if i % 2 else "day", "cpu" if i % 5 else "mem", f"k{i}", tags))
    path = str(tmp_path_factory.mktemp("index"))
    write_tag_index(spark.createDataFrame(rows, SCHEMA).repartition(7), f"{path}/i")
    return TagIndex(spark, f"{path}/i"), rows, path


CASES = [
    [], [eq("zone", "a")], [neq("zone", "a")], [re_match("host", "h1.*9")], [re_not("host", "h[0-8].*")],
    [eq("role", "hot"), neq("zone", "b"), re_not("host", ".*7")], [eq("absent", "x")],
    [neq("absent", "x")], [re_match("absent", ".*")], [re_not("absent", ".*")],
    [eq("note", "")], [re_match("note", ".*")], [re_not("note", "x.*")], [eq("null", "x")],
    [neq("null", "x"), eq("role", "cold")], [eq("zone", "a"), eq("zone", "b")],
    [eq("zone", "a"), re_match("zone", "a|c"), neq("zone", "c")], [re_match("zone", "no such")],
]


@pytest.mark.parametrize("matchers", CASES, ids=lambda ms: ",".join(map(str, ms)) or "all")
def test_truth_table(stored, matchers):
    index, rows, _ = stored
    got = sorted(r.series_key for r in index.search(matchers).collect())
    want = []
    for _, _, key, tags in rows:
        # a pattern's dot does not match a line end
        if all(holds(m, tags) if not (m.name == "note" and "\n" in (tags.get("note") or ""))
               else (m.type in (MatchType.NOT_REGEXP, MatchType.NOT_EQUAL)) for m in matchers):
            want.append(key)
    assert got == sorted(want)


def test_name_and_values(stored):
    index, rows, _ = stored
    got = index.search([eq("zone", "c")], name="mem").collect()
    assert sorted(r.series_key for r in got) == sorted(
        k for _, n, k, t in rows if n == "mem" and t.get("zone") == "c")
    assert all(r.tags["zone"] == "c" for r in got) and got[0].tags["role"] in ("hot", "cold")
    values = {r.value: r.n for r in index.tag_values("zone").collect()}
    assert values == {z: sum(t.get("zone") == z for *_, t in rows) for z in "abc"}
    assert {r.value for r in index.tag_values("host", re_match("host", "h2.")).collect()} == {
        f"h2{i}" for i in range(10)}


def test_same_as_a_scan(spark, sf_dir, tmp_path):
    from tidegrid.sources.points import events_points
    points = events_points(spark, sf_dir)
    index = write_tag_index(op.series_of(points), str(tmp_path / "i"))
    for matchers in ([re_match("user_id", "1.*"), neq("event_type", "click")],
                     [Matcher(MatchType.NOT_REGEXP, "event_type", "c.*|view")]):
        want = op.fetch(points, matchers, "2024-01-05", "2024-01-20").select("event_id").collect()
        got = index.fetch(points, matchers, "2024-01-05", "2024-01-20").select("event_id").collect()
        assert sorted(got) == sorted(want) and got
    few = index.fetch(points, [], "2024-01-01", "2024-02-01", limit=3)
    assert few.select("series_key").distinct().count() == 3


def test_matching_reads_no_series(stored):
    index, _, path = stored
    plan = index.numbers([re_match("host", "h1.*"), neq("zone", "a")])._jdf.queryExecution() \
        .optimizedPlan().toString()
    files = set(index.numbers([re_match("host", "h1.*"), neq("zone", "a")]).inputFiles())
    assert files and not any("/series/" in f or "/held/" in f for f in files)
    assert "tags" not in plan


def test_rare_values_are_lists_and_others_bitmaps(stored):
    index, _, _ = stored
    held = {(r.tag, r.value): r for r in index.values.where("field = 'tag'").collect()}
    assert held["host", "h5"].members and held["role", "hot"].members is None
    kept = index.postings.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.tag for r in kept} <= {"zone", "role", "note", ""}
    assert all(len(r.bits) == tag_index.BUCKET_BITS // 8 for r in index.postings.take(3))


def test_no_series(spark, tmp_path):
    index = write_tag_index(spark.createDataFrame([], SCHEMA), str(tmp_path / "i"))
    assert index.search([eq("a", "b")]).count() == 0 and index.search().count() == 0
