import pytest
from pyspark.sql import functions as F

from tidegrid.functions import matchers as m
from tidegrid.functions.patterns import to_java

TRUTH = [
    ("=", "bar", "bar", True), ("=", "bar", "foo-bar", False),
    ("!=", "bar", "bar", False), ("!=", "bar", "foo-bar", True),
    ("=~", "bar", "bar", True), ("=~", "bar", "foo-bar", False), ("=~", ".*bar", "foo-bar", True),
    ("!~", "bar", "bar", False), ("!~", "bar", "foo-bar", True), ("!~", ".*bar", "foo-bar", False),
]


def check(spark, matcher, value):
    tag = F.col("tag")
    row = spark.createDataFrame([(value,)], "tag string").select(
        F.coalesce(matcher.condition(tag), F.lit(False)).alias("hit")).first()
    return row["hit"]


@pytest.mark.parametrize("kind,pattern,value,expected", TRUTH)
def test_truth_table(spark, kind, pattern, value, expected):
    assert check(spark, m.Matcher(kind, "t", pattern), value) is expected


def test_absent_tag(spark):
    hits = {kind: check(spark, m.Matcher(kind, "t", "x"), None) for kind in ("=", "!=", "=~", "!~")}
    assert hits == {"=": False, "!=": True, "=~": False, "!~": True}


@pytest.mark.parametrize("pattern,value,expected", [
    ("bar", "bar\n", False), ("bar$", "bar\n", False), ("b.*", "b\nx", False),
    ("(?s)b.*", "b\nx", True), ("b.*", "b\rx", True), ("fo.*", "foo", True),
    ("fo.*", "fo\nx", False), ("a|b c|d-e", "b c", True), ("a|b", "ab", False), ("", "", True),
    ("", "x", False), ("(?i)ABC", "abc", True), (r"\Qa.b\E", "a.b", True),
    (r"\Qa.b\E", "axb", False), ("[[:alpha:]]+", "abc", True), ("[[:alpha:]]+", "a1", False),
    ("[^[:digit:]]", "a", True), ("[a[b]", "[", True), ("[a&&b]+", "&", True),
    ("[]a]+", "]a", True), (r"[\s]", "\v", False), (r"\s", "\t", True), (r"\v", "\v", True),
    ("(?P<x>a)b", "ab", True), ("a{", "a{", True), ("a{2}", "aa", True), ("a{2,}?", "aaa", True),
    (r"\pL+", "é", True), (r"\p{Greek}", "α", True), (r"\x{263A}", "☺", True),
    ("(?U)a+", "aaa", True), ("a.c", "a☺c", True), (r"\d", "٣", False),
])
def test_dialect(spark, pattern, value, expected):
    assert check(spark, m.re_match("t", pattern), value) is expected
    assert check(spark, m.re_not("t", pattern), value) is not expected


@pytest.mark.parametrize("pattern", ["(?=a)", "(?!a)", "(?<=a)b", "(?<!a)b", "(?>a)", r"(a)\1",
                                     "a++", "a**", r"\Z", r"\h", "[a", "a\\", r"\G"])
def test_refused(pattern):
    with pytest.raises(ValueError):
        m.re_match("t", pattern)


def test_anchors():
    assert to_java("a|b") == r"\A(?du:a|b)\z"


def test_text():
    assert str(m.re_not("job", 'a"b')) == r'job!~"a\"b"'


def test_wire_codes():
    assert [x.type.value for x in m.from_wire([(i, "n", "v") for i in range(4)])] == \
        ["=", "!=", "=~", "!~"]
    with pytest.raises(ValueError):
        m.match_type_of(4)


def test_to_tags():
    assert m.to_tags([m.eq("a", "1"), m.eq("b", "2"), m.eq("a", "3")]) == {"a": "3", "b": "2"}
    with pytest.raises(ValueError):
        m.to_tags([m.eq("a", "1"), m.neq("b", "2")])


def test_pushdown(spark, sf_dir, capsys):
    from tidegrid.operators.fetch import fetch
    from tidegrid.sources.points import events_points
    found = fetch(events_points(spark, sf_dir),
                  [m.eq("event_type", "click"), m.re_match("event_type", "click|view")],
                  "2024-01-05", "2024-01-06").select("ts", "value")
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(event_type,click)" in plan and "In(event_type, [click,view])" in plan
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
