"""Pattern dialect against RE2 itself, through DuckDB."""

import duckdb
from pyspark.sql import functions as F

from tidegrid.functions.matchers import re_match

PATTERNS = [
    "a", "a|b", "ab|cd|", "a.*", ".*b", "a.c", "a.+c", "[abc]+", "[^abc]+", "[a-z]{2,3}",
    "a{0}", "a{2}", "a{1,}", "(ab)+", "(?:ab)*c", "(?i)abc", "(?i:ab)c", "(?s)a.b", "(?s:.)+",
    "(?m)a$", "(?m)^a$\n^b$", "a$", "^a", "^$", r"\d+", r"\D+", r"\w+", r"\W+", r"\s+", r"\S+",
    r"[\d\s]+", r"[^\d]+", r"[\w.-]+", r"\ba\b", r"a\b.*", r"a\Bb", r"\x41+", r"\x{e9}", r"\t",
    r"\n", r"\v", r"\f\r", r"\a", r"\.", r"\*\+\?", r"\[\]", r"[\]]", "[]a]+", "[^]a]+", "[a-]+",
    "[-a]+", "[.*+?]+", "[a^]+", "[[]", "[a&&b]+", "[&]+", "[[:alpha:]]+", "[[:^alpha:]]+",
    "[[:digit:][:space:]]+", "[[:word:]]+", "[^[:punct:]]+", "[[:xdigit:]]+", r"\pL+",
    r"\p{Lu}+", r"\P{L}+", r"\p{Greek}+", r"\p{^Greek}+", r"[\p{L}\d]+", r"\Qa.b\E", r"\Qa.b",
    r"\Qa\Eb+", "(?P<n>a)b", "(a|b)*?c", "a??b", "a+?", "a{1,2}?b", "(?U)a+b", "a{", "a{,2}",
    "a{x}", "{", "}", "]", "x*", "(|a)+", "((a)|(b))+", r"\Aab\z", "é", "é+", "日本", ".", "..",
    "[é-ü]", "#a", "a b", "a  # c", "(?i)é", r"\/", r"\-", r"[\-\]]+", "'", '"', "[\t ]+",
]
VALUES = [
    "", "a", "b", "ab", "abc", "ABC", "aab", "aaab", "cd", "a\n", "\n", "a\nb", "a\rb", "a b",
    "a  # c", "#a", "1", "12 3", "a1_b", "a.b", "axb", "a-b", "a.c", "a☺c", "☺", "é", "É", "éé",
    "ü", "α", "Ω", "日本", " ", "\t", "\v", "\f\r", "\a", "\x85", " ", "[", "]", "[]", "{",
    "}", "a{", "a{,2}", "a{x}", "&", "a&b", "^", "a^", "-", "a-", ".", "*+?", "AAA", "A", "٣",
    "!?", "DEADbeef", "/", "'", '"', "-]", "x", "xx", "abab", "ababc", "c", "ac", "\\",
]
INVALID = ["(?=a)", "(?!a)", "(?<=a)b", "(?<!a)b", "(?>a)", r"(a)\1", "a++", "a**", r"\Z", r"\h",
           "[a", r"\G", "a*+", "[[:nope:]]"]


def test_same_as_re2(spark):
    con = duckdb.connect()
    values = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    tests = [re_match("t", p).condition(F.col("v")).alias(f"p{n}") for n, p in enumerate(PATTERNS)]
    ours = {r["i"]: r for r in values.select("i", *tests).collect()}
    wrong = []
    for n, pattern in enumerate(PATTERNS):
        for i, value in enumerate(VALUES):
            theirs = con.execute("SELECT regexp_full_match(?, ?)", [value, pattern]).fetchall()[0][0]
            if bool(ours[i][f"p{n}"]) != theirs:
                wrong.append((pattern, value, theirs))
    assert wrong == []


def test_refused_by_both():
    con = duckdb.connect()
    for pattern in INVALID:
        for attempt in (lambda: con.execute("SELECT regexp_full_match('a', ?)", [pattern]).fetchall(),
                        lambda: re_match("t", pattern)):
            try:
                attempt()
            except (duckdb.Error, ValueError):
                continue
            raise AssertionError(f"{pattern} was taken")
