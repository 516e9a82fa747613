"""Tag matchers: Python values that become one filter column."""

from __future__ import annotations

import enum
import functools
import json
import operator
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.functions.patterns import to_java


class MatchType(enum.Enum):
    EQUAL = "="
    NOT_EQUAL = "!="
    REGEXP = "=~"
    NOT_REGEXP = "!~"

    def __str__(self) -> str:
        return self.value


# Match-type codes of read requests.
WIRE_CODES = {
    0: MatchType.EQUAL,
    1: MatchType.NOT_EQUAL,
    2: MatchType.REGEXP,
    3: MatchType.NOT_REGEXP,
}

_WORDS = re.compile(r"[\w\- ]+(?:\|[\w\- ]+)*", re.ASCII)
_PREFIX = re.compile(r"([\w\- ]+)\.\*", re.ASCII)


def match_type_of(code: int) -> MatchType:
    """The match type of a wire code; an unknown code is an error."""
    if code not in WIRE_CODES:
        raise ValueError(f"no match type has code {code}")
    return WIRE_CODES[code]


@dataclass(frozen=True)
class Matcher:
    type: MatchType
    name: str
    value: str

    def __post_init__(self) -> None:
        object.__setattr__(self, "type", MatchType(self.type))
        if self.type in (MatchType.REGEXP, MatchType.NOT_REGEXP):
            to_java(self.value)

    def __str__(self) -> str:
        return f"{self.name}{self.type}{json.dumps(self.value, ensure_ascii=False)}"

    def condition(self, tag: Column) -> Column:
        """The test on one tag value.  An absent (null) tag fails ``=`` and ``=~`` and
        passes ``!=`` and ``!~``.  Written so that parquet can take the plain parts."""
        if self.type is MatchType.EQUAL:
            return tag == self.value
        if self.type is MatchType.NOT_EQUAL:
            return tag.isNull() | (tag != self.value)
        if self.type is MatchType.REGEXP:
            return _full_match(tag, self.value)
        return tag.isNull() | ~_full_match(tag, self.value)


def _full_match(tag: Column, pattern: str) -> Column:
    # an alternation of plain words, or a plain prefix, reaches the scan as a simple filter
    if _WORDS.fullmatch(pattern):
        return tag.isin(pattern.split("|"))
    if prefix := _PREFIX.fullmatch(pattern):
        return tag.startswith(prefix[1]) & ~tag.contains("\n")
    return tag.rlike(to_java(pattern))


def eq(name: str, value: str) -> Matcher:
    return Matcher(MatchType.EQUAL, name, value)


def neq(name: str, value: str) -> Matcher:
    return Matcher(MatchType.NOT_EQUAL, name, value)


def re_match(name: str, value: str) -> Matcher:
    return Matcher(MatchType.REGEXP, name, value)


def re_not(name: str, value: str) -> Matcher:
    return Matcher(MatchType.NOT_REGEXP, name, value)


def from_wire(items: Iterable[tuple[int, str, str]]) -> list[Matcher]:
    """Matchers of a read request: (code, name, value)."""
    return [Matcher(match_type_of(code), name, value) for code, name, value in items]


def tag_column(name: str, columns: Iterable[str] = ()) -> Column:
    """The value of a tag: a promoted ``tag_<name>`` column if the table has one (it can be
    pruned and pushed down in any layout), else the map element."""
    promoted = f"tag_{name}"
    return F.col(f"`{promoted}`") if promoted in columns else F.col("tags")[name]


def all_of(matchers: Iterable[Matcher], columns: Iterable[str] = ()) -> Column:
    """Conjunction of the matchers; no matchers means every series."""
    columns = list(columns)
    tests = [m.condition(tag_column(m.name, columns)) for m in matchers]
    return functools.reduce(operator.and_, tests) if tests else F.lit(True)


def to_tags(matchers: Iterable[Matcher]) -> dict[str, str]:
    """Equality matchers as a tag map; any other type is an error."""
    tags = {}
    for m in matchers:
        if m.type is not MatchType.EQUAL:
            raise ValueError(f"{m} is no equality, so it names no tag value")
        tags[m.name] = m.value
    return tags
