"""Matcher patterns are RE2 text; Spark runs Java patterns.  Where the two spell a thing
differently the Java spelling is used, and what RE2 lacks is refused."""

from __future__ import annotations

import functools
import re

_PIECE = re.compile(
    r"\\Q.*?(?:\\E|$)|\\[pP]\{\^?\w+\}|\\x\{[0-9A-Fa-f]+\}|\\.|\[:\^?[a-z]+:\]"
    r"|\(\?P?<\w+>|\(\?[a-zA-Z^-]*[:)]|\(\?P?.?[=!>]?|\{\d+(?:,\d*)?\}|.", re.S)

# Escapes with a letter or digit that RE2 knows and Java spells alike.
_SHARED_ESCAPES = set("aftnrx0123456789ABbzdDwW")
# Named classes and their Java names.
_NAMED_CLASSES = {
    "alnum": "Alnum", "alpha": "Alpha", "ascii": "ASCII", "blank": "Blank",
    "cntrl": "Cntrl", "digit": "Digit", "graph": "Graph", "lower": "Lower",
    "print": "Print", "punct": "Punct", "space": "Space", "upper": "Upper",
    "xdigit": "XDigit",
}
_REPEATS = ("*", "+", "?")


def _escape(piece: str, in_class: bool) -> str:
    letter = piece[1]
    if letter == "s":
        return r"\t\n\f\r " if in_class else r"[\t\n\f\r ]"
    if letter == "S":
        return r"[^\t\n\f\r ]"
    if letter == "v":
        return r"\x0B"
    if letter in "pP":
        name = piece[3:-1] if len(piece) > 2 else ""
        if name.startswith("^"):
            letter, name = ("P" if letter == "p" else "p"), name[1:]
        if len(name) > 2:
            name = "Is" + name
        return rf"\{letter}{{{name}}}" if name else piece
    if letter.isdigit() and (letter != "0" and not in_class):
        raise ValueError("back-references are not supported")
    if letter.isalnum() and letter not in _SHARED_ESCAPES:
        raise ValueError(f"escape {piece} is not supported")
    return piece


@functools.lru_cache(maxsize=1024)
def to_java(pattern: str) -> str:
    """An anchored Java pattern that accepts what ``^(?:pattern)$`` accepts in RE2."""
    out: list[str] = []
    in_class = False
    multi_line = bool(re.search(r"\(\?[a-zA-Z]*m", pattern))
    previous = ""
    for match in _PIECE.finditer(pattern):
        piece = match.group()
        repeat = piece in _REPEATS or bool(re.fullmatch(r"\{\d+(?:,\d*)?\}", piece))
        if piece.startswith(r"\Q"):
            piece = re.escape(piece[2:].removesuffix(r"\E"))
        elif piece.startswith("\\"):
            if len(piece) == 1:
                raise ValueError("trailing backslash")
            piece = _escape(piece, in_class)
        elif in_class:
            if piece.startswith("[:") and piece.endswith(":]") and len(piece) > 3:
                name = piece[2:-2]
                negated = name.startswith("^")
                name = name.removeprefix("^")
                if name == "word":
                    piece = r"\W" if negated else r"\w"
                elif name in _NAMED_CLASSES:
                    piece = rf"\{'P' if negated else 'p'}{{{_NAMED_CLASSES[name]}}}"
                else:
                    raise ValueError(f"unknown class {name}")
            elif piece == "]" and previous not in ("[", "[^"):
                in_class = False
            elif piece == "^" and previous == "[":
                out.append(piece)
                previous = "[^"
                continue
            else:
                # Java reads [ and && inside a class, and a run of other pieces may hold them
                piece = re.sub(r"([\[&\]])", r"\\\1", piece)
        elif piece == "[" or piece.startswith("[:"):
            in_class = True
            out.append("[")
            previous = "["
            if len(piece) > 1:
                raise ValueError("named class outside brackets")
            continue
        elif piece.startswith("(?"):
            if piece.startswith("(?P<"):
                piece = "(?<" + piece[4:]
            elif not re.fullmatch(r"\(\?(?:<\w+>|[imsU]*(?:-[imsU]+)?[:)])", piece):
                raise ValueError(f"group {piece} is not supported")
            else:
                # greediness cannot change a full match
                piece = re.sub(r"(?<=\?)[imsU-]+", lambda f: f.group().replace("U", ""), piece)
                piece = piece.replace("-:", ":").replace("-)", ")")
                piece = "" if piece == "(?)" else piece
        elif piece == "{" :
            piece = r"\{"
        elif piece == "$" and not multi_line:
            piece = r"\z"
        elif repeat and previous == "repeat" and piece != "?":
            raise ValueError("repeated repeat operator")
        out.append(piece)
        previous = "repeat" if repeat and not in_class else piece
    if in_class:
        raise ValueError("missing closing ]")
    # d: only \n ends a line; u: case is Unicode's
    return rf"\A(?du:{''.join(out)})\z"
