"""Random lines against a plain Python statement of the JVM's string rules."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from partwise.functions.text import BLANKS
from partwise.operators import graph, logs


def jvm_split(text, delimiter):
    """Split that forgets trailing empty parts, and leaves a text without the delimiter whole."""
    if delimiter not in text:
        return [text]
    parts = text.split(delimiter)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def names_of(text):
    return [name.strip(BLANKS) for name in jvm_split(text, ",")]


def log_outcome(line):
    line = line.strip(BLANKS)
    if line == "" or line.startswith("#"):
        return "skipped", None
    fields = jvm_split(line, "|")
    if len(fields) < 4:
        return "malformed", None
    status = fields[3].strip(BLANKS)
    if not re.fullmatch("[+-]?[0-9]+", status) or not -(2**31) <= int(status) < 2**31:
        return "invalid_code", status
    return ("error" if int(status) >= 400 else "ok"), status


def tab_line(line):
    line = line.strip(BLANKS)
    if line == "" or line.startswith("#") or "\t" not in line:
        return None
    user, listed = line.split("\t", 1)
    return user.strip(BLANKS), names_of(listed.strip(BLANKS))


def arrow_line(line):
    parts = jvm_split(line, " -> ")
    return (parts[0].strip(BLANKS), names_of(parts[1])) if len(parts) == 2 else None


def random_lines(seed, pieces):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randrange(0, 14))) for _ in range(3000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_log_lines(lines, seed):
    pieces = ["|", "|", "|", " ", "\t", "\x00", "#", "4", "04", "404", "200", "+", "-", "9999999999", "a", ".", "é"]
    texts = random_lines(seed, pieces)
    df = lines(*texts)
    parsed = logs.parse_log(df).select("outcome", "status").collect()
    for text, row in zip(texts, parsed, strict=True):
        outcome, status = log_outcome(text)
        assert row.outcome == outcome, text
        if status is not None:
            assert row.status == status, text
    wanted = Counter(log_outcome(text)[1] for text in texts if log_outcome(text)[0] == "error")
    assert {r.status: r.n for r in logs.error_counts(df).collect()} == wanted
    split = [jvm_split(text, "|") for text in texts]
    wanted = Counter(fields[3].strip(BLANKS) for fields in split if len(fields) >= 4)
    assert {r.status: r.n for r in logs.status_counts(df).collect()} == wanted


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    ("parse", "model", "delimiter"),
    [(graph.parse_tab_lines, tab_line, "\t"), (graph.parse_arrow_lines, arrow_line, " -> ")],
)
def test_friend_lines(lines, seed, parse, model, delimiter):
    pieces = [",", ",", " ", "\t", "\x0b", "#", "a", "b", "é", "->", " -", "> ", delimiter, delimiter]
    texts = random_lines(seed, pieces)
    wanted = [model(text) for text in texts]
    found = [(r.user, r.friends) for r in parse(lines(*texts)).collect()]
    assert found == [record for record in wanted if record is not None]
