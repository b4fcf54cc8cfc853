"""Access log operators on small fixtures and edge cases."""

from __future__ import annotations

import pytest

from partwise.operators import logs

# The small inputs whose results are known.
SPACED = """\
2024-01-15 | 192.168.1.10 | /index.html | 200 | 2048
2024-01-15 | 10.0.0.5     | /api/users  | 404 | 512
2024-01-15 | 172.16.0.3   | /login      | 500 | 256
2024-01-15 | 192.168.1.20 | /images/bg  | 404 | 0
2024-01-15 | 10.0.0.7     | /api/data   | 200 | 4096
2024-01-15 | 192.168.2.1  | /admin      | 403 | 128
2024-01-15 | 10.0.0.5     | /api/delete | 404 | 512
2024-01-15 | 172.16.0.3   | /upload     | 500 | 0
2024-01-15 | 192.168.1.10 | /css/style  | 200 | 8192
2024-01-15 | 10.0.0.9     | /page404    | 404 | 256
2024-01-16 | 192.168.3.1  | /api/login  | 401 | 64
2024-01-16 | 10.0.0.5     | /restricted | 403 | 0
2024-01-16 | 172.16.0.5   | /crash      | 500 | 0""".split("\n")

TIGHT = """\
DATE|IP|URL|STATUS|SIZE
2024-01-01|192.168.1.1|/home|200|1024
2024-01-01|192.168.1.2|/login|404|512
2024-01-01|192.168.1.3|/admin|500|256
2024-01-01|192.168.1.1|/home|404|2048
2024-01-01|192.168.1.4|/api|403|128""".split("\n")


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}


def test_error_counts(lines):
    assert as_dict(logs.error_counts(lines(*SPACED))) == {"401": 1, "403": 2, "404": 4, "500": 3}


def test_error_threshold(lines):
    assert as_dict(logs.error_counts(lines(*SPACED), threshold=500)) == {"500": 3}


def test_line_outcomes(lines):
    assert as_dict(logs.line_outcomes(lines(*SPACED))) == {"error": 10, "ok": 3}


def test_status_counts_keep_the_header(lines):
    counts = as_dict(logs.status_counts(lines(*TIGHT)))
    assert counts == {"200": 1, "403": 1, "404": 2, "500": 1, "STATUS": 1}


@pytest.mark.parametrize(
    ("line", "outcome", "status", "untrimmed"),
    [
        ("", "skipped", None, None),
        (" \t\x0b ", "skipped", None, None),
        ("  # a|b|c|404|1", "skipped", "404", "404"),
        ("a|b|c", "malformed", None, None),
        ("a|b|c||||", "malformed", None, None),
        ("||||", "malformed", None, None),
        ("d | i | /x || ", "malformed", None, ""),
        ("d | i | /x |  |", "invalid_code", "", ""),
        ("d|i|/x|n/a|5", "invalid_code", "n/a", "n/a"),
        ("a|b|c|404", "error", "404", "404"),
        ("a|b|c|\t404\x00\t|", "error", "404", "404"),
        ("\x1fa|b|c|0404|1", "error", "0404", "0404"),
        ("a|b|c|+404|1", "error", "+404", "+404"),
        ("a|b|c|-404|1", "ok", "-404", "-404"),
        ("a|b|c|399|1", "ok", "399", "399"),
        ("a|b|c|400|1", "error", "400", "400"),
        ("a|b|c|2147483647|1", "error", "2147483647", "2147483647"),
        ("a|b|c|2147483648|1", "invalid_code", "2147483648", "2147483648"),
        ("a|b|c|404.0|1", "invalid_code", "404.0", "404.0"),
        ("a|b|c|4 04|1", "invalid_code", "4 04", "4 04"),
        ("a|b|c|40-4|1", "invalid_code", "40-4", "40-4"),
        ("a|b|c|4e2|1", "invalid_code", "4e2", "4e2"),
        ("a|b|c|+|1", "invalid_code", "+", "+"),
        ("a|b|c|+-4|1", "invalid_code", "+-4", "+-4"),
        ("a|b|c| 404|1", "invalid_code", " 404", " 404"),
    ],
)
def test_one_line(lines, line, outcome, status, untrimmed):
    row = logs.parse_log(lines(line)).first()
    assert row.outcome == outcome
    if outcome not in ("skipped", "malformed"):
        assert row.status == status
    counted = as_dict(logs.status_counts(lines(line)))
    assert counted == ({} if untrimmed is None else {untrimmed: 1})


def test_fields(lines):
    row = logs.parse_log(lines(SPACED[1])).first()
    assert row[:5] == ("2024-01-15", "10.0.0.5", "/api/users", "404", "512")


def test_summary_holds_both_results(lines):
    rows = {(r.outcome, r.status): r.n for r in logs.log_summary(lines(*SPACED)).collect()}
    assert rows[("error", "404")] == 4 and rows[("ok", None)] == 3


def test_grep_and_head(lines):
    df = lines(*SPACED)
    assert logs.grep_lines(df, r"\| 404 \|").count() == 4
    numbered = df.sparkSession.createDataFrame(list(enumerate(SPACED)), "n int, value string")
    assert [r.value for r in logs.head_lines(numbered, "n", 10).collect()] == SPACED[:10]


def test_counts_are_combined_before_the_shuffle(lines):
    plan = logs.error_counts(lines(*SPACED))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange") == 1
