"""Access logs: ``DATE | IP | URL | STATUS | SIZE``, one request per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions.text import split_fields, strip, whole_number

# Fixed values of the log format.
FIELDS = ("date", "ip", "url", "status", "size")
DELIMITER = "|"
COMMENT = "#"
ERROR_THRESHOLD = 400
# The names under which a job reports how its lines fared.
COUNTER_NAMES = {
    "malformed": "Lignes malformées",
    "error": "Erreurs émises",
    "ok": "Requêtes OK ignorées",
    "invalid_code": "Codes invalides",
}


def _records(lines: DataFrame, trim_line: bool) -> DataFrame:
    """The line and its five trimmed fields; a field that is missing is null.

    One projection after the other, so that each line is split once.
    """
    line = strip(F.col("value")) if trim_line else F.col("value")
    split = lines.select(line.alias("line")).select(
        "line", split_fields(F.col("line"), DELIMITER).alias("fields")
    )
    named = [strip(F.get("fields", F.lit(i))).alias(name) for i, name in enumerate(FIELDS)]
    return split.select("line", *named)


def parse_log(lines: DataFrame, threshold: int = ERROR_THRESHOLD, trim_line: bool = True) -> DataFrame:
    """Five trimmed text fields and an outcome per line; a missing field is null.

    ``lines`` has a ``value`` column, as ``spark.read.text`` gives it. Every line
    stays: skipped and malformed ones are marked, not dropped.
    """
    coded = _records(lines, trim_line).withColumn("code", whole_number(F.col("status")))
    outcome = (
        F.when((F.col("line") == "") | F.col("line").startswith(COMMENT), "skipped")
        .when(F.col("status").isNull(), "malformed")
        .when(F.col("code").isNull(), "invalid_code")
        .when(F.col("code") < threshold, "ok")
        .otherwise("error")
    )
    return coded.select(*FIELDS, outcome.alias("outcome"))


def _error_status() -> Column:
    return F.when(F.col("outcome") == "error", F.col("status")).alias("status")


def _count_statuses(statuses: DataFrame) -> DataFrame:
    """Lines per status text; lines without one count for nothing.

    They are left out after the aggregation: a filter before it would have to work
    out the status a second time, and they shuffle as a single row per task.
    """
    return statuses.groupBy("status").agg(F.count("status").alias("n")).filter(F.col("n") > 0)


def log_summary(lines: DataFrame, threshold: int = ERROR_THRESHOLD) -> DataFrame:
    """Lines per outcome and, for errors, per status text.

    One scan with one small aggregation that holds both the error counts and the
    line outcomes, for a job that reports both.
    """
    parsed = parse_log(lines, threshold).select("outcome", _error_status())
    return parsed.groupBy("outcome", "status").agg(F.count("*").alias("n"))


def error_counts(lines: DataFrame, threshold: int = ERROR_THRESHOLD) -> DataFrame:
    """Requests per status whose integer value reaches the threshold.

    The key is the status text as written: ``0404``, ``+404`` and ``404`` differ.
    """
    return _count_statuses(parse_log(lines, threshold).select(_error_status()))


def line_outcomes(lines: DataFrame, threshold: int = ERROR_THRESHOLD) -> DataFrame:
    """Lines per outcome: skipped, malformed, invalid_code, ok, error."""
    return parse_log(lines, threshold).groupBy("outcome").agg(F.count("*").alias("n"))


def status_counts(lines: DataFrame) -> DataFrame:
    """Lines per status text of any kind, over untrimmed lines with enough fields."""
    return _count_statuses(_records(lines, trim_line=False).select("status"))


def grep_lines(lines: DataFrame, pattern: str) -> DataFrame:
    """The lines in which a regular expression is found; no shuffle."""
    return lines.filter(F.col("value").rlike(pattern))


def head_lines(lines: DataFrame, order_by: str, n: int = 10) -> DataFrame:
    """The first lines by a line number column; ``readers.first_lines`` has them in file order."""
    return lines.orderBy(order_by).limit(n)
