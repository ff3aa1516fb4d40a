"""Ordered drop and keep rules, with optional sampling.

A rule is a Spark SQL condition over the mapped source fields, such as
``status >= 500 and contains(request, '/api')`` or ``request rlike '^GET /health'``. Numbers are
never NULL inside a rule: a missing or malformed one is zero, a missing text is ``''``. Where an
operation fails, as in a division by zero, its value is NULL and the row passes.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglode.functions.typed import rule_value
from loglode.model import AT, FILE, kind_of


@dataclass(frozen=True)
class Rule:
    condition: str
    action: str  # "drop" or "keep"
    rate: float = 0.0  # share of the matches acted on; 0 and 1 mean all of them


def rule_fields(columns: dict[str, str]) -> list[str]:
    """Source fields a rule may name: the mapped ones, without the derived ``_`` ones."""
    return sorted({source for source in columns.values() if not source.startswith("_")})


def check_rules(spark: SparkSession, rules: list[Rule], fields: list[str]) -> None:
    """Raise ``ValueError`` for the first rule that cannot run, before any data moves."""
    types = {"int": "bigint", "float": "double"}
    sample = spark.range(0).select(
        *[F.lit(None).cast(types.get(kind_of(name), "string")).alias(name) for name in fields]
    )
    for rule in rules:
        if rule.action not in ("drop", "keep"):
            raise ValueError(f"action must be drop or keep, not {rule.action!r}")
        if not 0 <= rule.rate <= 1:
            raise ValueError(f"rate must lie between 0 and 1, not {rule.rate}")
        try:
            with failing_is_null(spark):
                kind = sample.select(F.expr(rule.condition)).schema[0].dataType.simpleString()
        except PySparkException as problem:
            raise ValueError(f"condition {rule.condition!r}: {problem}") from problem
        if kind != "boolean":
            raise ValueError(f"condition {rule.condition!r} is {kind}, not boolean")


@contextmanager
def failing_is_null(spark: SparkSession):
    """Expressions that are analysed inside give NULL where they would otherwise end the job."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def sampled(rate: float, key: Column, salt: str) -> Column:
    """True for about ``rate`` of the rows; the same rows on every run, as ``key`` names them."""
    drawn = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt))), 1, 8), 16, 10)
    return drawn.cast("bigint") < F.lit(int(rate * 2**32)).cast("bigint")


def survives(rule: Rule, position: int, key: Column) -> Column:
    """Whether a row passes one rule; a condition that gives NULL lets the row pass."""
    match = F.expr(rule.condition)
    if 0 < rule.rate < 1:
        hit = match & sampled(rule.rate, key, f"|{position}|{rule.condition}")
    else:
        hit = match
    return match.isNull() | (hit if rule.action == "keep" else ~hit)


def row_name(parsed: DataFrame, key: str | None) -> Column:
    """What tells the rows of ``parsed``, packed into ``_row``, apart for sampling.

    That is the column ``key``; else the file and the place there that the sources give each line;
    else, for rows of other origin, all their values and their number within the task. A stream cannot
    number rows, so there equal ones share one fate.
    """
    if key:
        return F.col(f"_row.{key}")
    if AT in parsed.columns:
        return F.xxhash64(*[f"_row.{name}" for name in (FILE, AT, "value") if name in parsed.columns])
    if parsed.isStreaming:
        return F.xxhash64("_row")
    return F.xxhash64("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))


def with_verdict(
    parsed: DataFrame, rules: list[Rule], fields: list[str], key: str | None = None
) -> DataFrame:
    """Add ``_kept``: whether the row passes every rule in turn.

    ``key`` is a column that tells rows apart, for sampling; without it the line's place does
    (``row_name``), so of equal lines a share is kept, and every run over the same files keeps the same.
    """
    # The original row is packed aside so that rule texts see the coerced fields only.
    staged = parsed.select(
        F.struct(*[F.col(name) for name in parsed.columns]).alias("_row"),
        *_rule_inputs(parsed, fields),
    )
    name = F.col("_name")
    if any(0 < rule.rate < 1 for rule in rules):
        staged = staged.withColumn("_name", row_name(parsed, key))
    verdict = F.lit(True)
    for position, rule in enumerate(rules):
        verdict = verdict & survives(rule, position, name)
    with failing_is_null(parsed.sparkSession):
        return staged.select("_row.*", verdict.alias("_kept"))


def apply_rules(
    parsed: DataFrame, rules: list[Rule], fields: list[str], key: str | None = None
) -> DataFrame:
    """Only the rows that pass every rule in turn."""
    if not rules:
        return parsed
    check_rules(parsed.sparkSession, rules, fields)
    return with_verdict(parsed, rules, fields, key).where("_kept").drop("_kept")


def _rule_inputs(parsed: DataFrame, fields: list[str]) -> list[Column]:
    return [
        rule_value(name, F.col(name) if name in parsed.columns else F.lit(None).cast("string"))
        .alias(name)
        for name in fields
    ]
