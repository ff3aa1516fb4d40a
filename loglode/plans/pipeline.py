"""The ingest pipeline: lines in, table rows out; the same plan in batch and streaming."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from loglode.functions.agents import AGENT_FIELDS
from loglode.model import FULL_COLUMNS, MAIN_FORMAT
from loglode.operators.columns import Tags, map_columns
from loglode.operators.parse import parse_text
from loglode.operators.parse_json import parse_json
from loglode.operators.rules import Rule, check_rules, rule_fields, with_verdict
from loglode.sources.files import normalise

#: The field that a derived column is worked out from.
DERIVED_FROM = {
    "_status_class": "status",
    "_referrer_domain": "http_referer",
    "_url_extension": "request",
    **dict.fromkeys(AGENT_FIELDS, "http_user_agent"),
}


@dataclass(frozen=True)
class Ingest:
    """What to read from a line and what to make of it.

    ``log_format=None`` means one JSON object per line. Sampling tells lines apart by their place in
    their file, or by the input column ``sample_key``.
    """

    log_format: str | None = MAIN_FORMAT
    columns: dict[str, str] = field(default_factory=lambda: dict(FULL_COLUMNS))
    rules: tuple[Rule, ...] = ()
    tags: Tags = Tags()
    sample_key: str | None = None

    def parsed(self, lines: DataFrame) -> DataFrame:
        """Every line with its fields and ``_error``."""
        lines = normalise(lines)
        if self.log_format is not None:
            return parse_text(lines, self.log_format)
        needed = {s for s in self.columns.values() if not s.startswith("_")}
        for source in self.columns.values():
            needed |= {DERIVED_FROM[source]} if source in DERIVED_FROM else set()
        return parse_json(lines, sorted(needed))

    def judged(self, lines: DataFrame) -> DataFrame:
        """Every line with its fields, ``_error`` and ``_kept``; nothing is dropped yet."""
        parsed = self.parsed(lines)
        if not self.rules:
            return parsed.withColumn("_kept", F.lit(True))
        fields = rule_fields(self.columns)
        check_rules(parsed.sparkSession, list(self.rules), fields)
        return with_verdict(parsed, list(self.rules), fields, self.sample_key)

    def rows(self, judged: DataFrame) -> DataFrame:
        """Table rows of the lines that parsed and passed the rules."""
        kept = judged.where(F.col("_error").isNull() & F.col("_kept"))
        return map_columns(kept, self.columns, self.tags)

    def run(self, lines: DataFrame) -> DataFrame:
        return self.rows(self.judged(lines))
