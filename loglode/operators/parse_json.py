"""One JSON object per line to named text fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglode.operators.parse import NOT_AN_OBJECT, once


def parse_json(lines: DataFrame, fields: list[str], column: str = "value") -> DataFrame:
    """Add one string column per key in ``fields``, and ``_error`` (NULL for a good line).

    An absent key gives NULL; a JSON ``null`` gives ``''``. Only the named keys are read.
    """
    line = F.col(column)
    # The parser stops after the first value, so the line goes into an array followed by its own
    # hash: anything after the object pushes the hash out of second place.
    envelope = F.concat(F.lit("["), line, F.lit(","), F.xxhash64(line).cast("string"), F.lit("]"))
    boxed = once(lines, F.try_parse_json(envelope), "_box")
    box = F.col("_box")
    alone = (F.try_variant_get(box, "$[1]", "bigint") == F.xxhash64(line)) & F.try_variant_get(
        box, "$[2]", "variant"
    ).isNull()
    # What parses and opens with a brace is an object; a bare null is an entry without fields.
    opens = F.startswith(line, F.lit("{")) | line.rlike(r"^\s*(?:\{|null\s*$)")
    good = F.coalesce(alone & opens, F.lit(False))
    texts = F.array(*[F.try_variant_get(box, _path(name), "string") for name in fields])
    staged = boxed.select("*", good.alias("_good"))
    staged = staged.select("*", F.when(F.col("_good"), texts).alias("_texts"))
    staged = staged.select("*", log_texts(line, box, fields).alias("_fields"))
    return staged.select(
        *lines.columns,
        *[F.get("_fields", F.lit(i)).alias(name) for i, name in enumerate(fields)],
        F.when(~F.col("_good"), NOT_AN_OBJECT).alias("_error"),
    )


def _path(key: str) -> str:
    if "'" in key or "\\" in key:
        raise ValueError(f"unsupported JSON key {key!r}")
    return f"$[0]['{key}']"


def log_texts(line: Column, box: Column, fields: list[str]) -> Column:
    """The plain texts of all fields, the way a log field is written.

    Whole numbers lose their fraction, exponents are written out and null is ``''``. Objects and
    arrays stay JSON text, with ``<``, ``>`` and ``&`` escaped.
    """
    # Only in such lines can a text need another form: where a key is absent or null, something is nested,
    # or a number has an exponent or more digits than a decimal holds. One look at the line tells.
    missing = F.expr(" OR ".join(f"_texts[{i}] IS NULL" for i in range(len(fields))))
    nested = F.contains(line, F.lit("[")) | (F.locate("{", line, 2) > 0)
    doubtful = missing | nested | line.rlike(r"[:,]\s*-?[0-9.]*(?:[0-9][eE]|[0-9.]{30})")
    kinds = F.array(
        *[F.schema_of_variant(F.try_variant_get(box, _path(name), "variant")) for name in fields]
    )
    rewritten = F.transform(
        F.arrays_zip(F.col("_texts").alias("text"), kinds.alias("kind")), _rewritten
    )
    return F.when(doubtful, rewritten).otherwise(F.col("_texts"))


def _rewritten(value: Column) -> Column:
    text, kind = value["text"], value["kind"]
    escaped = text
    for sign, code in (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")):
        escaped = F.replace(escaped, F.lit(sign), F.lit(code))
    return (
        F.when(text.isNull(), F.when(kind == "VOID", ""))
        .when(kind == "DOUBLE", _let(shortest(text), plain_decimal))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), escaped)
        .otherwise(text)
    )


def shortest(text: Column) -> Column:
    """The number in 15 digits where those say the same; some Java versions write more."""
    number = text.try_cast("double")
    return _let(
        F.format_string("%.14E", number),
        lambda brief: F.when(brief.try_cast("double") == number, brief).otherwise(text),
    )


def plain_decimal(text: Column) -> Column:
    """``1.5E-5`` -> ``0.000015``, ``1.0E22`` -> ``1`` and 22 zeros, ``1000.0`` -> ``1000``."""
    pattern = r"^(-?)([0-9]+)\.([0-9]+?)0*(?:E([+-]?[0-9]+))?$"

    def part(group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    parts = F.struct(
        part(1).alias("sign"),
        part(2).alias("whole"),
        F.regexp_replace(part(3), "^0$", "").alias("fraction"),
        F.coalesce(part(4).try_cast("int"), F.lit(0)).alias("shift"),
    )
    return _let(parts, lambda p: _let(_digits(p), lambda d: F.concat(p["sign"], _placed(d))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(parts: Column) -> Column:
    """All digits without leading zeros, and where the point lands, counted from their left."""
    all_digits = F.concat(parts["whole"], parts["fraction"])
    kept = F.ltrim(all_digits, F.lit("0"))
    cut = F.length(all_digits) - F.length(kept)
    point = F.length(parts["whole"]) + parts["shift"] - cut
    return F.struct(kept.alias("digits"), F.length(kept).alias("size"), point.alias("point"))


def _placed(number: Column) -> Column:
    digits, size, point = number["digits"], number["size"], number["point"]
    return (
        F.when(size == 0, "0")
        .when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= size, F.rpad(digits, point, "0"))
        .otherwise(F.concat(
            F.substring(digits, F.lit(1), point), F.lit("."),
            F.substring(digits, point + 1, size),
        ))
    )
