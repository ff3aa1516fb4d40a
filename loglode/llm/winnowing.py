"""Document fingerprints by winnowing, from DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglode.llm.tables import sized, stored

#: Words in a gram, and grams in a window.
GRAM, WINDOW = 5, 16
#: An ideograph, or a run of other letters and digits.
TOKEN = r"\p{IsIdeographic}|[\p{L}\p{M}\p{N}&&[^\p{IsIdeographic}]]+"
#: Most rows in a bucket of neighbours, and ranges that are split into such buckets.
BUCKET, RANGES = 4_000, 64


def with_fingerprint(
    rows: DataFrame, text: str, name: str, gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Add the fingerprint of a text column: an array of hash and at, by place.

    The words, in lower case, are hashed in overlapping grams. Of each ``window`` grams in a row the
    one with the smallest hash is kept, of equal ones the rightmost, with the number of its first
    word. So two texts that share ``window + gram - 1`` words in a row share a fingerprint hash, and
    nothing shorter than a gram counts. Fewer words than a gram are one gram; a text without words
    but not empty is one; a null or empty text has an empty fingerprint.

    Every step is a column of its own and is used twice or more, so that none is worked out again
    inside the function of the next.
    """
    kept = [f"`{column}`" for column in rows.columns]
    whole = F.coalesce(F.col(text), F.lit(""))
    found = rows.select(
        *kept, whole.alias("_text"), F.regexp_extract_all(F.lower(whole), F.lit(TOKEN), F.lit(0)).alias("_words")
    )
    some = F.when(F.size("_words") > 0, F.transform("_words", lambda word: F.xxhash64(word)))
    odd = F.when(F.length("_text") > 0, F.array(F.xxhash64("_text"))).otherwise(F.array().cast("array<bigint>"))
    found = found.select(*kept, F.coalesce(some, odd).alias("_words"))
    at = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_words") - gram))
    hashed = F.transform(
        at,
        lambda i: F.struct(
            F.xxhash64(F.slice(F.col("_words"), i + 1, F.lit(gram))).alias("hash"), (-i).alias("left")
        ),
    )
    found = found.select(*kept, F.size("_words").alias("_size"), hashed.alias("_grams"))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_grams") - window + 1))
    least = F.transform(places, lambda i: F.array_min(F.slice(F.col("_grams"), i, F.lit(window))))
    found = found.select(*kept, "_size", least.alias("_least"))
    # The chosen places never go back, so repeats of one are neighbours.
    first = F.filter(
        F.col("_least"),
        lambda x, i: (i == 0) | (x["left"] != F.get(F.col("_least"), i - 1)["left"]),
    )
    chosen = F.transform(first, lambda x: F.struct(x["hash"].alias("hash"), (-x["left"]).alias("at")))
    empty = F.array().cast("array<struct<hash:bigint,at:int>>")
    return found.select(*kept, F.when(F.col("_size") > 0, chosen).otherwise(empty).alias(name))


def likeness(a: str, b: str) -> Column:
    """Share of the hashes of two fingerprints that both have; two empty ones are alike."""
    x, y = F.col(f"{a}.hash"), F.col(f"{b}.hash")
    either = F.size(F.array_union(x, y))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / either)


def written(fingerprint: str) -> Column:
    """A fingerprint as a text: hash in hexadecimal, colon, place, separated by commas."""
    return F.concat_ws(",", F.transform(fingerprint, lambda x: F.concat_ws(":", F.hex(x.hash), x.at)))


def bucketed(rows: DataFrame) -> DataFrame:
    """Add ``bucket``, which rises with doc_id (null: -1), for even buckets of a few thousand rows.

    Quantiles cut the ids into ranges, and each range is cut into equal widths.
    """
    count = rows.count()
    bounds = rows.approxQuantile("doc_id", [i / RANGES for i in range(RANGES + 1)], 0.001) or [0.0]
    bounds = sorted({int(bound) for bound in bounds})
    parts = max(1, -(-count // (RANGES * BUCKET)))
    edges = F.array(*[F.lit(bound).cast("long") for bound in [*bounds, bounds[-1] + 1]])
    id_ = F.col("doc_id")
    cell = F.greatest(F.lit(1), F.size(F.filter(edges, lambda edge: edge <= id_)))
    cell = F.least(cell, F.lit(len(bounds)))
    low, high = F.element_at(edges, cell).cast("double"), F.element_at(edges, cell + 1).cast("double")
    part = F.floor((id_ - low) / (high - low) * parts)
    part = F.greatest(F.lit(0), F.least(part, F.lit(parts - 1)))
    place = cell.cast("long") * parts + part
    return rows.withColumn("bucket", F.when(id_.isNull(), -1).otherwise(place))


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add next_<column> of the row that follows in ascending doc_id; after the last the first.

    Rows with one doc_id go by their text; a null doc_id comes first. Rows meet in buckets of
    neighbouring ids. The first row of a bucket is sent to the bucket before it as well, and the
    very first to the last, so each row moves once.
    """
    placed = bucketed(rows)
    order = Window.orderBy("bucket")
    firsts = stored(
        placed.groupBy("bucket").agg(F.min("doc_id").alias("doc_id")), "buckets"
    )
    last = firsts.agg(F.max("bucket")).first()[0]
    before = F.lag("bucket").over(order)
    sent = firsts.select(
        F.col("bucket").alias("own"),
        F.col("doc_id").alias("first_id"),
        F.coalesce(before, F.lit(last)).alias("to"),
    )
    joined = placed.join(
        sized(stored(sent, "sent")),
        (F.col("own") == F.col("bucket")) & F.col("first_id").eqNullSafe(F.col("doc_id")),
        "left",
    )
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    seats = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, guest))
    kept = [f"`{column}`" for column in rows.columns]
    seated = joined.select(*kept, F.explode(seats).alias("seat"))
    by = Window.partitionBy("seat.bucket").orderBy("seat.guest", "doc_id", "text")
    following = seated.select(
        *kept, "seat", *[F.lead(column).over(by).alias(f"next_{column}") for column in columns]
    )
    return following.filter(~F.col("seat.guest")).drop("seat")


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text and fingerprint.

    A null text is empty. Rows that repeat are taken one by one, an empty table gives no rows, and
    other columns are not used. There is no shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return with_fingerprint(texts, "text", "fingerprint", gram, window)
