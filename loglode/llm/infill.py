"""Fill-in-the-middle: a text's middle moved behind what follows it, and put back, byte by byte.

The bytes of many texts lie in one array. Where a text is cut into prefix, middle and suffix, each part
moves by a displacement of its own. A difference array holds the displacement's changes, its running
sum is every byte's own, and one scatter builds all outputs; the way back is one gather.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from loglode.llm.shingles import buffers, slices
from loglode.llm.tables import wider

#: In 100 texts, how many are arranged at all, and how many of these begin with the suffix.
ARRANGED, SUFFIX_FIRST = 90, 20
#: Bytes of text that are moved at once; the arrays take some 40 times as much. A longer text is alone.
TOGETHER = 1 << 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SIGN = len(PREFIX)
LETTER, KIND = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
KIND[[PREFIX[1], SUFFIX[1], MIDDLE[1]]] = True
PLAIN, PSM, SPM = range(3)
FORMS = pa.array(["plain", "psm", "spm"])


def hashed(seed: int, group: int) -> Column:
    """One of the 8-digit groups of the hash of a doc_id, as a number; a null doc_id is no digits."""
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hex_digits = F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256)
    return F.conv(F.substring(hex_digits, 8 * group - 7, 8), 16, 10).cast("long")


def signs(chars: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the signs of the parts stand, and in which text each does."""
    found = np.flatnonzero((chars[:-2] == 0x3C) & KIND[chars[1:-1]] & (chars[2:] == 0x3E))
    text = np.searchsorted(bounds, found, "right") - 1
    whole = found + SIGN <= bounds[text + 1]
    return found[whole], text[whole]


def spread(starts: np.ndarray, ends: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """An array that has a value from each start to its end and zeros elsewhere."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, values)
    np.subtract.at(change, ends, values)
    return np.cumsum(change)[:-1]


def strings(bounds: np.ndarray, chars: np.ndarray) -> pa.Array:
    """Texts that lie one after the other."""
    held = pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(chars)
    )
    return held.cast(pa.string())


def arranged(chars: np.ndarray, bounds: np.ndarray, h: list[np.ndarray]) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of texts in one array."""
    begins, stops = bounds[:-1], bounds[1:]
    point = (chars & 0xC0) != 0x80
    letter = LETTER[chars]
    goes_on = np.zeros(len(chars) + 1, bool)
    goes_on[1:-1] = letter[1:] & letter[:-1]
    goes_on[bounds] = False
    unit = point & ~goes_on[:-1]
    units = np.concatenate([[0], np.cumsum(unit)])
    points = np.concatenate([[0], np.cumsum(point)])
    n = units[stops] - units[begins]
    form = np.where(h[3] % 100 < SUFFIX_FIRST, SPM, PSM)
    form[(stops == begins) | (h[2] % 100 >= ARRANGED)] = PLAIN
    form[signs(chars, bounds)[1]] = PLAIN

    places = np.append(np.flatnonzero(unit), len(chars))

    def cut(units_before: np.ndarray) -> np.ndarray:
        return np.where(units_before < n, places[units[begins] + units_before], stops)

    one, other = h[0] % (n + 1), h[1] % (n + 1)
    first, second = cut(np.minimum(one, other)), cut(np.maximum(one, other))
    moved = form != PLAIN
    sizes = stops - begins + np.where(moved, 3 * SIGN, 0)
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(at[-1], np.uint8)
    # The part that stands first, the one after it, and the middle: sign, start and end of each.
    swapped = form == SPM
    early = np.where(swapped, second, begins), np.where(swapped, stops, first)
    late = np.where(swapped, begins, second), np.where(swapped, first, stops)
    goes_to = at[:-1] + SIGN
    starts, ends, shifts = [begins[~moved]], [stops[~moved]], [(at[:-1] - begins)[~moved]]
    for start, end, letters in (
        (*early, np.where(swapped, SUFFIX[1], PREFIX[1])),
        (*late, np.where(swapped, PREFIX[1], SUFFIX[1])),
        (first, second, np.full(len(n), MIDDLE[1])),
    ):
        starts.append(start[moved])
        ends.append(end[moved])
        shifts.append((goes_to - start)[moved])
        sign = (goes_to - SIGN)[moved]
        out[sign], out[sign + 1], out[sign + 2] = PREFIX[0], letters[moved], PREFIX[2]
        goes_to = goes_to + (end - start) + SIGN
    shift = spread(*(np.concatenate(x) for x in (starts, ends, shifts)), len(chars))
    out[np.arange(len(chars)) + shift] = chars
    count = lambda a, b: pa.array(points[b] - points[a], mask=~moved)
    return {
        "n": pa.array(n),
        "form": FORMS.take(pa.array(form)),
        "prefix_chars": count(begins, first),
        "middle_chars": count(first, second),
        "output": strings(at, out),
    }


def put_back(chars: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> pa.Array:
    """The texts that outputs were made of; null where the signs do not fit the form."""
    found, text = signs(chars, bounds)
    moved = form != PLAIN
    kept = moved[text]
    found, text = found[kept], text[kept]
    right = np.bincount(text, minlength=len(form)) == 3
    # The letters must be those of the form, and the first sign must begin the output.
    three = found[right[text]].reshape(-1, 3)
    rows = np.flatnonzero(right & moved)
    letters = np.where((form[rows] == SPM)[:, None], [SUFFIX[1], PREFIX[1], MIDDLE[1]], [PREFIX[1], SUFFIX[1], MIDDLE[1]])
    fits = (chars[three + 1] == letters).all(1) & (three[:, 0] == bounds[rows])
    rows, three = rows[fits], three[fits]
    bad = moved.copy()
    bad[rows] = False
    sizes = np.diff(bounds) - np.where(moved, 3 * SIGN, 0)
    sizes[bad] = 0
    at = np.concatenate([[0], np.cumsum(sizes)])
    stops = bounds[1:][rows]
    one = three[:, 0] + SIGN, three[:, 1]
    two = three[:, 1] + SIGN, three[:, 2]
    swapped = form[rows] == SPM
    parts = [
        [np.where(swapped, y, x) for x, y in zip(one, two, strict=True)],
        [three[:, 2] + SIGN, stops],
        [np.where(swapped, x, y) for x, y in zip(one, two, strict=True)],
    ]
    plain = np.flatnonzero(~moved)
    starts, ends, shifts = [at[plain]], [at[plain + 1]], [bounds[plain] - at[plain]]
    goes_to = at[rows]
    for start, end in parts:
        starts.append(goes_to)
        ends.append(goes_to + end - start)
        shifts.append(start - goes_to)
        goes_to = ends[-1]
    shift = spread(*(np.concatenate(x) for x in (starts, ends, shifts)), int(at[-1]))
    texts = strings(at, chars[np.arange(at[-1]) + shift])
    return pc.if_else(pa.array(bad), pa.scalar(None, pa.string()), texts)


def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        offsets, data = buffers(pc.struct_field(whole["row"], "text"))
        for first, last in slices(offsets, TOGETHER):
            batch = whole.slice(first, last - first)
            h = [batch[f"h{i}"].to_numpy() for i in (1, 2, 3, 4)]
            own = offsets[first : last + 1]
            made = arranged(data[own[0] : own[-1]], own - own[0], h)
            yield pa.RecordBatch.from_arrays([batch["row"], *made.values()], ["row", *made])


def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        offsets, data = buffers(whole["output"])
        for first, last in slices(offsets, TOGETHER):
            batch = whole.slice(first, last - first)
            form = pc.index_in(batch["form"], FORMS).fill_null(PLAIN).to_numpy(zero_copy_only=False)
            own = offsets[first : last + 1]
            back = put_back(data[own[0] : own[-1]], own - own[0], form)
            yield pa.RecordBatch.from_arrays([*batch.columns, back], [*batch.schema.names, "restored"])


def infilled(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) as a struct ``row``, with n, form, prefix_chars, middle_chars, output.

    A text is n units: runs of ASCII letters, and any other code points one by one. Two hashes of the
    doc_id choose the cuts between units. ``output`` is prefix, suffix and middle behind their signs
    (form psm), suffix, prefix and middle (spm), or the text as it is (plain): an empty one, one that
    holds a sign itself, and one in ten by hash. Only hashes of the doc_id and the text decide, so runs
    agree. A null text is empty and plain; a null doc_id is hashed like no digits; rows that repeat are
    cut alike; an empty table gives no rows. Part sizes are code points and null in plain texts. A task
    holds a few MB of text, or one text, and some 40 times its bytes. No shuffle.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select(row, *[hashed(seed, i).alias(f"h{i}") for i in (1, 2, 3, 4)])
    made = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
    return rows.mapInArrow(arrange, wider(docs.select(row), **made))


def restored(frame: DataFrame) -> DataFrame:
    """Add ``restored``, the text that ``output`` was made of, from output and form alone.

    Null where the output has not the three signs of its form in their order; a null form is plain and
    a null output empty.
    """
    return frame.mapInArrow(restore, wider(frame, restored="string"))
