"""Fill-in-the-middle against a plain version, and its round trip."""

import hashlib
import random
import re

import pytest

from brute import LONG, ROWS
from loglode.llm.infill import infilled, restored

PARTS = ["a", "Bc", " ", "<P>", "<", "S", ">", "<M", "é", "😀", "\n", "\0", "M>"]


def plain_version(doc, text):
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(sign in text for sign in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    odd = [(1000 + i, "".join(rng.choices(PARTS, k=rng.randrange(30)))) for i in range(3000)]
    long = [(5000 + i, LONG * (i + 1)) for i in range(4)]
    return [*odd, *long, (None, "null as an id"), (None, None), (77, "<P> in it"), (7, "same"), (7, "same")]


def test_infilled(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = restored(infilled(frame)).collect()
    found = sorted((str(r.row.doc_id), str(r.row.text), tuple(r)[1:]) for r in got)
    assert found == sorted((str(d), str(t), plain_version(d, t)) for d, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_extra_columns_and_empty_table(spark, small, empty):
    got = infilled(small.withColumn("n", small.doc_id).withColumn("form", small.text))
    assert got.count() == len(ROWS) and {r.row.n == r.row.doc_id for r in got.collect()} == {True}
    assert restored(infilled(empty)).count() == 0


def test_damaged_outputs_are_null(spark):
    outputs = [("<P>x<S>y", "psm"), ("<S>a<P>b<M>c", "psm"), ("x<P><S><M>", "psm"), ("<P>a<S>b<M>c<M>", "psm")]
    outputs += [("as it is", "plain"), (None, "plain"), ("<S>c<P>a<M>b", "spm"), ("as it is", None)]
    frame = spark.createDataFrame(outputs, "output string, form string").coalesce(1)
    want = [None, None, None, None, "as it is", "", "abc", "as it is"]
    assert [r.restored for r in restored(frame).collect()] == want
