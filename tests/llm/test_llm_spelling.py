"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import brute
from brute import ROWS
from loglode.llm import spelling
from loglode.llm.queries import QUERIES
from loglode.llm.spelling import near_pairs, variants

SF = "/root/testdata/sf0.001"


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1 :] or (len(a) == len(b) and a[at + 1 :] == b[at + 1 :])


def plain_words(docs):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                total[run] += 1
    return {word: n for word, n in total.items() if n >= 2}


def plain_near(words):
    """Each word's near words: those that agree with it but for one code point, found by taking one out."""
    lists = defaultdict(set)
    for word in words:
        for key in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            lists[key].add(word)
    near = defaultdict(set)
    for some in lists.values():
        for a in some:
            near[a] |= {b for b in some if one_apart(a, b)}
    return near


def plain_version(docs):
    n = plain_words(docs)
    near = plain_near(n)
    form = {}
    for word in n:
        best = min(near[word], key=lambda other: (-n[other], other), default=None)
        form[word] = best if best and n[best] >= 10 * n[word] else None
    out = []
    for word in n:
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n[word], len(near[word]), n.get(form[word])))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_op13(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = rows_of(QUERIES["op13_spelling_variants"](spark, SF))
    assert got == plain_version(docs) and any(r[1] for r in got)


def test_awkward_rows(spark, small, empty):
    assert rows_of(variants(small)) == plain_version([row[:2] for row in ROWS])
    assert variants(empty).count() == 0
    texts = [("Straße_GRÖSSERE größere Größere groessere", 3), ("ÀÉÎÕÜ×÷àé abcdefg abcdefg bcdefgh", 4), (None, 5)]
    # A chain of forms: each ten times as frequent as the one before.
    chain = [("abcdefgh " * 2 + "abcdefghi " * 30 + "abcdefghij " * 400 + "abcdefghijk " * 5000, 8)]
    tied = [("xbcdefgh " * 30 + "zbcdefgh " * 30 + "ybcdefgh " * 3, 9)]
    docs = [(doc, text) for text, doc in [*texts, *texts, *chain, *tied, ("nullnull nullnull", None)]]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(variants(frame)) == plain_version(docs)


@pytest.mark.parametrize("rare, longest", [(32, 200), (1, 200), (1, 2), (10**9, 1)])
def test_near_pairs(spark, monkeypatch, rare, longest):
    """All pairs, whatever the dictionary holds and however few words a list may have."""
    monkeypatch.setattr(spelling, "RARE", rare)
    monkeypatch.setattr(spelling, "LIST", longest)
    rng = random.Random(rare + longest)
    words = {"".join(rng.choices("ab", k=rng.randrange(7, 10))) for _ in range(300)}
    words |= {"prefixes" + "".join(rng.choices("abcö", k=rng.randrange(1, 5))) for _ in range(200)}
    words |= {"".join(rng.choices("abcö", k=rng.randrange(1, 5))) + "suffixes" for _ in range(200)}
    words |= {"aaaaaaa" + "a" * i for i in range(20)}
    frame = spark.createDataFrame([(word, len(word)) for word in sorted(words)], "word string, n long")
    got = sorted((r.a, r.b) for r in near_pairs(frame.repartition(3)).collect())
    assert got == sorted((a, b) for a, some in plain_near(words).items() for b in some if a < b)
