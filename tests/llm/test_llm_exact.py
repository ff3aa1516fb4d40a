"""Exact dedup, near duplicates and components."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

import brute
from brute import ROWS
from loglode.llm.components import components
from loglode.llm.exact import exact_groups, without_copies
from loglode.llm.jaccard import near_groups, one_of_each


@pytest.mark.parametrize("size", [16_384, 4_000])
def test_exact_groups(small, size):
    got = exact_groups(small, size).collect()
    groups = defaultdict(list)
    for doc, text, *_ in ROWS:
        groups[brute.lower(text)].append(doc)
    want = Counter()
    for text, docs in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        for doc in docs:
            want[doc, max(docs), len(docs), digest] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_hash_clash(small, monkeypatch):
    """Where blocks share a hash, their bytes decide."""
    from loglode.llm import exact

    plain = exact.blocks_of
    from pyspark.sql import functions as F

    monkeypatch.setattr(
        exact, "blocks_of", lambda *a: plain(*a).withColumn("hash", F.col("hash") % F.lit(3))
    )
    got = exact_groups(small, 5_000).collect()
    assert len({r.text_sha256 for r in got}) == sum(r.kept for r in got)


def test_without_copies(small, empty):
    got = without_copies(small)
    assert got.columns == small.columns
    rows = [(r.doc_id, r.text) for r in got.collect()]
    assert len(rows) == len(set(rows)) == len({brute.lower(t) for _, t, *_ in ROWS})
    assert (2, "hello world") in rows
    assert without_copies(empty).count() == 0 and exact_groups(empty).count() == 0


def test_null_ids(spark):
    frame = spark.createDataFrame([(None, "x"), (None, "x"), (1, "y"), (None, "z")], "doc_id bigint, text string")
    assert sorted(r.text for r in without_copies(frame).collect()) == ["x", "y", "z"]
    groups = near_groups(frame).collect()
    assert len(groups) == 4 and all(r.component_id == r.doc_id for r in groups)


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {x: x for pair in links for x in pair}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(root[a], root[b])
            moved |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert got == root


def near_rows(seed):
    """A base text, copies with some words exchanged, and texts that share a passage."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for doc in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    for doc in range(200, 260):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.choice([3, 20, 60]))]
        rows.append((doc, " ".join(base[:40] + own)))
    rows += [(300 + i, " ".join(base[: rng.randrange(1, 9)])) for i in range(20)]
    return rows + [(400, None), (401, ""), (402, "  "), (403, "a b"), (404, "A  b")]


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_near_groups(spark, words, percent):
    rows = near_rows(words)
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), words, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    want = brute.components(rows, words, percent)
    assert got == {doc: (len(brute.shingles(text, words)), want[doc]) for doc, text in rows}


def test_near_edge_cases(small, empty):
    got = near_groups(small, 4, 85).collect()
    assert sorted(r.doc_id for r in got) == sorted(row[0] for row in ROWS)
    component = {r.doc_id: r.component_id for r in got}
    assert component[2] == 1 and component[7] == component[8] == 6 and component[11] == 10
    assert component[3] == 3 and component[4] == 4 and component[5] == 5
    kept = one_of_each(small, 4, 85)
    assert kept.columns == small.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted(set(component.values()))
    assert near_groups(empty).count() == 0 and one_of_each(empty).count() == 0


def test_one_component_in_a_list_is_not_paired(spark, monkeypatch):
    """A third of all rows share a list whose hub is like none of them; two such groups share another."""
    from loglode.llm import jaccard

    met = []
    plain = jaccard.stored

    def counting(frame, name):
        out = plain(frame, name)
        if name == "meeting":
            met.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counting)
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    shared = "five words that all share".split()
    docs = [" ".join(shared)]
    for name in "ab":
        core = words(name, 25) + shared + words(f"{name}{name}", 25)
        docs += [" ".join([*core, f"own{name}{i}"]) for i in range(40)]
    # These make the words around the shared ones more common, so the shared ones stand in prefixes.
    docs += [" ".join(words(x, 25) + words(f"x{i}", 90) + words(x + x, 25)) for i in range(45) for x in "ab"]
    rows = list(enumerate(docs))
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute.components(rows, 5, 80)
    assert len({r.component_id for r in got if 1 <= r.doc_id <= 80}) == 2
    # The groups meet once in the shared list, whatever their size; 40 times 40 pairs of each never do.
    assert met and met[0] <= 4


def test_a_passage_in_many_documents_is_not_paired(spark, monkeypatch):
    """Documents that share a passage, each with too many words of its own, meet in its lists and are not paired."""
    from loglode.llm import jaccard

    met = []
    plain = jaccard.stored

    def counting(frame, name):
        out = plain(frame, name)
        if name == "meeting":
            met.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", counting)
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [" ".join([passage, *[f"own{i}x{k}" for k in range(9)]]) for i in range(200)]
    # Those with few words of their own link with each other.
    docs += [" ".join([passage, *[f"few{i}x{k}" for k in range(3)]]) for i in range(10)]
    rows = list(enumerate(docs))
    got = near_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute.components(rows, 4, 85)
    assert len({r.component_id for r in got}) == 201
    assert met and met[0] <= len(rows)


@pytest.mark.parametrize("percent", [50, 85, 100])
def test_across_gives_the_pairs_that_filters_pass(spark, percent):
    """Every pair of a list that may link, once, and none of one component."""
    from loglode.llm.jaccard import across

    draw = random.Random(7)
    rows = []
    for doc in range(300):
        n = draw.choice([1, 2, 5, 6, 7, 20, 21, 24, 25, 100, 117, 118])
        rows.append((doc % 3, doc, n, draw.randrange(n + (-percent * n) // 100 + 1), doc % 50))
    frame = spark.createDataFrame(rows, "shingle long, doc_id long, n int, at int, label long")
    got = [(r.shingle_of, *sorted([r.a, r.b])) for r in across(frame, percent).selectExpr("a % 3 as shingle_of", "*").collect()]
    want = []
    for x, y in [(x, y) for x in rows for y in rows if x[1] < y[1] and x[0] == y[0] and x[4] != y[4]]:
        if min(x[2] - x[3], y[2] - y[3]) * (100 + percent) >= percent * (x[2] + y[2]):
            want.append((x[0], x[1], y[1]))
    assert sorted(got) == sorted(want) and want
