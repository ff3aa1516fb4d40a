"""The registered queries and the pipeline against plain versions on the smallest tables."""

import hashlib
from collections import Counter

import duckdb
import pytest

import brute
import corpus_pipeline
from compare import differences
from loglode.llm import kneser_ney
from loglode.llm.mixing import with_copies
from loglode.llm.queries import ORACLES, QUERIES
from loglode.llm.tokens import BYTE_BPE, WORD_BPE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def test_one_query_each():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), SF, ORACLES[name]) == ""


def test_op1(spark, docs):
    got = QUERIES["op1_packing"](spark, SF).collect()
    ids = dict(zip((d for d, _ in docs), brute.token_ids([t for _, t in docs], WORD_BPE, 1)))
    held = Counter()
    for r in got:
        assert r.ids_crc32 == brute.checksum(ids[r.doc_id][r.start : r.start + r.length])
        assert r.doc_tokens == len(ids[r.doc_id])
        held[r.doc_id] += r.length
    assert held == {doc: len(x) for doc, x in ids.items()}


def test_op2(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_jaccard_join"](spark, SF).collect()}
    want = brute.components(docs, 4, 85)
    assert got == {doc: (len(brute.shingles(text, 4)), want[doc]) for doc, text in docs}


def test_op3(spark, docs):
    from test_llm_text import base_spans

    kinds = ["assign", "access", "hex"]
    got = {r.doc_id: r for r in QUERIES["op3_secret_scan"](spark, SF).collect()}
    for doc, text in docs:
        spans = base_spans(text)
        listed = ",".join(f"{kinds[kind]}:{a}:{b}" for a, kind, b in spans)
        r = got[doc]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("random")) == listed


def test_op4(spark, docs):
    got = QUERIES["op4_language"](spark, SF)
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    assert got.count() == len(docs) + pages and got.filter("language is null").isEmpty()


def test_op5(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, SF).collect()}
    texts = [text or "" for _, text in docs]
    for i, (doc, _) in enumerate(docs):
        text, following, quarter = texts[i], texts[(i + 1) % len(texts)], len(texts[i]) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    long = [r for r in got.values() if r.n_chars > 1000]
    assert sum(r.near_edited for r in long) / len(long) > 0.5 > 0.1 > sum(r.near_next for r in long) / len(long)


def test_op6(spark, docs):
    rows = QUERIES["op6_mixing"](spark, SF).collect()
    assert len(rows) == len(docs) and all(r.taken <= 3 * r.size for r in rows)
    sizes = {doc: len(brute.WORD.findall(text or "")) for doc, text in docs}
    assert {r.doc_id: r["size"] for r in rows} == sizes


def test_op8(spark, docs):
    got = sorted(tuple(r) for r in QUERIES["op8_arrow_files"](spark, SF).collect())
    start, want = 0, []
    for (doc, _), ids in zip(docs, brute.token_ids([t for _, t in docs], BYTE_BPE, 0)):
        want.append((doc, start, len(ids), brute.checksum(ids)))
        start += len(ids)
    assert got == want


def test_op9_and_op10(spark, docs):
    for name in ("op9_licence_scan", "op10_quality"):
        assert sorted(r.doc_id for r in QUERIES[name](spark, SF).collect()) == [doc for doc, _ in docs]


def test_pipeline(spark):
    """Each stage against the plain version on what the stage before kept."""
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    columns = frame.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in frame.collect()]
        held = [r.row.doc_id for r in kneser_ney.judged(frame, labels).collect() if r.kept] if "quality" in name else []
        copies = {tuple(r.row): r.copies for r in with_copies(frame).collect()} if "mixing" in name else {}
        result = stage(spark, frame, SF)
        frame = spark.createDataFrame(result.collect(), result.schema)
        after = Counter(tuple(r) for r in frame.collect()) if "packing" not in name else Counter()
        if name == "quality classifier":
            assert after == Counter(r for r in before if r[0] in set(held))
        elif name == "exact dedup":
            last = {}
            for r in sorted(before, key=lambda r: r[0]):
                last[brute.lower(r[1])] = r
            assert after == Counter(last.values())
        elif name == "n-gram Jaccard join":
            first = brute.components([(r[0], r[1]) for r in before], 5, 80)
            assert after == Counter(r for r in before if first[r[0]] == r[0])
        elif name == "mixing sources to target weights":
            assert after == +Counter(copies)
        else:
            ids = brute.token_ids([r[1] for r in before], WORD_BPE, 1)
            whole = Counter()
            for r in frame.collect():
                whole[r.doc_id] += r.length
            want = Counter()
            for r, x in zip(before, ids):
                want[r[0]] += len(x)
            assert whole == want
        if name != "packing":
            assert frame.columns == columns
    assert corpus_pipeline.run(spark, SF).count() == frame.count()
