"""Token ids, packing and Arrow files."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from brute import ROWS
from loglode.llm.arrow_files import read_documents, sequences, write_sequences
from loglode.llm.packing import packed, piece_lengths, write_buckets
from loglode.llm.tokens import BYTE_BPE, WORD_BPE, encoded

PARTS = ["a", "B", " ", "\n", ".", ",", "'", "s", "é", "́", "1", "-", "\t", "😀", "Σ", "ll", "\xa0", "日"]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_pieces_give_the_ids_of_the_whole(path):
    rng = random.Random(9)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(4000)]
    texts += ["".join(rng.choices([*PARTS, "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>"], k=9)) for _ in range(500)]
    texts += [None, "<|endoftext|> x", "x <|endoftext|> y", "x <|EndOfText|> y", "don't WE'LL.ok", *[row[1] for row in ROWS]]
    want = [ids[:-1].tolist() for ids in brute.token_ids(texts, path, 0)]
    assert [ids.tolist() for ids in encoded(pa.array(texts), path)] == want


def test_piece_lengths():
    for tokens in [1, 2, 3, 2047, 2048, 2049, 10_000]:
        lengths = piece_lengths(tokens, 2048)
        assert sum(lengths) == tokens and all(x & x - 1 == 0 and x <= 2048 for x in lengths)


def test_packed(spark, small, empty, tmp_path):
    got = packed(small).collect()
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    want = {}
    for (doc, text, *_), ids in zip(ROWS, brute.token_ids([r[1] for r in ROWS], WORD_BPE, 1)):
        want.setdefault((doc, len(ids)), []).append(ids.tobytes())
    found = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.sequence_id)):
        assert len(r.ids) == 4 * r.length and r.length & r.length - 1 == 0
        if r.start == 0:
            found.setdefault((r.doc_id, r.doc_tokens), []).append(b"")
        found[r.doc_id, r.doc_tokens][-1] += r.ids
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    assert packed(empty).count() == 0
    write_buckets(packed(small), str(tmp_path / "buckets"))
    again = spark.read.parquet(str(tmp_path / "buckets"))
    assert again.filter("bucket <> length").isEmpty() and again.count() == len(got)
    with pytest.raises(ValueError, match="power of two"):
        packed(small, longest=1000)


def test_arrow_files(spark, small, empty):
    manifest = write_sequences(small, length=64)
    got = sorted(tuple(r) for r in read_documents(manifest).collect())
    order = sorted(range(len(ROWS)), key=lambda i: (ROWS[i][0], ROWS[i][1] is not None, ROWS[i][1] or ""))
    ids = brute.token_ids([r[1] for r in ROWS], BYTE_BPE, 0)
    start, want = 0, []
    for i in order:
        want.append((ROWS[i][0], start, len(ids[i]), brute.checksum(ids[i])))
        start += len(ids[i])
    assert got == want
    assert read_documents(write_sequences(empty)).count() == 0
    files = manifest.collect()
    for file in files:
        table = sequences(file.file)
        assert table.num_rows == file.sequences and table.schema.field("ids").type == pa.list_(pa.uint16(), 64)
        mask = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["mask"].chunks])
        assert mask.sum() == file.tokens and mask[: file.tokens].all()


def test_null_id_comes_first(spark):
    frame = spark.createDataFrame([(5, "b"), (None, "a")], "doc_id bigint, text string")
    got = sorted(read_documents(write_sequences(frame)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 5]


def test_special_strings_are_the_tokens_they_name():
    ids = [x.tolist() for x in encoded(pa.array(["x <|endoftext|> y", "x <|endoftext| > y"]), BYTE_BPE)]
    assert 50256 in ids[0] and 50256 not in ids[1]


def test_rows_that_share_a_doc_id_are_several_files(spark):
    rows = spark.range(0, 400, 1, 4).selectExpr("7L as doc_id", "concat(cast(id as string), repeat(' x', 50)) as text")
    # Else Spark joins ranges as short as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_sequences(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1 and read_documents(manifest).count() == 400
