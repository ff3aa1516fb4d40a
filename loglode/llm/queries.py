"""One query per operator over the whole of its tables, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglode.llm.arrow_files import read_documents, write_sequences
from loglode.llm.cover_tree import nearest
from loglode.llm.exact import exact_groups
from loglode.llm.infill import infilled, restored
from loglode.llm.jaccard import near_groups
from loglode.llm.kneser_ney import judged
from loglode.llm.language import document_rows, identify, page_rows
from loglode.llm.licenses import find_licences
from loglode.llm.mixing import with_copies
from loglode.llm.packing import packed
from loglode.llm.secrets import find_secrets
from loglode.llm.spelling import variants
from loglode.llm.tables import documents
from loglode.llm.winnowing import fingerprints, likeness, with_fingerprint, with_next, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return keep


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of all documents."""
    return packed(documents(spark, sf_dir)).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query("op2_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates by distinct shingles of four words, 85 of 100 alike."""
    groups = near_groups(documents(spark, sf_dir), words=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, counted and listed."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda span: span.kind == kind)).cast("long")

    def listed(spans: Column) -> Column:
        parts = F.transform(spans, lambda span: F.concat_ws(":", span.kind, span.start, span.end))
        return F.concat_ws(",", parts)

    base = F.filter("spans", lambda span: span.kind != "random")
    return find_secrets(documents(spark, sf_dir)).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all pages and of all documents."""
    docs = documents(spark, sf_dir)
    pages = page_rows(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    rows = pages.unionByName(document_rows(docs), allowMissingColumns=True)
    found = identify(rows, docs.select("lang", "text"))
    return found.select(
        "doc_id", "page_id", "host", "declared", "suffix", "text_language", "language", "chance"
    )


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of an edited copy of each, and how alike neighbours are.

    The copy ends, in place of its last quarter, as the next document begins.
    """
    rows = with_next(fingerprints(documents(spark, sf_dir)), ["text", "fingerprint"])
    chars = F.length("text")
    quarter = F.floor(chars / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), chars - quarter),
        F.substring(F.col("next_text"), F.lit(1), quarter),
    )
    rows = with_fingerprint(rows.withColumn("edited", edited), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id",
        chars.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written("fingerprint").alias("fingerprint"),
        written("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


@query("op6_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return with_copies(documents(spark, sf_dir)).select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


@query("op7_exact_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for it."""
    return exact_groups(documents(spark, sf_dir))


@query("op8_arrow_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as sequences of token ids, and what the files give back."""
    return read_documents(write_sequences(documents(spark, sf_dir)))


@query("op9_licence_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in all documents."""
    found = find_licences(documents(spark, sf_dir))
    at = F.transform("places", lambda place: place["at"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of all documents under models of trusted text, and which are kept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = judged(documents(spark, sf_dir), labels, columns=["doc_id", "lang"])
    return found.select("row.doc_id", *found.drop("row").columns)


@query("op11_fill_in_middle")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their middle moved, and put back from that."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return restored(infilled(docs)).select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


@query("op12_exact_topk")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents and the form each is a variant of."""
    return variants(documents(spark, sf_dir))


ORACLES["op7_exact_dedup"] = """
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM texts
WINDOW g AS (PARTITION BY t)
"""

ORACLES["op11_fill_in_middle"] = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', doc_id)) AS s FROM documents
), cut AS (
    SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
           ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
           ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4
    FROM hashed
), counted AS (
    SELECT *, len(u) AS n,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
), placed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
    FROM counted
), parts AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
           array_to_string(u[b + 1:n], '') AS x
    FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN concat('<P>', p, '<S>', x, '<M>', m)
                        ELSE concat('<S>', x, '<P>', p, '<M>', m) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

ORACLES["op12_exact_topk"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable AS q JOIN usable AS c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 5
"""
