"""Documents to packed training sequences: five stages, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglode.llm.exact import without_copies
from loglode.llm.jaccard import one_of_each
from loglode.llm.kneser_ney import good_documents
from loglode.llm.mixing import mixed
from loglode.llm.packing import packed
from loglode.llm.tables import documents, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text of their language is not out of line.

    Null and empty texts stay, and so do documents of a language without trusted text; a null language is a
    language. Rows that repeat are judged alike, ties with the limit stay, an empty table gives an empty
    one, and other columns are kept whatever their names.
    """
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text the one with the largest doc_id.

    A null text is an empty one. Of rows that repeat id and text one stays; a null doc_id is below every
    other. An empty table gives an empty one; other columns are those of the row that stays.
    """
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by four fifths of their shingles of five words the first.

    Null and empty texts, those without words and rows with a null doc_id stay. Rows that repeat a doc_id
    stay or go together. An empty table gives an empty one; other columns are kept.
    """
    return one_of_each(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks.

    A null source is a source, the last in order. Null and empty texts have no words and a rate like the
    others of their source. Rows that repeat draw alike. An empty table gives an empty one; copies have all
    columns of their row.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of a power of two.

    A null or empty text is its end id alone; rows that repeat, as copies of the mix do, are packed each. An
    empty table gives no pieces. Only doc_id and text are used.
    """
    return packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]
#: Language models, hash draws and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each stored and read again for the next."""
    frame = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        frame = stored(stage(spark, frame, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, frame, sf_dir)
