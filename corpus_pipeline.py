"""From raw documents to packed training sequences, in five stages over the operators of ``llm``.

Each stage works on all that its predecessor kept. Between stages the documents are written as Parquet
to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import cleared, lean_batches
from seriesloom.llm.cotraining import fit_views, score_quality
from seriesloom.llm.minhash import one_of_each
from seriesloom.llm.mixing import mixed_rows, word_count
from seriesloom.llm.packing import packed_documents
from seriesloom.llm.pii import redacted_rows
from seriesloom.llm.queries import tokenizer_path
from seriesloom.sources.readers import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject.

    Each row is scored, repeated ones alike; null and empty texts are scored by what else is known of the row.
    Rows of ``labels`` without a document or a label are not learnt from, and without labels all stay. Other
    columns pass through; no documents give none.
    """
    lean_batches(spark)
    scored = score_quality(docs, fit_views(docs, read_table(spark, sf_dir, "labels")))
    return scored.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles.

    The smallest ``doc_id`` stays, null ones last, of rows with one key the smallest by a hash of its columns;
    each row is decided on its own. Texts without words, null and empty ones, all stay; of repeated rows one.
    """
    lean_batches(spark)
    return one_of_each(docs, "doc_id", "text", width=5)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind.

    ``n_chars`` is counted anew where a text changed; null texts stay null, empty and repeated rows as they are.
    """
    lean_batches(spark)
    return redacted_rows(docs, "text", "n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for.

    A null source is one of its own and null texts have no words; a source without words goes. Each row is given
    as often as its copies say, repeated rows on their own; no documents give none.
    """
    lean_batches(spark)
    return mixed_rows(docs, "doc_id", word_count(F.col("doc.text")), "source")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: its token ids and their place in a sequence of 4096.

    A null or empty text is its end token alone; texts of any length are cut into pieces; a copy is packed on
    its own; other columns are left out.
    """
    lean_batches(spark)
    return packed_documents(docs, "doc_id", "text", tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("packing", packing)]
ORACLE_SQL = None  # neither the classifier nor the tokenizer can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the ``documents`` of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # A stage's own tables go when its output is written.
        with cleared(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
