"""The documents of a corpus, from raw rows to packed training sequences.

STAGES run in order; each reads what the one before wrote. All but the last
return the columns of documents. Rows with NULLs, empty texts, repeated rows and
tables without rows pass as the operators say; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wattshed.llm.common import staged, table
from wattshed.llm.jaccard import keep_one
from wattshed.llm.packing import packed
from wattshed.llm.quality import keep_good
from wattshed.llm.secrets import redact
from wattshed.llm.substrings import cut_repeats


#: Bytes of an Arrow batch, beside its longest text: what a task holds several times over, in the JVM and in Python.
BATCH_BYTES = 2 << 20


def bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with Arrow batches of BATCH_BYTES instead of 64 MB.

    The setting stays with the session: a stage gives a plan, which runs later.
    """

    @wraps(stage)
    def in_small_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return in_small_batches


@bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


@bounded
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


@bounded
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    return cut_repeats(docs)


@bounded
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with credentials masked."""
    return redact(docs)


@bounded
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, packed into sequences."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_copies),
    ("substring_dedup", passages),
    ("secret_scans", secrets),
    ("packing", sequences),
]
#: SQL can't express the packing; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
