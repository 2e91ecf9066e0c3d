"""A corpus pipeline: filter, deduplicate, decontaminate and tokenize documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``; the last returns ``doc_id, n_tokens, token_ids, decoded_sha256``.

Edge cases, for all stages: an empty table gives no rows; null and empty texts are kept
and have no tokens; a null doc_id is kept; rows that share a doc_id are judged each by
its own text; extra columns pass through all but the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eqscene.llm._common import read_table, staged
from eqscene.llm.decontaminate import drop_contaminated
from eqscene.llm.line_dedup import dedup_lines
from eqscene.llm.order_minhash import drop_near_duplicates
from eqscene.llm.quality import keep_good
from eqscene.llm.sentencepiece_lattice import encode


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand earlier in the corpus."""
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark passages."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the digest of the text that they decode to."""
    coded = encode(docs, decoded=True)
    return coded.select("doc_id", "n_tokens", "token_ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: A trained classifier is a stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
