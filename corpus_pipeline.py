"""A corpus pipeline of the training-data operators, in stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is written as
Parquet and read again before the next one. All stages but the last return the columns of ``documents``.

1. language: the predicted language becomes ``lang``; documents without a letter or far from every language go.
2. near_duplicates: of each class of documents that links of Jaccard 0.75 on 5-word shingles tie together, the one with the
   smallest id stays. Rows that share that id stay once, as the one with the smallest digest; rows without an id stay.
3. decontamination: documents in which a benchmark item occurs, within its edit budget, go.
4. secrets: every secret is replaced by a mask; ``n_chars`` follows the text.
5. packing: the documents as sequences of tokens, one row a piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqgrid.llm import decontamination, language_id, ngram_join, packing, secret_scan
from aqgrid.llm.common import discard, written
from aqgrid.llm.queries import table, tokenizer_path

#: Predictions below this score count as no language; with four languages a blind guess has 0.25.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language_id.identify(docs, language_id.train(docs, language_id.training_rows(docs)))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = ngram_join.ngram_join(docs)
    gone = classes.where("doc_id <> component_id").select("doc_id").distinct()
    # rows of one id are reduced within each task before they meet; the join then finds them dealt by id
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
    once = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(row)
    kept = once.hint("merge").join(gone, "doc_id", "left_anti").select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("packing", pack),
]

#: SQL can't express cross-parsing, banded alignment or the tokenizer; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returned is removed once the next one is written; the last one, which reads
    its documents no more when its pieces are written, lets go of them too."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if last is not None:
            discard(last)
        last = docs
    out = STAGES[-1][1](spark, docs, sf_dir)
    discard(docs)
    return out
