"""Corpus pipeline: raw documents to packed training sequences.

Every stage takes all rows that the stage before kept and returns the columns
of `documents` (the last one returns the pieces of packed sequences):

1. quality: documents that fail the base rules or are outliers of their language and source go;
2. near-duplicates: one document of each class stays;
3. personal data: spans are replaced by their kind, n_chars follows the text;
4. mixing: documents are replicated towards the target weights and shuffled globally;
5. packing: the copies are cut into sequences that follow the same weights.

Disk: a stage begins by deleting the inner tables of the stages before it that its
input does not read, so at any time there are the tables of one stage, its input and
its output.  Tables of other queries are not touched.

Cases: an empty table gives no pieces; documents with null texts, languages or sources
count as empty texts and groups of their own (the quality rules reject empty texts);
repeated rows are copies, of which one stays; extra columns travel along to the last
stage and may have any names that no stage adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.llm import mixing, packing, pii, probminhash, quality_mcd
from zonefare.llm.common import free_tables, materialize, read_documents, stored_tables

#: Inner tables of the stages run so far, by application.
_INNER: dict[str, list[str]] = {}


def _frees_earlier(stage):
    """Free what earlier stages left and this one's input does not read, and note the stage's own tables."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        free_tables(spark, _INNER.get(app, []), docs)
        before = set(stored_tables(spark))
        _INNER[app] = [t for t in _INNER.get(app, []) if t in before]
        out = stage(spark, docs, sf_dir)
        _INNER[app] += [t for t in stored_tables(spark) if t not in before]
        return out
    return run_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_mcd.reject_outliers(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return probminhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.poisson_replicate(docs, mixing.TARGET_WEIGHTS).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, mixing.TARGET_WEIGHTS)


STAGES = [(name, _frees_earlier(stage)) for name, stage in (
    ("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
    ("mixing", mix), ("packing", pack))]

#: Banding, EM and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            before = set(stored_tables(spark))
            docs = materialize(docs, f"stage-{name}")
            _INNER[spark.sparkContext.applicationId] += [t for t in stored_tables(spark) if t not in before]
    return docs
