"""Corpus pipeline: toxicity, near duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the columns of
documents. ``run`` writes what a stage keeps as Parquet into the shared checkpoint folder and hands it on re-read.
The label model, the n-gram join and best-fit search can't be said in SQL, so the pipeline has none; tests
hold it against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm.common import keep
from tabula.llm.mixing import mix
from tabula.llm.ngram_join import jaccard_components
from tabula.llm.packing import pack
from tabula.llm.pii import sanitise
from tabula.llm.toxicity import drop_toxic
from tabula.session import load

#: Up to this many ids of documents that go are broadcast, more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier predicts toxic."""
    return drop_toxic(docs, load(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by shared word shingles.

    Documents without words or without an id are no one's duplicate. Of rows that repeat a doc_id one stays.
    """
    found = jaccard_components(docs.select("doc_id", "text"))
    drop = keep(
        found.where("doc_id <> component_id").select("doc_id").distinct(),
        "pipeline-duplicates",
    )
    few = drop.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(drop) if few else drop, "doc_id", "left_anti").select(*docs.columns)
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, "doc_id", "left_anti").unionByName(once).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, revealing terms generalised or removed."""
    return sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target words."""
    return mix(docs, seed=0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document: (doc_id, part, n_words, shard, bin, start)."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_join", near_duplicate_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
