"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and reads it again as the next stage's documents. All stages
but the last return the columns of ``documents`` as they came:

1. toxicity: documents that the toxicity field rejects go (op 9);
2. near_duplicates: one document of each n-gram Jaccard group stays (op 7);
3. decontamination: documents contaminated by the benchmark go (op 10);
4. pii: personal data and secrets get surrogates (op 6);
5. packing: what is left becomes sequences of 4096 tokens (op 2).

An empty table passes through all stages; nulls, ties, very long texts, extra
columns and clashing names are treated as the operators' docstrings say. A
stage's table is deleted when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, ngram_join, packing, pii, toxicity
from shelfwise.llm.common import drop_stage, read, stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score, by a field fitted on the labelled part of
    ``docs``, is below the threshold. Null and wordless texts stay; repeated
    rows are judged alike; without labels of both classes all rows stay."""
    labels = toxicity.learned_rows(read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.remove_toxic(docs, toxicity.learn(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id (of
    several with that id any one); rows without words or without an id stay.
    An id that repeats with different texts loses only its copies."""
    return ngram_join.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which less than a twentieth of the words lies in benchmark
    windows. Null and wordless texts stay; an empty benchmark keeps all."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, texts with surrogates under the session's key; a null text
    stays null."""
    return pii.replace_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row's tokens with their place in a sequence; a null
    text is its end token alone."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the learned and tokenising stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            drop_stage(before)
        before = docs
    return docs
