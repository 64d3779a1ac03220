"""The corpus pipeline: documents in, a mix of clean and distinct documents out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage
before it kept. All but the last return the columns of documents; the last
returns how many words the mix takes of each document.

In every stage other columns of docs stay as they are, whatever their names;
an empty table gives no rows; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliograph.llm import decontam, mixing, neardup, outliers, quality
from heliograph.llm.common import read, settle
from heliograph.llm.queries import document_weights


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier, learned from the labelled rows of ``docs``, predicts 0 for.

    A null or blank text has the share of label 1 as its score, and goes if
    that is under the threshold; without labels all rows go. A score at the
    threshold stays. Repeated rows share their fate.
    """
    return quality.keep_good(docs, docs, read(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the fixed rules or the outlier test of its language and source reject.

    A null or blank text fails the fixed rules and goes. Null languages and
    sources are groups like any other. A distance at the cut stays. Repeated
    rows share their fate.
    """
    return outliers.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at a similarity of 0.8.

    The one with the least id stays; a null id is greater than all. Of rows
    of equal id and text one stays, the first by its columns as JSON. Null and
    blank texts are linked with nothing and stay. A similarity of exactly 0.8
    links.
    """
    return neardup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item.

    Null and wordless texts hold none and stay; so does everything where the
    benchmark is empty. Repeated rows share their fate.
    """
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document.

    A null text has size 0, of which nothing is taken. A null source is a
    source. Of repeated rows each counts; keys that tie are ordered by id.
    """
    return mixing.mix(docs, document_weights(spark, sf_dir))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_sources),
]

#: The classifier's votes, signatures and robust distances have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what a stage returns is written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs, name.replace(" ", "-"))
    return docs
