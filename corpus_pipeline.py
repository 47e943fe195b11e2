"""From raw documents to a training mix: five stages, each written and read again.

``run(spark, sf_dir)`` applies ``STAGES`` to the documents of a folder:

1. documents that the quality classifier scores under ``KEEP_SCORE`` go;
2. of each group of near-duplicates (five-word shingles, similarity 0.8) the
   document with the smallest id stays;
3. passages of ``PASSAGE_WORDS`` words or 400 bytes that occur elsewhere are cut
   out of the texts;
4. documents contaminated by the benchmark go;
5. sources are mixed to their target weights.

Stages 1 to 4 return the columns of ``documents``; ``n_chars`` follows the text.
A text that stage 3 leaves empty stays as an empty document, of size 0 in the
mix. The mix says for each document how many of its words are taken.

The stages can't be said in SQL (a classifier is trained, components are found
by iteration); ``tests/llm`` compares them with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import decontaminate, minhash_dedup, mixing, nbsvm, suffix_dedup
from tidemill.llm.common import prepared, stored
from tidemill.tables import Tables

KEEP_SCORE = 0.3
#: Passages of so many words go. They are found as strings of ``PASSAGE_BYTES``: with spaces, words of four
#: letters take 250, and strings must be shorter than the passages that hold them.
PASSAGE_WORDS, PASSAGE_BYTES = 50, 240
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return nbsvm.accepted(docs, Tables(spark, sf_dir).labels, KEEP_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; of repeated rows, one."""
    return minhash_dedup.deduplicated(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; characters cut in two go."""
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES, PASSAGE_WORDS)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontaminate.clean(docs, Tables(spark, sf_dir).benchmark)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(docs).taken()


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("suffix dedup", repeated_strings),
    ("decontamination", benchmark_free),
    ("source mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
