"""A corpus pipeline of five stages, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`documents`. `run` writes each result as Parquet in the shared folder and reads it for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.llm import decontaminate, language_hd, line_dedup, minhash_forest, sentencepiece_codec
from siltstone.llm.queries import PIECES, read, ready
from siltstone.session import scratch_path

# The decisions depend on fitted models and set similarities that SQL does not express.
ORACLE_SQL = None


# A language given is replaced only if the one found beats all others by this much in cosine.
MARGIN = 0.1
# A document of which line dedup leaves a smaller share of its different lines, in characters, goes: what is left of a near copy is no document.
LEAST_LEFT = 1 / 3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, in the language they are written in; texts that are NULL or hold no letter go.

    Prototypes are fitted on all documents with a language. A missing language is filled with the one found, and one that
    the text clearly contradicts (by MARGIN) is replaced by it. Where no document has a language none is found, and
    texts with a letter stay all the same.
    """
    ready(spark)
    prototypes = language_hd.fit_prototypes(docs)
    found = language_hd.predict(docs, prototypes, docs.columns)
    known = F.col("lang_pred") != language_hd.UNKNOWN
    better = known & (F.col("lang").isNull() | (F.col("margin") >= MARGIN))
    return found.where("has_letter").withColumn("lang", F.when(better, F.col("lang_pred")).otherwise(F.col("lang"))).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier one.

    A document left without a word, or with less than LEAST_LEFT of its own different lines, goes; one that repeats itself
    keeps each of its lines once. n_chars follows the text.
    """
    own = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    kept = line_dedup.dedup_lines(docs.withColumn("__chars", F.length(own)))
    left = F.length("text")
    enough = (left > 0) & (left >= F.col("__chars") * LEAST_LEFT)
    return kept.where(enough).withColumn("n_chars", left.cast("long")).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, by five-word shingles and a similarity of 0.8.

    Rows that share a doc_id are judged by their texts, one by one.
    """
    return minhash_forest.one_per_component(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"), keep=docs.columns)
    return found.where(~F.col("contaminated")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the number and digests of each text's ids and decoded text."""
    return sentencepiece_codec.token_digests(docs, PIECES, ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return result
        path = scratch_path(spark, f"pipeline-{name}")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
