"""One query per operator, over whole tables with production parameters, and the SQL giving the same rows."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import configure, shared_dir
from . import decontaminate, language_hd, license_scan, line_dedup, lm_scoring, minhash_forest, phrases, quality_classifier, quality_rules, ranked_search
from . import sentencepiece_codec, sql, token_counts, url_filter

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


# Bytes of one batch between Spark and a Python worker. Several copies are held at a time on both sides.
BATCH_BYTES = 8 << 20
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; the driver serves the file to them."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/siltstone", "zip", root, "siltstone")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def ready(spark: SparkSession) -> None:
    """Let the workers of a session import this package, and hand them texts in batches of a bounded size, whatever the rows."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    ready(spark)
    return configure(spark).read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo `divisor`; a NULL key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, RULES).drop("url")


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scored = lm_scoring.score_with_corpus(docs, remainder("doc_id", 7) != 2, ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), *lm_scoring.SCORES)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document with a word: the numbers of its removed lines, from 0, as text."""
    found = line_dedup.repeated_lines(read(spark, folder, "documents"))
    lines = F.array_join(F.transform("removed", lambda x: x.cast("string")), " ")
    return found.select(F.col("key").alias("doc_id"), F.size("removed").cast("long").alias("n_removed"), lines.alias("removed_lines"))


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    lengths = token_counts.encoded_lengths(docs, RANKS, public_tokenizers.PATTERN)
    # The sums read the histogram more than once; texts are encoded once.
    shared_dir(spark)
    return token_counts.suffix_sums(token_counts.length_histogram(lengths).checkpoint())


def op6_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_forest.near_duplicates(read(spark, folder, "documents"), shingle=2)


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = quality_classifier.fit(docs, labels, remainder("doc_id", 5) != 0)
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    prototypes = language_hd.fit_prototypes(docs.where(remainder("doc_id", 4) != 2))
    found = language_hd.predict(docs, prototypes, ["doc_id"])
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.token_digests(read(spark, folder, "documents"), PIECES, ["doc_id"])


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, folder, "documents"))


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


def op12_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_line_dedup": op3_line_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_language_id": op8_language_id,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_license_scans": op12_license_scans,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES: dict[str, str] = {
    "op1_url_filters": sql.url_filters(RULES),
    "op3_line_dedup": sql.line_dedup(),
    "op6_minhash_near_dedup": sql.near_duplicates(),
    "op10_quality_rules": sql.quality_rules(),
    "op11_phrase_collocations": sql.collocations(),
    "op12_license_scans": sql.license_scans(),
    "op13_ranked_search": sql.ranked_search(),
}
