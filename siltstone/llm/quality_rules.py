"""Quality rules whose cutoffs adapt to language and source.

Per document whole-number signals are counted. For every (language, source) a quantile sketch of each
signal's share is kept: counts per thousandth of the share. Such sketches merge by adding counts, in
any order and with the same result, and hold at most 1001 rows, so a language's or the corpus's sketch
is the sum of its sources' sketches. A cutoff is median + SPREADS x max(q75 - q25, least spread); a
group with fewer than MIN_DOCS documents uses the cutoff of its language, or else of the corpus. No cutoff exceeds
BOUND times that of the corpus, so a source that is mostly junk does not set its own standard.
Documents then meet their group's cutoffs in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import shared_dir
from .arrays import SPACE, mix, owners, pair, raw, slices, span_hashes, spans, totals

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
STEPS = 1000
SPREADS = 6
MIN_DOCS = 100
BOUND = 2
# Signal: (numerator, denominator, least spread in thousandths).
SIGNALS = {
    "symbols": ("n_symbols", "word_chars", 10),
    "upper": ("n_upper", "word_chars", 20),
    "dup_lines": ("n_dup_lines", "n_lines", 40),
    "repeats": ("n_repeat_words", "n_words", 20),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")


def count_signals(column: pa.Array) -> dict[str, np.ndarray]:
    """Whole-number signals per row; see `with_signals`."""
    data, offsets = raw(column)
    rows = len(offsets) - 1
    starts, ends = spans(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    hashes = span_hashes(data, starts, ends, lower=False)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    word = ~SPACE[data]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {
        "n_words": np.diff(bounds),
        "word_chars": per_row(word & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(symbol[data]),
        "n_upper": per_row((data >= 65) & (data <= 90)),
    }
    # Lines with a word: from a row's start or a line break to the next one or the row's end.
    breaks = np.flatnonzero(data == 10)
    heads = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks + 1)
    heads = heads[heads < len(data)]
    tails = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, heads)], offsets[np.searchsorted(offsets, heads, side="right")])
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(word, out=sums[1:])
    full = sums[tails] > sums[heads]
    heads, tails = heads[full], tails[full]
    line_of = np.searchsorted(offsets, heads, side="right") - 1
    out["n_lines"] = np.bincount(line_of, minlength=rows)
    lines = mix(span_hashes(data, heads, tails, lower=False) ^ mix((tails - heads).astype(np.uint64)))
    distinct = np.unique(np.stack([line_of.astype(np.uint64), lines]), axis=1)[0] if len(lines) else np.zeros(0, np.uint64)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(distinct.astype(np.int64), minlength=rows)
    # Words covered by a window of WINDOW words that occurs twice or more in the row.
    out["n_repeat_words"] = np.zeros(rows, np.int64)
    if len(hashes) >= WINDOW:
        owner = owners(bounds)
        window = hashes[: len(hashes) - WINDOW + 1]
        for step in range(1, WINDOW):
            window = pair(window, hashes[step : len(hashes) - WINDOW + 1 + step])
        at = np.flatnonzero(owner[WINDOW - 1 :] == owner[: len(owner) - WINDOW + 1])
        key = mix(window[at] ^ mix(owner[at].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        change = np.zeros(len(hashes) + 1, np.int64)
        first = at[order[again]]
        np.add.at(change, first, 1)
        np.add.at(change, first + WINDOW, -1)
        covered = np.cumsum(change[:-1]) > 0
        out["n_repeat_words"] = totals(covered, bounds)
    return out


def with_signals(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with the signal counts of every row; NULL texts count as empty.

    n_words, word_chars (code points in words), n_symbols (of #*$%&|<>), n_upper (A to Z), n_lines (lines
    with a word), n_dup_lines (of those, equal to an earlier one), n_repeat_words (in windows of five
    words found twice or more).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = count_signals(batch.column(len(keep)))
            arrays = [*batch.columns[: len(keep)], *(pa.array(found[name].astype(np.int64)) for name in COUNTS)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *COUNTS])

    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} long" for c in COUNTS])
    return df.select(*keep, F.col(text).alias("text")).mapInArrow(run, schema)


def share(numerator: str, denominator: str):
    """A share in whole thousandths, 0 to STEPS."""
    parts = F.floor(F.col(numerator) * STEPS / F.greatest(F.col(denominator), F.lit(1)))
    return F.least(parts, F.lit(STEPS)).cast("int")


def sketches(signals: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, signal, bucket, n): counts per thousandth, combined map-side."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), share(n, d).alias("bucket")) for s, (n, d, _) in SIGNALS.items()]))
    rows = signals.select(*groups, each.alias("at")).select(*groups, "at.signal", "at.bucket")
    return rows.groupBy(*groups, "signal", "bucket").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(parts: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches of coarser groups as sums of finer ones."""
    return parts.groupBy(*groups, "signal", "bucket").agg(F.sum("n").alias("n"))


def cutoffs(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, docs, cuts): per signal the largest share that passes, in thousandths.

    A quantile is the smallest bucket that at least that share of the documents does not exceed.
    """
    by = [*groups, "signal"]
    up_to = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.withColumns({"up_to": F.sum("n").over(up_to), "docs": F.sum("n").over(Window.partitionBy(*by))})

    def quantile(quarters: int):
        return F.min(F.when(F.col("up_to") * 4 >= F.col("docs") * quarters, F.col("bucket")))

    least = F.create_map(*[F.lit(x) for s, (_, _, spread) in SIGNALS.items() for x in (s, spread)])
    found = ranked.groupBy(*by, "docs").agg(quantile(1).alias("low"), quantile(2).alias("mid"), quantile(3).alias("high"))
    cut = F.col("mid") + SPREADS * F.greatest(F.col("high") - F.col("low"), least[F.col("signal")])
    chosen = [F.max(F.when(F.col("signal") == s, cut)).alias(s) for s in SIGNALS]
    return found.withColumn("__cut", cut).groupBy(*groups, "docs").agg(F.struct(*chosen).alias("cuts"))


def quality_rules(
    df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS
) -> DataFrame:
    """Every row of `df` as key, counts, base_failed, kept, more counts, and the level of the cutoffs used.

    base_failed: fewer than ten words, or more than a fifth of the words in repeated windows. kept:
    not base_failed and no share above its cutoff. NULL languages and sources form groups of their own.
    Repeated keys are judged one by one. A long text is read whole, in segments. An empty table gives no row. Counts are
    checkpointed once, as sketches and filter read them.
    """
    shared_dir(df.sparkSession)
    plain = df.select(F.col(key), F.col(lang).alias("__lang"), F.col(source).alias("__source"), F.col(text).alias("text"))
    signals = with_signals(plain, [key, "__lang", "__source"]).checkpoint()
    finest = sketches(signals, ["__lang", "__source"])
    by_lang = merge_sketches(finest, ["__lang"])
    fine = cutoffs(finest, ["__lang", "__source"]).select(
        F.col("__lang").alias("l"), F.col("__source").alias("s"), F.col("docs").alias("fine_docs"), F.col("cuts").alias("fine_cuts")
    )
    middle = cutoffs(by_lang, ["__lang"]).select(F.col("__lang").alias("l2"), F.col("docs").alias("lang_docs"), F.col("cuts").alias("lang_cuts"))
    whole = cutoffs(merge_sketches(by_lang, []).withColumn("__all", F.lit(1)), ["__all"]).select(F.col("__all").alias("a"), F.col("cuts").alias("all_cuts"))
    level = F.when(F.col("fine_docs") >= min_docs, "source").when(F.col("lang_docs") >= min_docs, "lang").otherwise("corpus")
    chosen = F.when(F.col("fine_docs") >= min_docs, F.col("fine_cuts")).when(F.col("lang_docs") >= min_docs, F.col("lang_cuts")).otherwise(F.col("all_cuts"))
    groups = (
        fine.join(middle, fine.l.eqNullSafe(middle.l2))
        .withColumn("a", F.lit(1))
        .join(whole, "a")
        .select("l", "s", level.alias("level"), chosen.alias("cuts"), "all_cuts")
    )
    joined = signals.join(groups, signals["__lang"].eqNullSafe(groups.l) & signals["__source"].eqNullSafe(groups.s))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = ~base_failed
    for signal, (numerator, denominator, _) in SIGNALS.items():
        passes = passes & (share(numerator, denominator) <= F.least(f"cuts.{signal}", BOUND * F.col(f"all_cuts.{signal}")))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rest = [c for c in COUNTS if c not in first]
    return joined.select(key, *first, base_failed.alias("base_failed"), passes.alias("kept"), *rest, "level")
