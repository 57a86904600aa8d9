"""Line dedup by an exact set-similarity join, with DataFrame functions only.

A line is the set of its words. Words are put in one order for the whole corpus, rare ones first; two
sets of similarity t must then share a word among the first n - ceil(t n) + 1 words of both. These
prefixes are joined on the word, and a pair is dropped at once if its lengths differ too much, if the
place of the common word leaves too few words for the overlap, or if bitmaps of the sets differ in more
bits than words may. Sets that share a run of prefix words meet at its first word only. What passes is
verified on the whole sets.

Rarity is a count per hash bucket over all lines, in steps of an eighth of a power of two: a fixed
number of whole numbers, whatever the corpus. Any order gives the same pairs, the rare-first one the
fewest candidates. Words are compared by 54 bits of their hash and the step of their bucket.

Equal sets form a class and take part once; classes that hold more than a thousandth of all lines, of
which there are less than a thousand, are reduced to one line before the shuffle already. A class is known by one
64-bit hash; sets that share it but differ in a second hash get classes of their own.

What is asked of a class is whether an earlier one matches it. Classes that share the least and the greatest word of one
of MASKS orders are likely to match, so each is compared with one of the classes before it with the same two: of the first and the last NEAR, the
one whose bitmaps are most like its own. A class that has found a match by then is looked up no more, though later ones may still
match it. A class that several of these matched leads its group: the others are compared with the leaders they share a prefix word
with, the likeliest few of each. The pairs that the prefix join finds for those still open are verified in the order of their bitmaps'
likeness, a few of each class before the rest. So most members of a group of near copies meet a few others; only those that no such
pair settles go through the prefix join with all the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_path, shared_dir

BUCKETS = 1 << 16
STEPS = 8
# Classes with more than 1 / HOT of all lines are reduced before the shuffle.
HOT = 1000
# Lines up to this many words have one bitmap, longer ones two.
SHORT = 40
# Classes up to this size meet others by equality only: 3 of 4 words are less than 0.8.
EQUAL_ONLY = 3
# Bits of a word's hash in its number; the step of its bucket stands above them.
WORD_BITS = 54
# Orders of words, by their hashes with some bits flipped; the least and the greatest word of an order find likely pairs.
MASKS = 0, 0x2AF7C9B1D35E8614
# Classes before a class, of those with the same least words, that it may be compared with; the first one is another.
NEAR = 8
# A class leads its group if the likely pairs with it have at least this many later classes that are matched.
FOLLOWED = 3
# The pairs of a class are verified in rounds: up to these numbers, then all the others. With leaders there is one round, up to the last number.
TRIES = 1, 8
# Keys of documents to verify are broadcast up to this many bytes and joined beyond.
BROADCAST_BYTES = 64 << 20
# Bytes of a class with its first line, and of a prefix word with its class, in such a broadcast.
KNOWN_BYTES = 320
PREFIX_BYTES = 128


def line_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, th, line_no, line): lines of every text, `th` tells texts that share a key apart."""
    plain = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return plain.select("key", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def line_words(line: Column) -> Column:
    """Words of a line, between blanks; a blank is 0x20 or 0x09 to 0x0D. Empty strings may stand among them."""
    other = F.lit(False)
    for blank in "\t\r\x0b\x0c":
        other = other | F.contains(line, F.lit(blank))
    return F.split(F.when(other, F.translate(line, "\t\r\x0b\x0c", "    ")).otherwise(line), " ")


def rarity_steps(lines: DataFrame) -> Column:
    """An array of BUCKETS whole numbers: the step of every bucket, 0 for the rarest.

    The counts brought to the driver are BUCKETS numbers at most.
    """
    word = lines.select(F.explode(line_words(F.col("line"))).alias("word")).where("word <> ''")
    bucket = F.shiftrightunsigned(F.xxhash64("word"), 32).bitwiseAND(BUCKETS - 1)
    counts = word.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    step = F.floor(F.log2("n") * STEPS).cast("int")
    found = {row.bucket: row.step for row in counts.select("bucket", step.alias("step")).collect()}
    return F.from_json(F.lit("[" + ",".join(str(found.get(b, 0)) for b in range(BUCKETS)) + "]"), "array<int>")


def line_sets(lines: DataFrame, steps: Column) -> DataFrame:
    """Add `words`, the sorted distinct words of each line as numbers, rare ones first, and `hashed`, all words in their order."""

    def number(hashed: Column) -> Column:
        # Never NULL, which lets Spark sort the numbers as they are and not as objects.
        step = F.coalesce(F.get(steps, F.shiftrightunsigned(hashed, 32).bitwiseAND(BUCKETS - 1).cast("int")), F.lit(0))
        return F.shiftleft(step.cast("long"), WORD_BITS).bitwiseOR(hashed.bitwiseAND((1 << WORD_BITS) - 1))

    parts = line_words(F.col("line"))
    parts = F.when(F.array_contains(parts, ""), F.array_remove(parts, "")).otherwise(parts)
    hashed = lines.withColumn("hashed", F.transform(parts, lambda word: F.xxhash64(word)))
    return hashed.withColumn("words", F.sort_array(F.array_distinct(F.transform("hashed", number))))


def _bitmap(words: Column, half: int) -> Column:
    """One bit per word of one half of all words, flipped for each word that falls on it."""

    def flip(bits: Column, word: Column) -> Column:
        own = word.bitwiseAND(64) == 64 * half
        return F.when(own, bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), word.bitwiseAND(63).cast("int")))).otherwise(bits)

    return F.aggregate(words, F.lit(0).cast("long"), flip)


def prefix_length(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100).cast("int") + 1


def compact_lines(lines: DataFrame, steps: Column, percent: int) -> DataFrame:
    """(key, th, line_no, n, d, d2, b1, b2, least, prefix) of all lines with a word.

    d is the class, d2 a second hash of it, `least` has a hash of the least and the greatest word of each order.
    """
    # Asked of the line, as a filter on the set would have it made twice.
    full = lines.where(F.regexp_like("line", F.lit(r"[^ \t-\r]")))
    sets = line_sets(full, steps).withColumn("n", F.size("words"))

    def flipped(mask: int) -> Column:
        return F.transform("hashed", lambda word: word.bitwiseXOR(mask)) if mask else F.col("hashed")

    pairs = [F.xxhash64(F.lit(at), F.array_min(words), F.array_max(words)) for at, words in enumerate(map(flipped, MASKS))]
    # Half of a word's bits are enough to meet by, and fewer bytes to move: pairs are verified in any case.
    prefix = F.slice("words", F.lit(1), prefix_length(F.col("n"), percent))
    return sets.select(
        "key",
        "th",
        "line_no",
        "n",
        F.xxhash64("words").alias("d"),
        F.xxhash64(F.lit(1), "words").alias("d2"),
        F.when(F.col("n") > EQUAL_ONLY, _bitmap(F.col("words"), 0)).otherwise(F.lit(0).cast("long")).alias("b1"),
        F.when(F.col("n") > SHORT, _bitmap(F.col("words"), 1)).otherwise(F.lit(0).cast("long")).alias("b2"),
        F.when(F.col("n") > EQUAL_ONLY, F.array(*pairs)).alias("least"),
        F.when(F.col("n") > EQUAL_ONLY, F.transform(prefix, lambda word: F.hash(word))).alias("prefix"),
    )


def place() -> Column:
    """Where a line stands: by key, NULL keys last, then line number; the text hash tells rows of one key apart."""
    return F.struct(F.col("key").isNull().alias("no_key"), F.col("key"), F.col("line_no"), F.col("th"))


def told_apart(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines without d2, and their classes (d, lines, first). Lines whose sets differ though they share a class get classes of their own."""

    found = stored.groupBy("d").agg(F.count(F.lit(1)).alias("lines"), F.min(place()).alias("first"), (F.min("d2") != F.max("d2")).alias("clash"))
    classes = _kept(found, "classes")
    # Nearly always none: two of 10 ** 9 different sets share a 64-bit hash with a chance of three in a hundred.
    shared = classes.where("clash").select(F.col("d").alias("shared_d")).checkpoint()
    if shared.isEmpty():
        return stored.drop("d2"), classes.drop("clash")
    marked = stored.join(shared, F.col("d") == F.col("shared_d"), "left")
    apart = marked.withColumn("d", F.when(F.col("shared_d").isNull(), F.col("d")).otherwise(F.xxhash64("d", "d2"))).drop("shared_d", "d2")
    return apart, _kept(apart.groupBy("d").agg(F.count(F.lit(1)).alias("lines"), F.min(place()).alias("first")), "classes")


def turn(key: Column, line_no: Column, d: Column) -> Column:
    """The order of classes: by key and line number of the first line, then by the class itself."""
    return F.struct(key.isNull().alias("no_key"), key.alias("key"), line_no.alias("line_no"), d.alias("d"))


def _differ(l, r) -> Column:
    """How many words at least stand in one of two sets only, by their bitmaps."""
    second = F.when((l["n"] > SHORT) & (r["n"] > SHORT), F.bit_count(l["b2"].bitwiseXOR(r["b2"]))).otherwise(0)
    return F.bit_count(l["b1"].bitwiseXOR(r["b1"])) + second


def _may_match(l, r, percent: int) -> Column:
    """Length and bitmap filter between two sets."""
    both = l["n"] + r["n"]
    lengths = F.least(l["n"], r["n"]) * 100 >= F.greatest(l["n"], r["n"]) * percent
    return lengths & ((both - _differ(l, r)) * (100 + percent) >= both * 2 * percent)


def _likeness(l, r) -> Column:
    """Thousandths of the words of two sets that may be common; grows with the similarity the bitmaps allow."""
    both = l["n"] + r["n"]
    return F.floor((both - _differ(l, r)) * 1000 / both).cast("int")


def _positional(l, r, percent: int) -> Column:
    """Whether enough words can follow the common one on both sides."""
    return F.least(l["left"] - l["at"], r["left"] - r["at"]) * (100 + percent) >= (l["n"] + r["n"]) * percent


def once_if_hot(stored: DataFrame, classes: DataFrame) -> DataFrame:
    """Lines of sets that may meet others, those of hot classes reduced to the first line."""
    total = classes.agg(F.sum("lines")).first()[0] or 0
    # Fewer than HOT classes can hold more than 1 / HOT of all lines each.
    hot = classes.where(F.col("lines") * HOT > total).select(F.col("d").alias("hot_d"), F.col("first").alias("hot_first"))
    met = stored.where(F.col("n") > EQUAL_ONLY).join(F.broadcast(hot), F.col("d") == F.col("hot_d"), "left")
    return met.where(F.col("hot_first").isNull() | (place() == F.col("hot_first")))


def likely_pairs(firsts: DataFrame, percent: int) -> DataFrame:
    """Pairs (later, earlier) of each class with one before it that has the same least and greatest word of an order.

    A class has one pair at most for each order, whatever the size of its group: of the first class and the NEAR
    before it, the one with the greatest likeness.
    """
    own = {c: F.col(c) for c in ("d", "n", "b1", "b2")}
    rows = firsts.select(*own, "key", "line_no", F.explode("least").alias("run"))
    before = Window.partitionBy("run").orderBy(F.col("key").isNull(), "key", "line_no", "d")
    head = F.first(F.struct(*own)).over(before.rowsBetween(Window.unboundedPreceding, 0))
    last = F.collect_list(F.struct(*own)).over(before.rowsBetween(-NEAR, -1))
    near = rows.select("run", *own, head.alias("head"), last.alias("last")).where(F.size("last") > 0)
    fit = F.filter(F.array_append("last", F.col("head")), lambda x: _may_match(x, own, percent))
    best = F.array_max(F.transform(fit, lambda x: F.struct(_likeness(x, own).alias("likeness"), x["d"].alias("d"))))
    return near.select(F.col("d").alias("later"), best["d"].alias("earlier")).where("earlier IS NOT NULL").distinct()


def first_lines(stored: DataFrame, classes: DataFrame, once: bool = True) -> DataFrame:
    """One line, the first, of each class that may meet others; unless `once`, a class whose first line stands in equal rows comes with each."""
    lines = once_if_hot(stored, classes)
    known = classes.where("lines > 1").select(F.col("d").alias("known_d"), F.col("first").alias("known_first"))
    known = F.broadcast(known) if known.count() * KNOWN_BYTES <= BROADCAST_BYTES else known
    rows = lines.join(known, F.col("d") == F.col("known_d"), "left")
    # Rows with equal key and text have their lines at one place.
    if not once:
        return rows.where(F.col("known_d").isNull() | (place() == F.col("known_first"))).select(*stored.columns)
    copied = rows.where(place() == F.col("known_first")).distinct()
    return rows.where("known_d IS NULL").unionByName(copied).select(*stored.columns)


def known_classes(settled: DataFrame) -> DataFrame:
    known = settled.select(F.col("d").alias("settled_d"))
    return F.broadcast(known) if settled.count() * 8 <= BROADCAST_BYTES else known


def prefix_rows(classes: DataFrame) -> DataFrame:
    """One row per class and prefix word, with the place of the word and the word before it."""
    rows = classes.select("size", "d", "b1", "b2", "key", "line_no", "prefix", F.posexplode("prefix").alias("at", "word"))
    return rows.withColumn("before", F.get("prefix", F.col("at") - 1)).drop("prefix")


def meeting(later: DataFrame, earlier: DataFrame, percent: int, small: bool = False) -> DataFrame:
    """(later, earlier, likeness) of `prefix_rows` that share a word and pass all filters; `small` allows to broadcast the earlier ones.

    Sets that agree in many words of their prefixes would meet at each of them. A word is skipped if the words before it in
    both prefixes are the same too: the sets meet there, as all filters that pass here pass there. So a pair is made once for
    each run of common words, not for each word.
    """
    columns = [c for c in later.columns if c != "word"]
    left, right = (
        rows.select("word", *[F.col(c).alias(f"{side}_{c}") for c in columns]) for rows, side in ((later, "l"), (earlier, "r"))
    )
    l, r = ({c: F.col(f"{side}_{c}") for c in columns} | {"n": F.abs(f"{side}_size")} for side in "lr")
    before = turn(r["key"], r["line_no"], r["d"]) < turn(l["key"], l["line_no"], l["d"])
    # With a negative size no words are left, so a settled later class passes no more.
    placed = _positional({**l, "left": l["size"]}, {**r, "left": r["n"]}, percent)
    run = ~F.coalesce(l["before"] == r["before"], F.lit(False))
    right = F.broadcast(right) if small else right
    met = left.join(right, (left["word"] == right["word"]) & run & placed & _may_match(l, r, percent) & before)
    return met.select(l["d"].alias("later"), r["d"].alias("earlier"), _likeness(l, r).alias("likeness"))


def met_pairs(firsts: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """(later, earlier, likeness) of classes that share a prefix word and pass all filters, with an open later class."""
    flagged = firsts.join(known_classes(settled), F.col("d") == F.col("settled_d"), "left")
    # The size of a settled class is negative: the two sides of the join stay one shuffle as long as no column or filter is for one side only.
    size = F.when(F.col("settled_d").isNull(), F.col("n")).otherwise(-F.col("n"))
    rows = prefix_rows(flagged.withColumn("size", size)).repartition("word")
    return meeting(rows, rows, percent)


def group_leaders(likely: DataFrame, settled: DataFrame) -> DataFrame:
    """Classes (d) that stand in likely pairs with at least FOLLOWED later classes that are settled."""
    followers = likely.join(settled.select(F.col("d").alias("later")), "later", "left_semi").groupBy(F.col("earlier").alias("d"))
    return followers.agg(F.count(F.lit(1)).alias("followers")).where(F.col("followers") >= FOLLOWED).select("d")


def led_pairs(firsts: DataFrame, settled: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """(later, earlier, likeness) of open classes and the leaders before them, as in `met_pairs`. `firsts` may hold a class more than once."""
    firsts = firsts.withColumn("size", F.col("n"))
    chosen = prefix_rows(firsts.join(known_classes(leaders), F.col("d") == F.col("settled_d"), "left_semi").dropDuplicates(["d"])).checkpoint()
    open_rows = prefix_rows(firsts.join(known_classes(settled), F.col("d") == F.col("settled_d"), "left_anti"))
    return meeting(open_rows, chosen, percent, small=chosen.count() * PREFIX_BYTES <= BROADCAST_BYTES)


def ranked_pairs(met: DataFrame) -> DataFrame:
    """Pairs (later, earlier, try), each once. `try` numbers the pairs of a later class, the greatest likeness first."""
    order = Window.partitionBy("later").orderBy(F.desc("likeness"), "earlier")
    return met.distinct().select("later", "earlier", F.row_number().over(order).alias("try"))


def matched_classes(df: DataFrame, stored: DataFrame, classes: DataFrame, steps: Column, key: str, text: str, percent: int) -> DataFrame:
    """Classes (d) that match one with an earlier first line.

    Likely pairs and pairs with leaders settle most of them, and the prefix join looks for matches of the others only. The pairs
    it finds are verified in rounds, each for the classes still open, the last with all pairs there are.
    """
    firsts = first_lines(stored, classes)
    likely = likely_pairs(firsts, percent).checkpoint()
    settled = matched(likely, class_sets(df, likely, classes, steps, key, text), percent).checkpoint()
    leaders = group_leaders(likely, settled).checkpoint()
    if not leaders.isEmpty():
        led = ranked_pairs(led_pairs(first_lines(stored, classes, once=False), settled, leaders, percent))
        led = led.where(F.col("try") <= TRIES[-1]).checkpoint()
        settled = settled.unionByName(matched(led, class_sets(df, led, classes, steps, key, text), percent)).checkpoint()
    ranked = ranked_pairs(met_pairs(firsts, settled, percent)).checkpoint()
    sets = class_sets(df, ranked, classes, steps, key, text)
    low = 0
    for high in (*TRIES, None):
        chosen = ranked.where(F.col("try") > low)
        chosen = chosen if high is None else chosen.where(F.col("try") <= high)
        still = chosen.join(settled.select(F.col("d").alias("later")), "later", "left_anti")
        settled = settled.unionByName(matched(still, sets, percent)).checkpoint()
        low = high
    return settled


def class_sets(df: DataFrame, pairs: DataFrame, classes: DataFrame, steps: Column, key: str, text: str) -> DataFrame:
    """(d, words) of all classes in pairs, once each; sets are read again from the lines that stand for a class."""
    met = pairs.select(F.col("later").alias("d")).distinct().unionByName(pairs.select(F.col("earlier").alias("d")).distinct()).distinct()
    needed = met.join(classes, "d").select("d", "first.key", "first.th", "first.line_no").checkpoint()
    docs = needed.select("key", "th").distinct()
    if docs.count() * 16 <= BROADCAST_BYTES:
        docs = F.broadcast(docs)
    lines = line_rows(df, key, text)
    # The text's hash is checked first, so that only lines of documents needed are cut into words.
    lines = lines.join(docs.withColumnsRenamed({"key": "k", "th": "t"}), lines["key"].eqNullSafe(F.col("k")) & (lines["th"] == F.col("t")), "left_semi")
    wanted = needed.withColumnsRenamed({"key": "k", "th": "t", "line_no": "l"})
    same = lines["key"].eqNullSafe(F.col("k")) & (lines["th"] == F.col("t")) & (lines["line_no"] == F.col("l"))
    return line_sets(lines.join(wanted, same).select("d", "line"), steps).select("d", "words").dropDuplicates(["d"]).checkpoint()


def matched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Later classes (d) of the pairs whose whole sets are similar enough."""
    later, earlier = (sets.select(F.col("d").alias(c), F.col("words").alias(f"{c}_words")) for c in ("later", "earlier"))
    sizes = pairs.select("later", "earlier").join(later, "later").join(earlier, "earlier").select(
        "later", F.size(F.array_intersect("later_words", "earlier_words")).alias("common"), (F.size("later_words") + F.size("earlier_words")).alias("sizes")
    )
    return sizes.where(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * percent).select(F.col("later").alias("d")).distinct()


def _kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared folder, in less space than a checkpoint takes, and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(key, th, removed) per distinct (key, text): removed are the numbers, from 0, of later matches.

    A line is a later match if a line that stands before it, in its own text or another, has a word set of
    Jaccard similarity of at least `percent` / 100; whether that line is removed itself does not matter.
    Lines stand in order of key (NULL last) and line number; lines of several texts with one key and line
    number stand in the order of their classes, copies of one line there side by side. Lines without words are never
    removed. Equal rows (key and text) have equal lines removed. NULL texts and texts without a word give no row.
    """
    shared_dir(df.sparkSession)
    lines = line_rows(df, key, text)
    steps = rarity_steps(lines)
    stored, classes = told_apart(_kept(compact_lines(lines, steps, percent), "lines"))
    settled = matched_classes(df, stored, classes, steps, key, text, percent).withColumn("settled", F.lit(True))
    # Classes of one line without an earlier match remove nothing.
    own = turn(F.col("first.key"), F.col("first.line_no"), F.col("d"))
    known = classes.join(settled, "d", "left").where("lines > 1 OR settled").select("d", own.alias("own"), F.col("settled").isNotNull().alias("settled"))
    marked = stored.select("key", "th", "line_no", "d").join(known, "d", "left")
    later = F.col("settled") | (turn(F.col("key"), F.col("line_no"), F.col("d")) > F.col("own"))
    gone = F.coalesce(later, F.lit(False))
    return marked.groupBy("key", "th").agg(F.sort_array(F.collect_set(F.when(gone, F.col("line_no")))).alias("removed"))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """`df` without repeated lines; other columns stay as they are.

    A text of which every line with a word is removed becomes empty. NULL texts stay NULL. Joined on key
    and text hash, so rows that share a key are kept apart.
    """
    found = repeated_lines(df, key, text, percent).select(F.col("key").alias("__key"), F.col("th").alias("__th"), F.col("removed").alias("__removed")).where(F.size("removed") > 0)
    keyed = df.withColumn("__text_hash", F.xxhash64(F.col(text)))
    same = keyed[key].eqNullSafe(F.col("__key")) & (F.col("__text_hash") == F.col("__th"))
    parts = F.split(F.col(text), "\n")
    kept = F.filter(parts, lambda line, at: ~F.array_contains(F.col("__removed"), at))
    words_left = F.exists(kept, lambda line: F.regexp_like(line, F.lit(r"[^ \t-\r]")))
    changed = F.when(words_left, F.array_join(kept, "\n")).otherwise("")
    joined = keyed.join(found, same, "left")
    return joined.withColumn(text, F.when(F.col("__removed").isNull(), F.col(text)).otherwise(changed)).select(*df.columns)
