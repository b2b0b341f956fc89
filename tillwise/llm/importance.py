"""Importance resampling toward a target distribution, with the features of repeated lines counted once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import written

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # between words; a newline is one of them
HAS_WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
HOT_PARTS = 1024  # a line with over one part in HOT_PARTS of all lines is hot: there are fewer than HOT_PARTS


def words_of(text: Column) -> Column:
    """Runs of digits, letters (A-Z in lower case) and characters beyond ASCII; null has none."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, BREAKS), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """Newlines cut a text into lines. No word holds a newline, so words are those of the lines."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _bucket(run: Column, buckets: int) -> Column:
    return (F.crc32(run.cast("binary")) % buckets).cast("int")


def line_features(words: Column, longest: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to ``longest`` words of one line, repeats kept."""
    single = F.transform(words, lambda w: _bucket(w, buckets))
    if longest == 1:
        return single

    def runs(k: int) -> Column:
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: _bucket(F.array_join(F.slice(words, i, F.lit(k)), " "), buckets))

    return F.concat(single, *[runs(k) for k in range(2, longest + 1)])


def crossing_features(text: Column, longest: int, buckets: int) -> Column:
    """Buckets of the runs of 2 to ``longest`` words that span a newline, repeats kept.

    A run reaches at most longest - 1 words into a line, so only these words of both ends of a line are looked at; a null
    stands for what is left out between them, and no run goes over it.
    """
    reach = longest - 1

    def ends(line: Column, at: Column) -> Column:
        words = words_of(line)
        trimmed = F.when(
            F.size(words) > 2 * reach,
            F.concat(F.slice(words, 1, reach), F.array(F.lit(None).cast("string")), F.slice(words, -reach, reach)),
        ).otherwise(words)
        return F.transform(trimmed, lambda w: F.struct(w.alias("word"), at.alias("line")))

    row = F.flatten(F.transform(lines_of(text), ends))

    def runs(k: int) -> Column:
        starts = F.when(F.size(row) >= k, F.sequence(F.lit(1), F.size(row) - (k - 1))).otherwise(F.array().cast("array<int>"))
        crossing = F.filter(
            F.transform(starts, lambda i: F.slice(row, i, F.lit(k))),
            lambda run: (run[0]["line"] != run[k - 1]["line"]) & F.forall(run, lambda w: w["word"].isNotNull()),
        )
        return F.transform(crossing, lambda run: _bucket(F.array_join(F.transform(run, lambda w: w["word"]), " "), buckets))

    return F.concat(*[runs(k) for k in range(2, longest + 1)])


def distinct_lines(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """key (128 bits of the line's SHA-256), n (occurrences), words, features: one written row for each distinct line with a word.

    Equal lines of a task are counted before the shuffle, so a line with a third of all occurrences is one row a task. Words are
    cut and hashed here only, once for each distinct line.
    """
    counted = docs.select(F.explode(lines_of(F.col("text"))).alias("_line")).groupBy("_line").agg(F.count("*").alias("n"))
    return written(
        counted.select(line_key(F.col("_line")).alias("key"), "n", words_of(F.col("_line")).alias("_words"))
        .where(F.size("_words") > 0)
        .select("key", "n", F.size("_words").cast("long").alias("words"), line_features(F.col("_words"), longest, buckets).alias("features"))
    )


def line_key(line: Column) -> Column:
    return F.substring(F.unhex(F.sha2(line.cast("binary"), 256)), 1, 16)


def feature_counts(lines: DataFrame, crossing: DataFrame | None) -> DataFrame:
    """bucket, n: features of distinct lines times occurrences, and the crossing ones."""
    counts = lines.select(F.explode("features").alias("bucket"), "n").groupBy("bucket").agg(F.sum("n").alias("n"))
    if crossing is not None:
        across = crossing.select(F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
        counts = counts.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))
    return counts


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket, gain: floor(1000 * ln of the smoothed ratio of shares), target over source, for every bucket."""
    both = (
        source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t"))
    )
    every = Window.partitionBy()  # one row a bucket
    ratio = ((F.col("t") + 1) * (F.sum("s").over(every) + buckets)) / ((F.col("s") + 1) * (F.sum("t").over(every) + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).cast("long").alias("gain"))


def _gain_sum(features: Column, table: Column) -> Column:
    return F.aggregate(features, F.lit(0).cast("long"), lambda total, b: total + table[b])


def resample(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
    least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """Draws ``percent`` of the documents with at least ``least_words`` words, by hashed-n-gram importance weights.

    Features are all runs of 1 to ``longest`` consecutive words, hashed into ``buckets``. Lines are the unit of work: equal lines of the
    corpus are counted first, each distinct line's features are computed once and counted as often as the line occurs, and runs that
    span a newline are added from the line ends. The gains, one number for each bucket, go to the distinct lines as one array; a
    document's weight is the sum over its lines, joined by key. Lines that are hot (under HOT_PARTS of them, whatever
    the input) are broadcast, so no key of the join has more than one part in HOT_PARTS of the lines. The draw adds Gumbel
    noise from a hash of seed and doc_id, and takes the greatest scores by a range sort over the whole order; ranks are places in a
    range plus the sizes of the ranges before.

    Returns one row for each row of ``docs``: doc_id, n_words, n_features, weight, score, rank (null where not drawn). Null and
    empty texts have no features and weight 0; a null doc_id hashes as empty text and comes last among equal scores; rows that
    repeat a doc_id each have a score and a place of their own; an empty table gives an empty result, an empty target counts as zeros.
    """
    own = docs.select("doc_id", "text")
    lines = distinct_lines(own, longest, buckets)
    wanted = distinct_lines(target.select("text"), longest, buckets)
    across = across_wanted = None
    if longest > 1:
        across = own.select(crossing_features(F.col("text"), longest, buckets).alias("features"))
        across_wanted = target.select(crossing_features(F.col("text"), longest, buckets).alias("features"))
    gain = written(gains(feature_counts(lines, across), feature_counts(wanted, across_wanted), buckets).coalesce(1))
    # One number for each bucket, in the order of the buckets.
    table = gain.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "gain"))), lambda g: g["gain"])).scalar()
    weighed = written(
        lines.withColumn("_gains", table).select(
            "key", "n", "words", F.size("features").cast("long").alias("features"),
            _gain_sum(F.col("features"), F.col("_gains")).alias("weight"),
        )
    )
    hot = weighed.where(F.col("n") > weighed.agg(F.sum("n") / HOT_PARTS).scalar()).select(
        F.col("key").alias("_key"), F.struct("words", "features", "weight").alias("_hot"),
    )
    rows = own.withColumn("_row", F.monotonically_increasing_id())
    if longest > 1:
        features = crossing_features(F.col("text"), longest, buckets)
        rows = rows.withColumn("_gains", table).withColumn("_across", features).withColumn(
            "_own", F.struct(F.size("_across").cast("long").alias("features"), _gain_sum(F.col("_across"), F.col("_gains")).alias("weight"))
        ).drop("_gains", "_across")
    else:
        rows = rows.withColumn("_own", F.struct(F.lit(0).cast("long").alias("features"), F.lit(0).cast("long").alias("weight")))
    keyed = F.transform(F.filter(lines_of(F.col("text")), lambda x: x.rlike(HAS_WORD)), line_key)
    # One row for each line; the first (or only) one of a document carries what belongs to no line.
    found = written(
        rows.select("_row", "doc_id", "_own", F.posexplode_outer(keyed).alias("_at", "key"))
        .join(F.broadcast(hot), F.col("key") == F.col("_key"), "left")
        .select("_row", "doc_id", F.when(F.coalesce("_at", F.lit(0)) == 0, F.col("_own")).alias("_own"), "key", "_hot")
    )
    rest = found.where("key IS NOT NULL AND _hot IS NULL").select("_row", "doc_id", "_own", "key").join(weighed, "key").select(
        "_row", "doc_id", "_own", F.struct("words", "features", "weight").alias("_line")
    )
    known = found.where("key IS NULL OR _hot IS NOT NULL").select("_row", "doc_id", "_own", F.col("_hot").alias("_line"))
    zero = F.lit(0).cast("long")

    def total(*names: str) -> Column:
        return F.sum(sum((F.coalesce(n, zero) for n in names), zero))

    summed = rest.unionByName(known).groupBy("_row", "doc_id").agg(
        total("_line.words").alias("n_words"), total("_line.features", "_own.features").alias("n_features"),
        total("_line.weight", "_own.weight").alias("weight"),
    )
    return _drawn(summed, percent, least_words, seed)


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln u)), u from the first 32 bits of SHA-256 of ``seed:doc_id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def _drawn(summed: DataFrame, percent: int, least_words: int, seed: int) -> DataFrame:
    """Adds score and rank. The number of a row within its range is what monotonically_increasing_id gives after the range sort."""
    in_play = F.col("n_words") >= least_words
    scored = summed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    order = [F.desc(F.col("_in")), F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    placed = written(
        scored.withColumn("_in", in_play).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", 33)
    parts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"), F.count(F.when(F.col("_in"), 1)).alias("_some"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(  # one row for each range
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.floor(F.sum("_some").over(Window.partitionBy()) * percent / 100).alias("_drawn"),
    )
    rank = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        "doc_id", "n_words", "n_features", "weight", "score",
        F.when(F.col("_in") & (rank <= F.col("_drawn")), rank).cast("long").alias("rank"),
    )
