"""Quality rules with thresholds that follow each language and source.

Each feature is kept as a quantile sketch per language and source: counts by bucket, where
values below 1,024 have a bucket each and larger ones a relative width below 1/512. Such
sketches merge by adding counts, in any order and with the same result, so they combine on the
map side, and the sketch of a language is the sum of those of its sources. A document is
rejected if a feature lies beyond its group's fence: upper quartile + SPREAD x (upper - lower
quartile) + the feature's tolerance. Groups with few documents use their language's fence, and
languages with few documents the fence of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window

from ..session import store
from .common import BLANK, NOT_BLANK, bounded_broadcast, present, words_of

#: Words of a window whose repetition counts.
WINDOW = 5
#: Base rules: fewer words fail, and so does a larger share of repeated words (in hundredths).
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Quartile distances between the upper quartile and the fence.
SPREAD = 3
#: Feature → what a document may lie above the fence, so that groups without any spread (no
#: symbols at all) do not reject the first symbol. Thousandths; tenths of a code point for words.
TOLERANCE = {"symbols": 50, "dup_lines": 300, "word_length": 20}
#: Documents that a group needs for a fence of its own.
MIN_GROUP = 100
#: Fences are broadcast up to so many groups.
BROADCAST_GROUPS = 100_000

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_mille(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("bigint")


def measure(docs: DataFrame, carry: list[Column]) -> DataFrame:
    """``carry``, lang, source, the base counts, base_failed and the features (m_…).

    The words of a text are split once; windows are compared as 64-bit hashes inside the row,
    sorted only in texts that repeat any.
    """
    text = F.coalesce(present(docs, "text", "string"), F.lit(""))
    base = docs.select(
        F.struct(*carry).alias("carry"), present(docs, "lang", "string").alias("lang"), present(docs, "source", "string").alias("source"),
        words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK)).alias("lines"),
        F.length(F.regexp_replace(text, BLANK + "+", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"))
    counted = base.withColumns({
        "n_words": F.size("words").cast("bigint"),
        "n_lines": F.size("lines").cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "hashes": F.when(F.size("words") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>")),
    }).drop("words", "lines")
    by_hash = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = counted.withColumn("ordered", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), by_hash).otherwise(none)).drop("hashes")
    again = F.filter("ordered", lambda x, i: F.coalesce(
        (x.h == F.get(F.col("ordered"), i - 1).h) | (x.h == F.get(F.col("ordered"), i + 1).h),
        x.h == F.get(F.col("ordered"), i + 1).h, x.h == F.get(F.col("ordered"), i - 1).h, F.lit(False)))
    found = ordered.withColumn("places", F.sort_array(F.transform(again, lambda x: x.i))).drop("ordered")
    covered = F.transform("places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("places"), j + 1) - p, F.lit(WINDOW))))
    found = found.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("bigint")).drop("places")
    return found.select(
        "carry", "lang", "source", *BASE,
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)).alias("base_failed"),
        _per_mille(F.col("n_symbols"), F.col("word_chars")).alias("m_symbols"),
        _per_mille(F.col("n_dup_lines"), F.col("n_lines")).alias("m_dup_lines"),
        F.floor(_per_mille(F.col("word_chars"), F.col("n_words")) / 100).cast("bigint").alias("m_word_length"))


def bucket(value: Column) -> Column:
    """Lower end of the sketch bucket: the ten leading binary digits of a value."""
    cut = F.greatest(F.length(F.bin(value)) - 10, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(measured: DataFrame) -> DataFrame:
    """level, lang, source, feature, bucket, n: of each group (2), language (1) and all (0)."""
    good = measured.where(~F.col("base_failed"))
    features = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), bucket(F.col(f"m_{f}")).alias("bucket")) for f in TOLERANCE)))
    groups = (good.select("lang", "source", features.alias("f")).groupBy("lang", "source", "f.feature", "f.bucket")
              .agg(F.count("*").alias("n")))
    levels = F.explode(F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"))))
    merged = groups.select(levels.alias("l"), "feature", "bucket", "n")
    return merged.groupBy("l.level", "l.lang", "l.source", "feature", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source and the fence of each feature, for each group that has a sketch."""
    group = ["level", "lang", "source"]
    w = Window.partitionBy(*group, "feature")  # a sketch: at most a few thousand rows
    summed = sketch.withColumns({"upto": F.sum("n").over(w.orderBy("bucket")), "all": F.sum("n").over(w)})
    lower, upper = (F.min(F.when(F.col("upto") * 4 >= F.col("all") * q, F.col("bucket"))) for q in (1, 3))
    quartiles = summed.groupBy(*group, "feature", "all").agg(lower.alias("q1"), upper.alias("q3"))
    slack = F.create_map(*(F.lit(x) for pair in TOLERANCE.items() for x in pair))
    fence = F.col("q3") + SPREAD * (F.col("q3") - F.col("q1")) + slack[F.col("feature")]
    wide = quartiles.groupBy(*group, F.col("all").alias("n")).agg(
        *(F.max(F.when(F.col("feature") == f, fence)).alias(f"fence_{f}") for f in TOLERANCE))
    steps = wide.where("level = 2").select("lang", "source", F.explode(F.array(
        F.struct(F.lit(2).alias("at"), F.col("lang").alias("l"), F.col("source").alias("s")),
        F.struct(F.lit(1).alias("at"), F.col("lang").alias("l"), F.lit(None).cast("string").alias("s")),
        F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("l"), F.lit(None).cast("string").alias("s")))).alias("k"))
    values = F.struct(*(f"fence_{f}" for f in TOLERANCE))
    known = wide.select("level", F.col("lang").alias("l"), F.col("source").alias("s"), "n", values.alias("fence"))
    match = (F.col("k.at") == F.col("level")) & F.col("k.l").eqNullSafe(known.l) & F.col("k.s").eqNullSafe(known.s)
    usable = steps.join(known, match).where((F.col("n") >= min_group) | (F.col("level") == 0))
    best = usable.groupBy("lang", "source").agg(F.max_by("fence", "level").alias("fence"))
    return best.select("lang", "source", "fence.*")


def assess(docs: DataFrame, carry: list[Column], min_group: int = MIN_GROUP) -> DataFrame:
    """``carry``, the base counts, base_failed and ``kept``; one row for each row of ``docs``.

    Null texts count as empty and fail; null languages and sources form groups like any other.
    Repeated rows are judged alike. Columns that ``docs`` lacks count as null. Stores the
    measured rows, since both the sketches and the filter read them.
    """
    measured = store(measure(docs, carry), "measured")
    limits = store(fences(sketches(measured), min_group), "fences")
    limits = bounded_broadcast(limits.withColumnsRenamed({"lang": "fence_lang", "source": "fence_source"}), BROADCAST_GROUPS)
    same = F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source"))
    within = ~F.col("base_failed")
    for f in TOLERANCE:
        within = within & (F.col(f"m_{f}") <= F.col(f"fence_{f}"))
    judged = measured.join(limits, same, "left").withColumn("kept", F.coalesce(within, F.lit(False)))
    return judged.select("carry.*", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    row = F.struct(*(docs[f"`{c.replace('`', '``')}`"] for c in docs.columns)).alias("row")
    return assess(docs, [row], min_group).where("kept").select("row.*")
