"""Benchmark decontamination by spaced seeds.

A mask tells which words of a window count; the others may differ. Each mask hashes the counted
words of every window of the test items and of the documents, and equal hashes are joined. A hit
fixes an alignment of item and document, which is then compared word by word: it is
contaminated if some run of ``RUN_WORDS`` aligned words (the whole item, if shorter) agrees in
``SIMILARITY_PERCENT`` or more of its words. The masks have a window that avoids any two
substitutions in a run, and those for short items one that avoids as many as these may have; items of
one to four words have a mask of all their words. So nothing within the threshold is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .common import bounded_broadcast, free_name, present, quoted

#: 1: the word counts; 0: it may be any. Both have a window in every 13 words with 2 substitutions.
MASKS = ("11010011", "11001011")
#: For items shorter than a run: together they miss no item of MIN_WORDS to 12 words.
SHORT_MASKS = ("1011", "1101")
RUN_WORDS = 13
#: Items with fewer words may differ in none: they match as whole phrases, by a mask of their length.
MIN_WORDS = 5
SIMILARITY_PERCENT = 80
#: Seeds of the test items are broadcast up to so many rows (about 40 bytes each), as are the
#: items themselves and the keys of documents with a hit; larger ones are joined by shuffles.
BROADCAST_SEEDS = 1_000_000
BROADCAST_ITEMS = 20_000
BROADCAST_KEYS = 500_000


def word_hashes(text: Column) -> Column:
    """Lower-cased runs of letters and digits, hashed; none for a null text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, keys: list[str], masks: tuple[str, ...] = MASKS) -> DataFrame:
    """``keys``, seed, at: the hash of each mask at each word of ``hashes`` where it fits."""
    used = sorted({i for m in masks for i, c in enumerate(m) if c == "1"})
    shifted = [F.slice("hashes", i + 1, F.size("hashes")) for i in used]
    windows = rows.select(*keys, F.posexplode(F.arrays_zip(*shifted)).alias("at", "w"))
    columns = {i: F.col("w").getField(str(k)) for k, i in enumerate(used)}
    parts = []
    for m in masks:
        on = [columns[i] for i, c in enumerate(m) if c == "1"]
        parts.append(F.when(on[-1].isNotNull(), F.xxhash64(F.lit(m), *on)))
    found = windows.select(*keys, "at", F.explode(F.array(*parts)).alias("seed"))
    return found.where(F.col("seed").isNotNull())


def _best_run(equal: Column, run_words: int) -> Column:
    """Most ones in any ``run_words`` neighbours of an array of zeros and ones."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(equal) - run_words + 1, F.lit(1)))
    return F.array_max(F.transform(starts, lambda s: F.aggregate(F.slice(equal, s, run_words), F.lit(0), lambda a, x: a + x)))


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, run_words: int = RUN_WORDS,
                 similarity_percent: int = SIMILARITY_PERCENT, short_masks: tuple[str, ...] = SHORT_MASKS) -> DataFrame:
    """doc_id, text_key, item_id, n_words (of the item), matched_words: one row for each pair.

    ``text_key`` is a hash of the text, so that a null or repeated doc_id still tells documents
    apart; ``matched_words`` is the best alignment's count. Null and empty texts match nothing. Items with
    fewer than ``MIN_WORDS`` words match where all of them stand together. Repeated rows give one result, empty
    tables none. Columns other than doc_id, item_id and text are not looked at, whatever their names. Very long
    texts are hashed word by word where they are. Items of equal words are searched once. Documents get seeds of the short masks only where some item is short. Hits are counted once per document, item and alignment before
    anything else is done with them; texts are read again only for documents with a hit.
    """
    items = benchmark.select(present(benchmark, "item_id", "bigint").alias("item_id"),
                             word_hashes(present(benchmark, "text", "string")).alias("hashes"))
    items = store(items.where(F.size("hashes") > 0).withColumn("item", F.xxhash64("hashes")), "items")
    texts = items.groupBy("item").agg(F.first("hashes").alias("item_hashes"))
    by_item = texts.withColumnRenamed("item_hashes", "hashes")
    n = F.size("hashes")
    wanted = seeds(by_item.where(n >= run_words), ["item"], masks)
    if items.where((n >= MIN_WORDS) & (n < run_words)).limit(1).count():
        wanted = wanted.unionByName(seeds(by_item.where((n >= MIN_WORDS) & (n < run_words)), ["item"], short_masks))
        masks = masks + short_masks
    phrases = [r.n for r in items.where(n < MIN_WORDS).select(n.alias("n")).distinct().collect()]  # lengths below MIN_WORDS
    wanted = wanted.withColumn("phrase", F.lit(False))
    for length in phrases:
        wanted = wanted.unionByName(seeds(by_item.where(n == length), ["item"], ("1" * length,)).withColumn("phrase", F.lit(True)))
        masks = (*masks, "1" * length)
    item_seeds = store(wanted.distinct(), "item_seeds")

    text = present(docs, "text", "string")
    own = docs.select(present(docs, "doc_id", "bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), word_hashes(text).alias("hashes"))
    known = bounded_broadcast(item_seeds.withColumnRenamed("at", "item_at"), BROADCAST_SEEDS)
    hits = seeds(own, ["doc_id", "text_key"], masks).join(known, "seed")
    hits = hits.select("doc_id", "text_key", "item", "phrase", (F.col("at") - F.col("item_at")).alias("shift"))
    if phrases:  # a phrase is whole wherever it is hit, and need not be compared at each place
        first = hits.where("phrase").groupBy("doc_id", "text_key", "item", "phrase").agg(F.min("shift").alias("shift"))
        hits = hits.where("not phrase").unionByName(first)
    hits = store(hits.drop("phrase").distinct(), "hits")

    keys = bounded_broadcast(
        hits.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct(), BROADCAST_KEYS)
    found = own.join(keys, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left_semi")
    aligned = (hits.withColumnsRenamed({"doc_id": "hit_id", "text_key": "hit_key"})
               .join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")))
               .join(bounded_broadcast(store(texts, "item_texts"), BROADCAST_ITEMS), "item"))
    # both sides from where they begin to overlap
    theirs = F.slice("hashes", F.greatest(F.col("shift"), F.lit(0)) + 1, F.size("item_hashes"))
    ours = F.slice("item_hashes", F.greatest(-F.col("shift"), F.lit(0)) + 1, F.size("item_hashes"))
    pairs = aligned.select("doc_id", "text_key", "item", F.size("item_hashes").alias("n_words"), theirs.alias("a"), ours.alias("b"))
    compared = pairs.select("doc_id", "text_key", "item", "n_words", F.zip_with(
        "a", "b", lambda x, y: F.when(x == y, 1).otherwise(0)).alias("equal"))
    run = F.least(F.col("n_words"), F.lit(run_words))
    near = compared.where(_best_run(F.col("equal"), run_words) * 100 >= run * similarity_percent)
    matched = near.withColumn("matched_words", F.aggregate("equal", F.lit(0), lambda a, x: a + x))
    best = matched.groupBy("doc_id", "text_key", "item", "n_words").agg(F.max("matched_words").alias("matched_words"))
    return best.join(items.select("item", "item_id").distinct(), "item").select("doc_id", "text_key", "item_id", "n_words", "matched_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with the columns of ``docs``."""
    bad_id, bad_key = free_name(docs, "bad_id", "bad_key")
    found = store(contaminated(docs, benchmark).select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct(), "contaminated")
    same = (present(docs, "doc_id", "bigint").eqNullSafe(quoted(bad_id))
            & (F.xxhash64(present(docs, "text", "string")) == quoted(bad_key)))
    return docs.join(bounded_broadcast(found, BROADCAST_KEYS), same, "left_anti")
