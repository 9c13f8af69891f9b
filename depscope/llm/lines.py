"""Line dedup by site-relative frequency.

A line is boilerplate of a host if more than a given share of the host's pages contain it. The
host is ``source``. Lines are compared without the blanks around them, by a 64-bit hash within
the host; blank lines are neither counted nor dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .common import bounded_broadcast, free_name, present, quoted

#: A line is dropped on more than this share (in thousandths) of its host's pages …
RATIO_PERMILLE = 100
#: … if so many pages have it: a line of one page repeats nothing.
MIN_PAGES = 2
#: Host lists are broadcast up to so many hosts. A list holds at most (mean lines of a page /
#: ratio) hashes, as each listed line takes up that share of the pages.
BROADCAST_HOSTS = 20_000

_BLANKS = " \t\x0b\f\r"


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, ratio_permille: int = RATIO_PERMILLE, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, pages, lines (array of hashes): what to drop, for hosts that have such lines.

    Counts combine on the map side, one per host and line, so that neither a host nor a line
    with a third of all rows meets in one task.
    """
    pages = docs.select(present(docs, "source", "string").alias("host"), present(docs, "text", "string").alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    hashes = F.transform(F.filter(_lines(F.col("text")), lambda x: F.length(F.btrim(x, F.lit(_BLANKS))) > 0), line_hash)
    counted = (pages.select("host", F.explode(F.array_distinct(hashes)).alias("line"))
               .groupBy("host", "line").agg(F.count("*").alias("with_line")).where(F.col("with_line") >= min_pages))
    joined = counted.withColumnRenamed("host", "line_host").join(totals, F.col("line_host").eqNullSafe(F.col("host")))
    common = joined.where(F.col("with_line") * 1000 > F.col("pages") * ratio_permille)
    return common.groupBy("host", "pages").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def drop_boilerplate(docs: DataFrame, ratio_permille: int = RATIO_PERMILLE, min_pages: int = MIN_PAGES) -> DataFrame:
    """All rows and columns of ``docs``; boilerplate lines are gone from ``text``.

    Two columns are appended: ``n_lines`` and ``n_dropped`` (with underscores if the names are
    taken). A null text stays null with no lines; a text that loses all its lines becomes
    empty. Rows without a host form one host. Repeated rows count as pages of their own. No row
    is dropped, and an empty table gives an empty result. Very long texts are split where they are; no
    list is longer than the lines of one text. Runs jobs for the host lists.
    """
    n_lines, n_dropped, host, found = free_name(docs, "n_lines", "n_dropped", "list_host", "list_lines")
    lists = store(boilerplate(docs, ratio_permille, min_pages), "boilerplate")
    lists = bounded_broadcast(lists.select(F.col("host").alias(host), F.col("lines").alias(found)), BROADCAST_HOSTS)
    joined = docs.join(lists, present(docs, "source", "string").eqNullSafe(F.col(host)), "left")
    text = quoted("text")
    kept = F.filter(_lines(text), lambda x: (F.length(F.btrim(x, F.lit(_BLANKS))) == 0) | ~F.array_contains(F.col(found), line_hash(x)))
    # kept lines are put together once, and counted from there
    marked = joined.withColumn(found, F.when(F.col(found).isNotNull(), kept))
    n_all = F.coalesce(F.size(F.when(text.isNotNull(), _lines(text))), F.lit(0))
    n_all = F.when(text.isNull(), 0).otherwise(n_all)
    return marked.select(
        *(F.when(F.col(found).isNotNull(), F.array_join(found, "\n")).otherwise(text).alias("text") if c == "text" else quoted(c)
          for c in docs.columns),
        n_all.alias(n_lines),
        F.when(F.col(found).isNotNull(), n_all - F.size(found)).otherwise(0).alias(n_dropped))
