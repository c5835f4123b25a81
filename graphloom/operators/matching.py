"""Greedy longest match of dictionary entries in texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.relations import BROADCAST_ROWS, written

#: An entry has at most so many words; longer headwords are ignored.
MAX_WORDS = 5


def entries_of(headwords: DataFrame) -> DataFrame:
    """(words, n) of the distinct headwords (headword, words joined by underscores) of 1 to ``MAX_WORDS`` words; ``words`` are joined by blanks."""
    words = F.filter(F.split("headword", "_"), lambda w: w != "")
    return headwords.select(F.array_join(words, " ").alias("words"), F.size(words).alias("n")).where(F.col("n").between(1, MAX_WORDS)).distinct()


def _taken(places: pd.Series, lengths: pd.Series) -> pd.Series:
    """Which of a text's matches are taken from left to right; they are sorted by place, the longest first."""

    def one(at, n):
        end, out = 0, []
        for i, k in zip(at, n, strict=True):
            out.append(bool(i >= end))
            end = i + k if i >= end else end
        return out

    return pd.Series([one(a, n) for a, n in zip(places, lengths, strict=True)])


def spans(texts: DataFrame, headwords: DataFrame) -> DataFrame:
    """(text_no, left, n, words) of the matches in ``texts`` (text): left to right, the longest entry at each word, going on behind it.

    Word runs of the lengths that entries have are joined with the entries by equality, so the dictionary can
    have any size; it is broadcast while it is small.  Only places that match are gathered by text.
    """
    entries = written(entries_of(headwords))
    lengths = sorted(r.n for r in entries.select("n").distinct().collect())
    known = F.broadcast(entries) if entries.count() <= BROADCAST_ROWS else entries
    # numbered by place in its file: the same when a task runs again
    words = F.filter(F.split(F.lower("text"), r"(?U)\s+"), lambda w: w != "")
    numbered = texts.where("text IS NOT NULL").select(F.monotonically_increasing_id().alias("text_no"), words.alias("w"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("w")),
        lambda i: F.filter(
            F.array(*[F.struct(i.alias("left"), F.lit(n).alias("n"), F.array_join(F.slice("w", i + 1, n), " ").alias("words")) for n in lengths]), lambda r: r["left"] + r["n"] <= F.size("w")
        ),
    )
    runs = numbered.select("text_no", F.explode(F.flatten(runs)).alias("r")).select("text_no", "r.*") if lengths else numbered.select("text_no", F.lit(0).alias("left"), F.lit(0).alias("n"), F.lit("").alias("words")).limit(0)
    hits = runs.join(known, ["words", "n"], "left_semi")
    by_text = hits.groupBy("text_no").agg(F.sort_array(F.collect_list(F.struct("left", (-F.col("n")).alias("less"), "words"))).alias("m"))
    taken = F.pandas_udf(_taken, "array<boolean>")(F.transform("m", lambda m: m["left"]), F.transform("m", lambda m: -m["less"]))
    kept = by_text.select("text_no", F.explode(F.arrays_zip(F.col("m").alias("m"), taken.alias("t"))).alias("x")).where("x.t")
    return kept.select("text_no", F.col("x.m.left").alias("left"), (-F.col("x.m.less")).alias("n"), F.col("x.m.words").alias("words"))


def mentions(texts: DataFrame, headwords: DataFrame) -> DataFrame:
    """(headword, n): how often each matched headword (headword) is found in ``texts`` (text)."""
    return spans(texts, headwords).groupBy(F.replace("words", F.lit(" "), F.lit("_")).alias("headword")).agg(F.count(F.lit(1)).alias("n"))


def mention_counts(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """entries (headword, ...) with n_total, 0 for a headword that isn't found."""
    counts = mentions(texts, entries.select("headword")).withColumnRenamed("n", "n_total")
    return entries.join(counts, "headword", "left").withColumn("n_total", F.coalesce("n_total", F.lit(0).cast("bigint")))
