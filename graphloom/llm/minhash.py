"""Near-duplicate groups by bottom-k sketches of word-shingle sets.

One hash function gives every document the sorted set of its shingle hashes;
the ``SKETCH`` smallest are its bottom-k sketch.

1. Documents with equal sets form a class; from here on only classes count.
2. Inverted lists of retained values generate overlaps.  Two sets with
   similarity >= the threshold share at least :func:`needed` of their retained values, so each
   class looks only at its ``size - need + 1`` *rarest* retained values: passages that many
   documents share seldom are among them.  This is certain for sets not much larger than the sketch;
   of other pairs exactly at the threshold fewer than one in 10^8 is lost.
3. Long lists are first linked as stars: centres are the classes with the smallest
   part of rare shingles (held by at most ``RARE`` classes of long lists), as the original of many copies is, and some by hash, which tie the stars together.  Classes that confirmed
   stars have joined aren't compared again, so a large
   group of near copies costs a few links each and no quadratic number of pairs.
4. In long lists that are still open the full sets decide which entries are compared how (:func:`_bounded`).
   A class that lacks one of its ``n - need + 1`` rarest shingles in common with another can't be linked with it, so if these are
   rare, they alone list its partners.
   Only entries whose rarest shingles are common are compared with each other along the list.
5. The remaining pairs pass the union-sketch estimate and are confirmed on the full sets.
6. Confirmed links are closed into components.

Full sets are made again from the texts of candidates only.  Hashes are 64 bits
wide; a set of classes is exact up to their collisions.

Defined cases: null and wordless texts have an empty set and link with nothing;
a null doc_id takes part, but a component is named by its smallest non-null
doc_id; repeated rows (same doc_id) each get a row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from graphloom.llm.common import cut
from graphloom.llm.shingles import shingle_set, word_hashes

SKETCH = 64
#: Standard deviations of the shared retained values, below the mean at the threshold, that a link is still found at.
SLACK = 7.5
#: Lists longer than this are linked as stars first.
STAR = 24
#: Parts of a long list that have centres of their own.
PARTS = 2
#: Lists longer than this, after the stars, are thinned by what a class can share at all.
CROWD = 32
#: A shingle of at most so many classes of long lists is rare there.
RARE = 256
#: Entries of a list that one task pairs with the whole list.
SALT = 1000
#: So many candidate ids at most (24 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Rows of inverted lists that make up one task of the steps after them.
ROWS = 20_000


def needed(percent: int) -> int:
    """Retained values (of ``SKETCH``) that two sets at the threshold share at least."""
    t = percent / 100
    return max(1, math.floor(SKETCH * t - SLACK * (SKETCH * t * (1 - t)) ** 0.5))


def _buffers(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text (null: none), without copies."""
    for text in column:
        buffer = text.as_buffer() if text.is_valid else None
        yield np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)


def _digest(hashes: np.ndarray) -> np.ndarray:
    """128 bits that tell sets apart, as two signed integers."""
    return np.frombuffer(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def signatures(docs: DataFrame, words: int, full: bool = False) -> DataFrame:
    """doc_id, text_hash, n (set size), c1 and c2 (digest of the set, null if empty) and the sketch, or with ``full`` the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):  # a bound on what one step holds
                batch = whole.slice(at, 512)
                sets = [shingle_set(word_hashes(b), words) for b in _buffers(batch.column("text"))]
                ids = [_digest(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([i[0] for i in ids], pa.int64()),
                        pa.array([i[1] for i in ids], pa.int64()),
                        _lists([s if full else s[:SKETCH] for s in sets]),
                    ],
                    names=["doc_id", "text_hash", "n", "c1", "c2", "hashes"],
                )

    longs = [T.StructField(name, T.LongType()) for name in ("text_hash", "n", "c1", "c2")]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *longs, T.StructField("hashes", T.ArrayType(T.LongType()))])
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, schema)


def _size_ok(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _enough(common: Column, sizes: Column, percent: int) -> Column:
    """Whether sets of together ``sizes`` shingles that share ``common`` are linked."""
    return common * (100 + percent) >= percent * sizes


def _prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(value, k, n, df) of the rarest retained values that a link can't do without; only values of two classes or more."""
    posts = classes.select("k", "n", F.explode("hashes").alias("value"))
    # lists of one class link nothing; the rest is written, so that both sides of the join are plain exchanges that can be split
    counts = cut(posts.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    kept = F.least(F.col("n"), F.lit(SKETCH))
    need = F.when(F.col("n") * 100 <= percent * SKETCH, F.ceil(F.col("n") * percent / 100)).otherwise(F.lit(needed(percent)))
    shared = posts.join(counts, "value").groupBy("k", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    # values of one class come first in the order of rarity; what is left of the prefix goes to the rarest shared ones
    left = kept - need + 1 - (kept - F.size("v"))
    return shared.where(left > 0).select("k", "n", F.explode(F.slice("v", 1, left.cast("int"))).alias("x")).select(F.col("x.value").alias("value"), "k", "n", F.col("x.df").alias("df"))


def _full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(k, n, full) for the classes in ``wanted`` (k), from the text of one document of each."""
    reps = cut(classes.join(wanted, "k", "left_semi").select("rep", "c1", "c2", "k"))
    side = F.broadcast(reps) if reps.count() <= BROADCAST_IDS else reps
    texts = docs.select("doc_id", "text").join(side.select("rep"), docs["doc_id"].eqNullSafe(F.col("rep")), "left_semi")
    sets = cut(signatures(texts, words, full=True).join(side.drop("rep"), ["c1", "c2"]).select("k", "n", F.col("hashes").alias("full")))
    rows, distinct = sets.agg(F.count(F.lit(1)), F.count_distinct("k")).first()
    return sets if rows == distinct else cut(sets.dropDuplicates(["k"]))  # a row of ``docs`` that repeats


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The pairs (a, b) that are links: the union-sketch estimate rules most others out, the full sets decide."""
    side = lambda k, what: sets.select(F.col("k").alias(k), what.alias(f"{k}_s"))
    sketch, full = F.slice("full", 1, SKETCH), F.col("full")
    both = pairs.join(side("a", sketch), "a").join(side("b", sketch), "b")
    union = F.slice(F.array_sort(F.array_union("a_s", "b_s")), 1, SKETCH)
    common = F.size(F.array_intersect(union, F.array_intersect("a_s", "b_s")))
    # a union no larger than the sketches is known entirely
    likely = small(both.where(common * SKETCH >= needed(percent) * F.size(union)).select("a", "b"))
    both = likely.join(side("a", full), "a").join(side("b", full), "b")
    common = F.size(F.array_intersect("a_s", "b_s"))
    return small(both.where(_enough(common, F.size("a_s") + F.size("b_s"), percent)).select("a", "b"))


def _rare(sets: DataFrame, small: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The rare shingles (k, h, df) of ``sets``, and k, n, reach of each: how many of its n shingles aren't rare."""
    shingles = sets.select("k", F.explode("full").alias("h"))
    counts = cut(shingles.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") <= RARE))
    rare = small(shingles.join(counts, "h"))
    of_class = rare.groupBy("k").agg(F.count(F.lit(1)).alias("rare"))
    return rare, small(sets.select("k", "n").join(of_class, "k", "left").select("k", "n", (F.col("n") - F.coalesce("rare", F.lit(0))).alias("reach")))


def _bounded(lists: DataFrame, rare: DataFrame, reach: DataFrame, percent: int, small: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """What can still link of ``lists`` (value, k, n, root, len, least): (entries to compare along their lists with their reach, pairs found otherwise).

    An entry of a long list that would need more than its reach in common,
    even with the smallest class that it might link with, shares one of its ``prefix`` rarest shingles, which are all rare, with
    every partner from that list: such pairs are found by these shingles.
    """
    long = lists.where(F.col("len") > CROWD)
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    need = F.ceil((F.col("n") + partner) * percent / (100 + percent))
    entries = small(long.join(reach.select("k", "reach"), "k").withColumn("need", need))
    prefix = entries.where("reach < need").groupBy("k").agg(F.max(F.col("n") - F.col("need") + 1).alias("prefix"))
    ranked = rare.join(prefix, "k").withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("df", "h")))
    listed = ranked.where((F.col("rank") <= F.col("prefix")) & (F.col("df") > 1)).select("h", F.col("k").alias("a"), "prefix")
    holders = rare.where("df > 1").select("h", F.col("k").alias("b"))
    close = listed.join(holders, "h").where("a != b").groupBy("a", "b", "prefix").agg(F.count(F.lit(1)).alias("s"))
    known = long.select("k", "n", "root").distinct()
    side = lambda k: known.select(F.col("k").alias(k), F.col("n").alias(f"{k}_n"), F.col("root").alias(f"{k}_root"))
    close = close.join(side("a"), "a").join(side("b"), "b").where((F.col("a_root") != F.col("b_root")) & _size_ok(F.col("a_n"), F.col("b_n"), percent))
    close = close.where(_enough(F.col("a_n") - F.col("prefix") + F.col("s"), F.col("a_n") + F.col("b_n"), percent))
    close = small(close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    able = entries.where("reach >= need").drop("need")
    return lists.where(F.col("len") <= CROWD).withColumn("reach", F.col("n")).unionByName(able), close


def _pairs(able: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different roots that meet in a list and have the reach; a pair that meets in several lists comes from the first of them only."""
    of_class = able.groupBy("k").agg(F.sort_array(F.collect_list("value")).alias("values"))
    able = able.join(of_class, "k").withColumn("salts", F.ceil(F.col("len") / SALT).cast("int"))
    l = able.withColumn("salt", F.pmod(F.xxhash64("k"), F.col("salts")).cast("int")).alias("l")
    r = able.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("r")
    first = F.element_at(F.array_intersect("l.values", "r.values"), 1) == F.col("l.value")
    sizes = F.col("l.n") + F.col("r.n")
    return l.join(r, (F.col("l.value") == F.col("r.value")) & (F.col("l.salt") == F.col("r.salt"))).where(
        (F.col("l.k") < F.col("r.k")) & (F.col("l.root") != F.col("r.root")) & _size_ok(F.col("l.n"), F.col("r.n"), percent)
        & _enough(F.least("l.reach", "r.reach"), sizes, percent) & first
    ).select(F.col("l.k").alias("a"), F.col("r.k").alias("b"))


def components(edges: DataFrame, small: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(k, root) of every node of ``edges`` (a, b): the smallest node that it reaches.

    Alternates large-star and small-star steps (hash-min with path shortening),
    which takes a logarithmic number of rounds; each round is checkpointed by ``small``.
    """
    state = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    edges = small(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = state(edges)
    while True:
        # large star: neighbours above a node go to its smallest neighbour
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = small(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        # small star: neighbours below a node, and the node, go to the smallest of them
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(lowest, "a").select("b", "a", "low")
        ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("e")
        edges = small(moved.select(ends).select("e.a", "e.b").where("a != b").distinct())
        after = state(edges)
        if after == before:
            return edges.select(F.col("a").alias("k"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("k"), F.col("b").alias("root")).distinct())
        before = after


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    return _grouped(docs, words, percent).drop("text_hash")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The columns of :func:`near_duplicates` with text_hash (xxhash64 of the text), which tells rows with the same doc_id apart."""
    signed = cut(signatures(docs, words))
    # numbered where it is written, so all that read it see the same numbers
    classes = cut(
        signed.where("c1 IS NOT NULL").groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("hashes").alias("hashes"))
        .withColumn("k", F.monotonically_increasing_id())
    )
    posts = cut(_prefixes(classes, percent))
    tasks = max(1, math.ceil(posts.count() / ROWS))

    def small(df: DataFrame) -> DataFrame:
        """Written in tasks by the size of the lists: no thousand empty files where few candidates are left."""
        return cut(df.coalesce(tasks))

    # stars: each part of a long list has two centres, the class with the least of its own and one by a hash that is the same in all lists
    long = posts.where(F.col("df") > STAR)
    sets = _full_sets(docs, classes, long.select("k").distinct(), words)
    rare, reach = _rare(sets, small)
    part, self_ = F.pmod(F.xxhash64("k"), F.lit(PARTS)), F.struct("k", "n")
    ranked = long.join(reach.select("k", (F.col("reach") / F.col("n")).alias("shared")), "k")
    centres = ranked.groupBy("value", part.alias("part")).agg(F.max_by(self_, F.struct("shared", "k")).alias("c"), F.max_by(self_, F.xxhash64("k", F.lit(1))).alias("d"))
    centres = small(centres.select("value", F.explode(F.array("c", "d")).alias("c")))
    stars = long.join(centres, "value").where((F.col("k") != F.col("c.k")) & _size_ok(F.col("n"), F.col("c.n"), percent))
    stars = small(stars.select(F.least("k", "c.k").alias("a"), F.greatest("k", "c.k").alias("b")).distinct())
    links = _linked(stars, sets, percent, small)
    joined = components(links, small)

    # the rest: all pairs of a list that no star has joined
    marked = small(posts.join(joined, "k", "left").select("value", "k", "n", F.coalesce("root", "k").alias("root")))
    mixed = marked.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("len"), F.min("n").alias("least"))
    lists = small(marked.join(small(mixed.where("low != high").select("value", "len", "least")), "value"))
    able, close = _bounded(lists, rare, reach, percent, small)
    pairs = small(_pairs(small(able), percent).union(close).distinct())
    ends = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct()
    sets = sets.union(_full_sets(docs, classes, ends.join(sets, "k", "left_anti"), words))
    found = components(links.union(_linked(pairs, sets, percent, small)), small)

    named = found.join(classes.select("k", "rep"), "k")
    of_class = small(named.join(named.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select("k", "component_id"))
    rep = cut(classes.select("k", "c1", "c2", "rep").join(of_class, "k", "left").select("c1", "c2", F.coalesce("component_id", "rep").alias("component_id")))
    out = signed.select("doc_id", "text_hash", "n", "c1", "c2").join(rep, ["c1", "c2"], "left")
    component = F.when(F.col("c1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents whose near-duplicate group keeps another one (columns unchanged).

    Rows that repeat a kept doc_id in its group stay; wordless texts all stay.
    """
    gone = cut(_grouped(docs, words, percent).where("NOT kept").select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash")).distinct())
    same = docs["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.xxhash64(docs["text"]) == F.col("__text_hash"))
    return docs.join(gone, same, "left_anti").select(*docs.columns)
