"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Text is lower-cased and cut into words (runs of letters and digits); shingles
are five words.  A document leaks an item if one of its windows, as many words
long as the item, has a weighted-shingle similarity (sum of the smaller
multiplicities over sum of the larger) of ``percent`` or more with it.  A text
shorter than the item is its own one window.

1. Only places near a shingle that some item has can hold such a window: a
   join with the shingles of all items finds them.  A similar window
   lacks so few of the item's shingles that trying every few places is enough
   (:func:`_stride`).
   Neighbouring places are merged into stretches of the document.
2. Every item-sized window of a stretch that holds a shingle of an item of that
   length gets a 63-bit SimHash, weighted by multiplicity.  The votes
   of all bits are counted in lanes of a few longs.
3. Fingerprints are cut into ``RADIUS + 1`` blocks.  Two that differ in at most
   ``RADIUS`` bits agree in a whole block, so an equality join on (length,
   block, value) finds every such pair; the first block that agrees counts.
4. Pairs within the radius are verified on their shingles.

At similarity 0.8 a pair differs in 9.5 of 63 bits on average (standard deviation
2.9), so the radius of 20 loses one such pair in 10,000; more similar
pairs are safer, equal ones certain.

An item of fewer than five words has one shingle, all its words in order; a run of
as many words leaks it if it is equal (:func:`_short_leaks`).

Item tables are broadcast while they are small; only keys and places of hits are
shuffled, and documents only if more than ``BROADCAST_ROWS`` places hit.

Defined cases: null and wordless texts leak nothing and wordless items can't be
leaked; an empty table of either kind leaks nothing; repeated rows are
judged alike; extra columns of documents pass through :func:`clean`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import cut

SHINGLE = 5
#: Of a fingerprint: the sign is left out, so that no sum of lanes overflows.
BITS = 63
RADIUS = 20
PERCENT = 80
#: So many rows of the item tables at most are broadcast (a few hundred bytes each); beyond, Spark joins by a shuffle.
BROADCAST_ROWS = 200_000

_GAP = r"[^\p{L}\p{N}]+"


def with_words(frame: DataFrame, text: str = "text") -> DataFrame:
    """``frame`` with ``words``, the lower-cased words of ``text`` in order (none for null)."""
    # columns that are used more than once are kept apart, or they would be made again for every use
    split = frame.withColumn("__parts", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _GAP))
    # only the first and the last part can be empty
    head = (F.element_at("__parts", 1) == "").cast("int")
    tail = (F.element_at("__parts", -1) == "").cast("int")
    return split.withColumn("words", F.slice("__parts", 1 + head, F.greatest(F.size("__parts") - head - tail, F.lit(0)))).drop("__parts")


def _shingle(words: Column, at: Column) -> Column:
    """Hash of the five words from place ``at`` on."""
    return F.xxhash64(F.slice(words, at, SHINGLE))


def shingles_of(words: Column) -> Column:
    """Hashes of all runs of five words, in order; none with fewer words."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1))), lambda i: _shingle(words, i))
    return F.when(n >= SHINGLE, runs).otherwise(F.array().cast("array<bigint>"))


def _stride(lengths: list[int], percent: int) -> int:
    """The largest step such that, of every ``step``-th place, each similar enough window has one whose shingle the item has.

    Sets of m and n shingles as similar as that share ``least`` of them, so a window of n
    has at most ``n - least`` places that the item lacks.  A window of fewer than m is a
    whole text, whose first place is tried.
    """

    def fits(step: int, m: int) -> bool:
        for n in range(-(-percent * m // 100), m + 1):
            least = -(-percent * (m + n) // (100 + percent))
            if (n // step if n == m else -(-n // step)) <= n - least:
                return False
        return True

    return max(step for step in range(1, 65) if step == 1 or all(fits(step, m) for m in lengths))


def _lane_bits(longest: int) -> int:
    """Width of a vote counter that can't overflow with ``longest`` shingles; 63 is a multiple of it."""
    return 9 if longest <= 255 else 21


def simhash(shingles: Column, lane: int) -> Column:
    """63-bit SimHash of an array of shingle hashes (a repeated one votes as often).

    Bit ``lane * i + j`` of all hashes is counted in lane ``i`` of sum ``j``; adding
    half of the lane's range less half of the votes brings the majority to the lane's highest bit.
    """
    ones = sum(1 << (lane * i) for i in range(BITS // lane))
    half = F.lit((1 << (lane - 1)) - 1) - F.shiftright(F.size(shingles), 1).cast("long")
    bits = F.lit(0).cast("long")
    for j in range(lane):
        votes = F.aggregate(shingles, F.lit(0).cast("long"), lambda acc, h: acc + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ones)))  # noqa: B023
        majority = F.shiftrightunsigned(votes + half * F.lit(ones), lane - 1).bitwiseAND(F.lit(ones))
        bits = bits.bitwiseOR(F.shiftleft(majority, j))
    return bits


def numbered(shingles: Column) -> Column:
    """The array with the second, third, ... occurrence of a hash told apart from the first."""
    nth = lambda h, i: F.size(F.filter(F.slice(shingles, 1, i + 1), lambda y: y == h))
    repeats = F.transform(shingles, lambda h, i: F.when(nth(h, i) == 1, h).otherwise(F.xxhash64(h, nth(h, i))))
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), shingles).otherwise(repeats)


def _blocks() -> list[tuple[int, int]]:
    """(first bit, number of bits) of the blocks of a fingerprint."""
    cuts = [BITS * b // (RADIUS + 1) for b in range(RADIUS + 2)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _block_values(fp: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << n) - 1)).cast("int") for lo, n in _blocks()])


def _first_agreement(diff: Column) -> Column:
    """The first block in which two fingerprints agree, from their exclusive or."""
    found = None
    for b, (lo, n) in enumerate(_blocks()):
        same = F.shiftrightunsigned(diff, lo).bitwiseAND(F.lit((1 << n) - 1)) == 0
        found = F.when(same, F.lit(b)) if found is None else found.when(same, F.lit(b))
    return found


def items_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, m (number of shingles), shingles and words of the items that have any words."""
    words = with_words(benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))).select("item_id", "words")
    found = words.where(F.size("words") > 0).withColumn("item_shingles", shingles_of(F.col("words")))
    return cut(found.withColumn("m", F.size("item_shingles")))


def _known(table: DataFrame, rows: int) -> DataFrame:
    """A side of a join: broadcast behind the check of its size."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _short_leaks(keys: DataFrame, items: DataFrame) -> DataFrame:
    """Runs of words that equal an item of fewer than ``SHINGLE`` words; the first of each text counts."""
    short = cut(items.where("m = 0").select("item_id", F.size("words").alias("n"), F.xxhash64("words").alias("h")))
    lengths = sorted(r.n for r in short.select("n").distinct().collect())  # four at most
    found = None
    for n in lengths:
        words = with_words(keys).where(F.size("words") >= n).select("doc_id", "text_hash", "words")
        runs = F.transform(F.sequence(F.lit(0), F.size("words") - n), lambda i: F.xxhash64(F.slice("words", i + 1, n)))  # noqa: B023
        same = short.where(F.col("n") == n)
        hits = words.select("doc_id", "text_hash", F.posexplode(runs).alias("first_word", "h")).join(_known(same, same.count()), "h")
        hits = hits.groupBy("doc_id", "text_hash", "item_id").agg(F.min("first_word").alias("first_word"))
        hits = hits.select("doc_id", "text_hash", "item_id", F.lit(1.0).alias("similarity"), "first_word", F.lit(n).alias("n_words"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        item_type = items.schema["item_id"].dataType
        found = keys.select("doc_id", "text_hash", F.lit(None).cast(item_type).alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("first_word"), F.lit(0).alias("n_words")).limit(0)
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, item_id, similarity, first_word, n_words: the best window of every leaked item in every text.

    ``text_hash`` (xxhash64 of the text) tells rows with the same doc_id apart; of
    equally similar windows the first counts.
    """
    items = items_of(benchmark)
    keys = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text"))
    short = _short_leaks(keys, items)
    items = items.where("m > 0").drop("words")
    pairs = cut(items.select("m", F.explode("item_shingles").alias("h")).distinct())
    n, longest = pairs.agg(F.count(F.lit(1)), F.max("m")).first()
    if not n:
        return short
    lane = _lane_bits(longest)
    lengths = sorted(r.m for r in items.select("m").distinct().collect())

    # places of item shingles; places count from 1
    step = _stride(lengths, percent)
    last_place = F.greatest(F.size("words") - SHINGLE + 1, F.lit(1))
    tried = F.transform(F.sequence(F.lit(1), last_place, F.lit(step)), lambda i: _shingle(F.col("words"), i))
    # a text of fewer words has one run, which equals no shingle; a filter here would be pushed down and make the words twice
    tried = with_words(keys).select("doc_id", "text_hash", F.posexplode(tried).alias("nth", "h"))
    hits = tried.join(_known(pairs.select("h").distinct(), n), "h", "left_semi").select("doc_id", "text_hash", (F.col("nth") * step + 1).alias("p"))
    hits = cut(hits.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("p")).alias("hits")))
    places = hits.agg(F.sum(F.size("hits"))).first()[0] or 0
    hit = hits.select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash"), "hits")
    worded = with_words(keys.join(_known(hit, places), F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("text_hash") == F.col("__text_hash"))))
    worded = worded.select("doc_id", "text_hash", "words", "hits")

    # stretches: ``longest`` shingles before and after hits no more than that apart
    kind = "array<struct<a:int,b:int>>"

    def merge(acc: Column, p: Column) -> Column:
        last = F.element_at(acc, -1)
        apart = (F.size(acc) == 0) | (F.coalesce(last["b"], F.lit(0)) + longest < p)
        one = lambda a: F.array(F.struct(a.alias("a"), p.alias("b"))).cast(kind)
        return F.when(apart, F.concat(acc, one(p))).otherwise(F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), one(last["a"])))

    merged = F.aggregate("hits", F.array().cast(kind), merge)
    stretches = F.transform(
        merged,
        lambda x: F.struct(
            F.greatest(x["a"] - longest + 1, F.lit(1)).alias("first"),
            F.slice("words", F.greatest(x["a"] - longest + 1, F.lit(1)), x["b"] - F.greatest(x["a"] - longest + 1, F.lit(1)) + longest + SHINGLE - 1).alias("words"),
        ),
    )
    # the outer form, as the other one would be pushed down as a filter and evaluate the words twice
    parts = worded.select("doc_id", "text_hash", F.explode_outer(stretches).alias("x")).where("x IS NOT NULL")
    parts = parts.select("doc_id", "text_hash", "x.first", F.col("x.words").alias("words"))
    parts = cut(parts.select("doc_id", "text_hash", "first", shingles_of(F.col("words")).alias("h")).dropDuplicates(["doc_id", "text_hash", "first"]))

    # windows of m shingles that hold a shingle of an item of that length; a stretch of fewer than m is a whole text
    part = ("doc_id", "text_hash", "first")
    spread = parts.select(*part, F.size("h").alias("size"), F.posexplode("h").alias("i", "h")).join(_known(pairs, n), "h").where(100 * F.col("size") >= percent * F.col("m"))
    spots = spread.groupBy(*part, "m").agg(F.collect_set(F.col("i") + 1).alias("spots"))
    spots = spots.select(*(F.col(c).alias(f"__{c}") for c in part), "m", "spots")
    lives = parts.join(spots, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("text_hash") == F.col("__text_hash")) & (F.col("first") == F.col("__first")))
    final = F.greatest(F.size("h") - F.col("m") + 1, F.lit(1))
    starts = F.array_distinct(F.flatten(F.transform("spots", lambda p: F.sequence(F.greatest(p - F.col("m") + 1, F.lit(1)), F.least(p, final)))))
    windows = lives.select(*part, "h", "m", F.explode(starts).alias("i"))
    windows = windows.select("doc_id", "text_hash", (F.col("first") + F.col("i") - 2).alias("first_word"), "m", F.slice("h", F.col("i"), F.col("m")).alias("w"))
    fingerprinted = windows.withColumns({"fp": simhash(F.col("w"), lane), "counted": numbered(F.col("w"))}).drop("w")

    index = items.withColumns({"item_fp": simhash(F.col("item_shingles"), lane), "item_counted": numbered(F.col("item_shingles"))})
    index = cut(index.select("item_id", "m", "item_counted", "item_fp", F.posexplode(_block_values(F.col("item_fp"))).alias("block", "value")))
    index = _known(index, index.count())
    blocks = fingerprinted.select("*", F.posexplode_outer(_block_values(F.col("fp"))).alias("block", "value"))
    diff = F.col("fp").bitwiseXOR(F.col("item_fp"))
    near = blocks.join(index, ["m", "block", "value"]).where((F.bit_count(diff) <= RADIUS) & (_first_agreement(diff) == F.col("block")))

    # a set of numbered repeats is a multiset
    common = F.size(F.array_intersect(F.col("counted"), F.col("item_counted")))
    scored = near.withColumns({"common": common, "n": F.size("counted")})
    either = F.col("m") + F.col("n") - F.col("common")
    scored = scored.where(100 * F.col("common") >= percent * either).withColumn("similarity", F.col("common") / either)
    best = scored.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("neg"), "n")).alias("b"))
    best = best.select(
        "doc_id", "text_hash", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.neg")).alias("first_word"), (F.col("b.n") + SHINGLE - 1).alias("n_words")
    )
    return best.unionByName(short)


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that leak an item; columns unchanged."""
    found = cut(leaks(docs, benchmark, percent).select(F.col("doc_id").alias("__doc_id"), F.col("text_hash").alias("__text_hash")).distinct())
    bad = _known(found, found.count())
    keep = docs.join(bad, docs["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.xxhash64(docs["text"]) == F.col("__text_hash")), "left_anti")
    return keep.select(*docs.columns)
