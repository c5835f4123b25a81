"""Mixing sources to target weights.

1. Words of each source are packed into blocks of ``BLOCK`` words, or of a ``PARTS``-th of its target
   if that is less, so that whole blocks come near the target of a small source too.  A source's
   documents are dealt into buckets by hash (about the square root of all rows
   in each), packed in order of doc_id within a bucket, and the
   buckets' blocks are numbered one after the other: no task sees a whole source.
2. Targets: the sources (code-point order, null last) weigh 3, 1, 2, repeating, and share
   ``share`` times all words; a source takes ``repeat`` times its words at most
   and what it can't take is shared again by weight.
3. The output is shards of ``SHARD`` slots.  Every slot draws its source; the
   counts by shard are multinomial.  A source's last slots are then dropped,
   or further ones dealt to shards by hash, until it has exactly the blocks of its target.
4. Slot ``j`` of a source takes block ``p(j mod n)`` of its ``n`` blocks, where ``p`` is a
   pseudorandom permutation for each source and pass (a Feistel network
   over a square just above ``n``, walked until it is inside).  A pass takes each block
   once, so no block is taken more often than there are passes.
5. Slots and blocks are joined by block number.

Only DataFrame functions; tables with a row for each source are broadcast
behind a check of their size.

Defined cases: null and wordless texts have size 0 and give nothing; a null
source is a source; a table without words takes nothing (targets 0); repeated
rows are packed one after the other; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import WORD, cut, word_count

BLOCK = 128
SHARD = 4096
#: A source's target is this many blocks at least.
PARTS = 200
WEIGHTS = (3, 1, 2)
#: Rows of a table by source that are broadcast at most.
BROADCAST_SOURCES = 10_000
SEED = 2024


def _small(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_SOURCES else frame


def _running(frame: DataFrame, key: str, order: str, value: str, out: str, chunk: int = SHARD) -> DataFrame:
    """``frame`` with ``out``, the sum of ``value`` over the rows of its ``key`` with a smaller ``order`` (whole numbers).

    Sums of ``chunk`` neighbours are added up first, so no task holds all rows of a key.
    """
    frame = frame.withColumn("__chunk", F.floor(F.col(order) / chunk))
    upto = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = frame.groupBy(key, "__chunk").agg(F.sum(value).alias("__sum")).withColumn("__before", F.coalesce(F.sum("__sum").over(upto), F.lit(0)))
    within = Window.partitionBy(key, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    both = frame.join(chunks.drop("__sum"), [key, "__chunk"])
    return both.withColumn(out, F.col("__before") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("__chunk", "__before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """``sizes`` (source, size and more) with s (number of the source, from 0), weight and target.

    Sources fill up in order of cap over weight; once the level reached by those
    that are full covers the rest, the others get weight times that level.
    """
    ranked = sizes.withColumn("s", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight, "cap": F.col("size") * F.lit(float(repeat))})
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "s")
    every = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns(
        {
            "left": F.lit(float(share)) * F.sum("size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # the level, if this source is the first that isn't full
    ranked = ranked.withColumn("level", F.col("left") / F.col("open"))
    ranked = ranked.withColumn("first_open", F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct(F.col("cap") / F.col("weight"), "s", "level"))).over(every))
    target = F.when(F.col("first_open").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("first_open.level")))
    return ranked.withColumn("target", target).drop("cap", "left", "open", "level", "first_open")


def _permuted(x: Column, n: Column, side: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n - 1 for each ``key``; ``side`` squared is at least ``n``."""
    kind = "struct<l:bigint,r:bigint>"

    def once(y: Column) -> Column:
        halves = F.struct(F.floor(y / side).cast("long").alias("l"), F.pmod(y, side).alias("r"))
        mixed = F.aggregate(
            F.array(*[F.lit(k) for k in range(4)]),
            halves.cast(kind),
            lambda acc, k: F.struct(acc["r"].alias("l"), F.pmod(acc["l"] + F.pmod(F.xxhash64(acc["r"], k, *key, F.lit(SEED)), side), side).alias("r")).cast(kind),
        )
        return F.aggregate(F.array(mixed), F.lit(0).cast("long"), lambda _, m: m["l"] * side + m["r"])

    # few places lie outside (2 * sqrt(n) + 1 at most), so the walk ends within a few steps
    return F.aggregate(F.sequence(F.lit(1), F.lit(64)), once(x), lambda acc, _: F.when(acc < n, acc).otherwise(once(acc)))


class Mix:
    """The plan of one mix over ``docs`` (doc_id, text, source); ``block`` is the most words of a block."""

    def __init__(self, docs: DataFrame, block: int = BLOCK, shard: int = SHARD, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeat: float = 2.0):
        docs = docs.select("doc_id", "text", "source")  # other columns may have the names that are used here
        self.docs, self.block, self.shard, self.repeat = docs, block, shard, repeat
        sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")))
        by_source = cut(sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n_rows")))
        self.n_rows = by_source.agg(F.sum("n_rows")).first()[0] or 0
        self.sources = cut(targets(by_source, weights, share, repeat))
        self.placed = self._place(sized)
        ends = self.placed.groupBy("s", "bucket", "block").agg(F.max(F.col("off") + F.col("size")).alias("words"))
        ends = ends.withColumn("n", F.ceil(F.col("words") / F.col("block")).cast("long"))
        #: (s, bucket, block, words, n, first block)
        self.buckets = cut(_running(ends, "s", "bucket", "n", "first"))
        self.slots = self._slots()

    def _length(self) -> Column:
        """Words in a block of a source, from its target."""
        return F.greatest(F.lit(1), F.least(F.lit(self.block), F.floor(F.col("target") / PARTS))).cast("int")

    def _key(self, frame: DataFrame) -> DataFrame:
        """``frame`` with s, source_size, target, block and bucket."""
        wide = max(1, int(self.n_rows**0.5))
        known = self.sources.select(F.col("source").alias("__source"), "s", F.col("size").alias("source_size"), "target", self._length().alias("block"), F.ceil(F.col("n_rows") / wide).alias("n_buckets"))
        found = frame.join(_small(known), frame["source"].eqNullSafe(F.col("__source")))
        return found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie", F.lit(SEED)), "n_buckets").cast("int")).drop("__source", "n_buckets")

    def _place(self, sized: DataFrame) -> DataFrame:
        """doc_id, s, bucket, row (number in the bucket), off (words before it), size, source_size, target, block."""
        order = Window.partitionBy("s", "bucket").orderBy("doc_id", "tie", "size")
        off = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return cut(self._key(sized).withColumns({"row": F.row_number().over(order), "off": off}).drop("source"))

    def _slots(self) -> DataFrame:
        """(shard, slot, s, number): the block of every slot; ``slot`` numbers a shard's slots of one source."""
        blocks = self.buckets.groupBy("s").agg(F.sum("n").alias("n"))
        quotas = self.sources.join(blocks, "s").select(
            "s", "n", F.least(F.round(F.col("target") * F.col("n") / F.col("size")), F.floor(F.col("n") * self.repeat)).cast("long").alias("quota")
        )
        quotas = cut(quotas.where("size > 0 AND quota > 0"))
        total = quotas.agg(F.sum("quota")).first()[0] or 0
        n_shards = -(-total // self.shard)
        spark = self.docs.sparkSession
        # the law of a slot's source: the unit interval in parts, looked up by the cells that they reach into
        upto = F.sum("quota").over(Window.orderBy("s")) / max(1, total)
        law = quotas.select("s", upto.alias("upto")).withColumn("above", F.coalesce(F.lag("upto").over(Window.orderBy("s")), F.lit(0.0)))
        cells = max(1, quotas.count())
        reach = F.sequence(F.floor(F.col("above") * cells), F.least(F.floor(F.col("upto") * cells), F.lit(cells - 1)))
        law = cut(law.where("upto > above").withColumn("cell", F.explode(reach)))
        shards = spark.range(n_shards).select(F.col("id").alias("shard"))
        slots = F.least(F.lit(self.shard).cast("long"), F.lit(total) - F.col("shard") * self.shard)
        drawn = shards.select("shard", F.explode(F.sequence(F.lit(1).cast("long"), slots)).alias("k"))
        drawn = drawn.withColumn("u", F.pmod(F.xxhash64("shard", "k", F.lit(SEED)), F.lit(1 << 53)) / float(1 << 53))
        drawn = drawn.withColumn("cell", F.floor(F.col("u") * cells)).join(_small(law), "cell").where("u >= above AND u < upto")
        counts = cut(drawn.groupBy("shard", "s").count())
        small = _small(quotas.withColumn("side", F.ceil(F.sqrt(F.col("n"))).cast("long")))
        runs = _running(counts, "s", "shard", "count", "start").join(small, "s")
        runs = runs.withColumn("end", F.least(F.col("start") + F.col("count"), "quota")).where("end > start")
        own = runs.select("s", "n", "side", "shard", F.explode(F.sequence("start", F.col("end") - 1)).alias("j"))
        # what the draw left short goes to shards by hash
        got = runs.groupBy("s").agg(F.max("end").alias("got"))
        short = small.join(got, "s", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < quota")
        extra = short.select("s", "n", "side", F.explode(F.sequence("got", F.col("quota") - 1)).alias("j"))
        extra = extra.select("s", "n", "side", F.pmod(F.xxhash64("s", "j", F.lit(SEED)), F.lit(max(1, n_shards))).alias("shard"), "j")
        both = own.unionByName(extra)
        round_ = F.floor(F.col("j") / F.col("n"))
        number = _permuted(F.pmod("j", "n"), F.col("n"), F.col("side"), F.col("s"), round_)
        return cut(both.select("shard", F.col("j").alias("slot"), "s", number.alias("number")))

    def _pieces(self, placed: DataFrame) -> DataFrame:
        """``placed`` with a row for each block that a document reaches: number, and the words [a, b) of the document."""
        first = self.buckets.select("s", "bucket", "first")
        low, high = F.floor(F.col("off") / F.col("block")), F.floor((F.col("off") + F.col("size") - 1) / F.col("block"))
        cut_up = placed.where("size > 0").join(first, ["s", "bucket"]).withColumn("local", F.explode(F.sequence(low, high)))
        a = F.greatest(F.col("local") * F.col("block") - F.col("off"), F.lit(0))
        b = F.least((F.col("local") + 1) * F.col("block") - F.col("off"), "size")
        return cut_up.withColumns({"number": F.col("first") + F.col("local"), "a": a, "b": b})

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken (words that the mix takes, repeats counted) for each row of the documents."""
        times = self.slots.groupBy("s", "number").agg(F.count(F.lit(1)).alias("times"))
        pieces = self._pieces(self.placed).select("s", "bucket", "row", "number", (F.col("b") - F.col("a")).alias("words"))
        sums = pieces.join(times, ["s", "number"]).groupBy("s", "bucket", "row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        out = self.placed.join(sums, ["s", "bucket", "row"], "left")
        return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def blocks(self) -> DataFrame:
        """The mix itself: shard, slot, source, block (its number in the source), doc_ids, n_words and text, words joined by a space."""
        keyed = self._key(self.docs.select("doc_id", "source", "text", F.xxhash64("text").alias("tie"), word_count(F.col("text")).alias("size")).where("size > 0"))
        order = Window.partitionBy("s", "bucket").orderBy("doc_id", "tie", "size")
        # documents without words don't move the others
        placed = keyed.withColumn("off", F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        placed = placed.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).drop("text")
        pieces = self._pieces(placed).select("source", "s", "number", "off", "doc_id", F.array_join(F.slice("words", (F.col("a") + 1).cast("int"), (F.col("b") - F.col("a")).cast("int")), " ").alias("text"), (F.col("b") - F.col("a")).alias("n"))
        packed = pieces.groupBy("s", "number").agg(F.first("source").alias("source"), F.array_sort(F.collect_list(F.struct("off", "doc_id", "text", "n"))).alias("p"))
        packed = packed.select(
            "s", "number", "source", F.transform("p", lambda p: p["doc_id"]).alias("doc_ids"),
            F.aggregate("p", F.lit(0).cast("long"), lambda acc, p: acc + p["n"]).alias("n_words"),
            F.array_join(F.transform("p", lambda p: p["text"]), " ").alias("text"),
        )
        out = self.slots.join(packed, ["s", "number"])
        return out.select("shard", "slot", "source", F.col("number").alias("block"), "doc_ids", "n_words", "text")
