"""Page relations: typing, title index, redirects, links, anchors, canonical targets."""

from __future__ import annotations

import tempfile
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.functions import text as X


#: Rows of a table of short strings that are broadcast at most.
BROADCAST_ROWS = 500_000


def _folder(spark) -> str:
    """A new name in the shared checkpoint folder.

    A folder of our own serves only where none is named and Spark runs in one process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="graphloom-"))
    return f"{context.getCheckpointDir()}/written-{uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, compressed, so that its lineage is cut."""
    path = _folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """``rows`` written like :func:`written`, dealt to ``parts`` by ``key``, so that those dealt alike are joined without a shuffle.

    Each task sorts what it writes by ``key``, so that columns of numbers take a fraction of the bytes that their rows take in a shuffle.
    """
    spark, name = rows.sparkSession, f"dealt_{uuid4().hex}"
    rows.write.bucketBy(parts, key).sortBy(key).option("path", _folder(spark)).option("compression", "zstd").format("parquet").saveAsTable(name)
    back = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return back


#: Parts of a union that are written as one before more are added; a plan with many parts grows past what Spark compiles.
PARTS = 8


def gathered(parts: list[DataFrame]) -> list[DataFrame]:
    """``parts``, written as one once there are ``PARTS`` of them."""
    return parts if len(parts) < PARTS else [written(united(parts))]


def united(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def page_stats(pages: DataFrame) -> DataFrame:
    """One row of counts by type."""
    names = {1: "article_count", 2: "category_count", 3: "redirect_count", 4: "disambig_count"}
    return pages.agg(*[F.count_if(F.col("type") == k).alias(name) for k, name in names.items()])


def title_index(pages: DataFrame) -> DataFrame:
    """(title, id): the last page with a title that isn't a redirect, else its first redirect; ``position`` is the dump order."""
    last = F.max_by("id", F.when(F.col("type") != 3, F.col("position")))
    first = F.min_by("id", F.when(F.col("type") == 3, F.col("position")))
    return pages.groupBy("title").agg(F.coalesce(last, first).alias("id"))


def last_redirects(redirects: DataFrame) -> DataFrame:
    """(from_id, to_id), one row a source: the last by ``position``, as a later line of a file replaces an earlier one."""
    if "position" not in redirects.columns:
        return redirects.groupBy("from_id").agg(F.min("to_id").alias("to_id"))
    return redirects.groupBy("from_id").agg(F.max_by("to_id", "position").alias("to_id"))


def resolve_redirects(redirects: DataFrame) -> DataFrame:
    """(from_id, final_id): redirects followed to the end by pointer jumping.

    A loop has no end: its own pages stay where they are, what leads into it ends where it enters.
    """
    start = written(last_redirects(redirects))
    n = start.count()

    def jump(edges: DataFrame) -> tuple[DataFrame, bool]:
        """(from_id, to_id) at the end, or after at least ``n`` redirects; whether any is still on its way."""
        state, steps = edges, 1
        while True:
            hop = state.select(F.col("from_id").alias("mid"), F.col("to_id").alias("next"))
            jumped = state.join(hop, F.col("to_id") == F.col("mid"), "left")
            state = written(jumped.select("from_id", F.coalesce("next", "to_id").alias("to_id"), F.col("mid").isNotNull().alias("open")))
            still = not state.where("open").isEmpty()
            if not still or steps > n:
                return state, still
            state, steps = state.drop("open"), 2 * steps

    ended, looped = jump(start)
    if looped:
        # after so many redirects, all that are still on their way are in a loop, and every page of a loop is reached by one
        loops = written(ended.where("open").select(F.col("to_id").alias("from_id")).distinct())
        tails, _ = jump(written(start.join(loops, "from_id", "left_anti")))
        ended = tails.select("from_id", "to_id").unionByName(loops.select("from_id", F.col("from_id").alias("to_id")))
    return ended.select("from_id", F.col("to_id").alias("final_id"))


def links_of(texts: DataFrame, nested: bool = True) -> DataFrame:
    """(id, pos, markup) of every link of ``texts`` (id, text)."""
    from graphloom.functions.wikitext import extract_links

    found = extract_links("text") if nested else X.flat_links(F.col("text"))
    return texts.select("id", F.posexplode(found).alias("pos", "markup"))


def anchor_frequencies(links: DataFrame, category: str = "category") -> DataFrame:
    """(anchor, target, freq) of links (markup) by their title, category links left out (see ``extraction`` for resolved ids)."""
    parsed = links.select(X.parse_link(F.col("markup")).alias("l")).where(~F.startswith(F.lower(F.ltrim("l.title")), F.lit(f"{category.lower()}:")))
    return parsed.groupBy(F.col("l.anchor").alias("anchor"), F.col("l.title").alias("target")).agg(F.count(F.lit(1)).alias("freq"))


def seed_anchors(anchors: DataFrame, titles: DataFrame) -> DataFrame:
    """Anchors (anchor, target_id, freq) and, with frequency 0, the titles (anchor, target_id) that are none yet."""
    fresh = titles.join(anchors, ["anchor", "target_id"], "left_anti").select("anchor", "target_id", F.lit(0).cast("bigint").alias("freq"))
    return anchors.unionByName(fresh)


def disambiguation_index(lines: DataFrame) -> DataFrame:
    """(id, target_id, index): resolved links numbered within their page."""
    return lines.withColumn("index", F.row_number().over(Window.partitionBy("id").orderBy("line_no")))


def packed(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """(keys, word, bits): the sets of a whole number ``value`` by ``keys``, 64 neighbouring numbers to a row."""
    bit = F.expr(f"shiftleft(1L, cast({value} & 63 as int))")
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, F.shiftright(F.col(value).cast("bigint"), 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def unpacked(sets: DataFrame, value: str) -> DataFrame:
    """The rows (..., ``value``) that ``sets`` (..., word, bits) stand for."""
    one = sets.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(63)))).where("shiftrightunsigned(bits, __i) & 1L = 1L")
    return one.withColumn(value, F.col("word") * 64 + F.col("__i")).drop("word", "bits", "__i")


def short(rows: DataFrame) -> DataFrame:
    """Written ``rows``, to be broadcast in a join if there are ``BROADCAST_ROWS`` at most."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def marks(ids: DataFrame) -> DataFrame:
    """The packed set (word, known) of ``ids`` (id), for :func:`among`."""
    return short(written(packed(ids, "id").withColumnRenamed("bits", "known")))


def among(rows: DataFrame, column: str, marked: DataFrame, outside: bool = False) -> DataFrame:
    """``rows`` whose whole number in ``column`` is of a set of :func:`marks` (``outside``: isn't); they stay where they are if that is short."""
    value = F.col(column).cast("bigint")
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
    known = F.col("known").bitwiseAND(bit) != 0
    met = rows.join(marked, F.shiftright(value, 6) == F.col("word"), "left" if outside else "inner")
    return met.where(~F.coalesce(known, F.lit(False)) if outside else known).drop("word", "known")


def inner_edges(edges: DataFrame) -> DataFrame:
    """The distinct ``edges`` (u, v) that lead to sources, as (id, mid)."""
    return written(among(edges, "v", marks(edges.select(F.col("u").alias("id")))).select(F.col("u").alias("id"), F.col("v").cast("bigint").alias("mid")).distinct())


def _steps(edges: DataFrame, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packed sets (id, word, bits) of the ``articles`` (id) that ``edges`` (u, v) lead to at once, and the edges (id, mid) that lead to sources."""
    links = written(packed(edges.select(F.col("u").alias("id"), F.col("v").alias("target")), "target", "id"))

    def within(ids: DataFrame) -> DataFrame:
        known = packed(ids, "id").withColumnRenamed("bits", "known")
        return links.join(known, "word").select("id", "word", F.col("bits").bitwiseAND(F.col("known")).alias("bits")).where("bits != 0")

    return written(within(articles)), written(unpacked(within(links.select("id").distinct()), "mid"))


def reach(edges: DataFrame, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packed sets (id, word, bits) of the ``articles`` (id) that each source of ``edges`` (u, v) reaches.

    The first are those of sources whose edges lead to no source, so that they end after one step; the second of all others.
    These grow by what was new to their successors in the round before, until nothing is.
    """
    direct, inner = _steps(edges, articles)
    ids = inner.select("id").distinct()
    same = ids.select(F.col("id").alias("__id"))
    opened = [direct.join(same, F.col("id").eqNullSafe(F.col("__id")), "left_semi")]
    closed = direct.join(same, F.col("id").eqNullSafe(F.col("__id")), "left_anti")
    new = direct.join(inner.select(F.col("mid").alias("id")).distinct(), "id", "left_semi")
    while not new.isEmpty():
        further = inner.join(new.withColumnRenamed("id", "mid"), "mid").groupBy("id", "word").agg(F.bit_or("bits").alias("came"))
        seen = united(opened).groupBy(F.col("id").alias("__id"), F.col("word").alias("__word")).agg(F.bit_or("bits").alias("had"))
        both = further.join(seen, F.col("id").eqNullSafe(F.col("__id")) & (F.col("word") == F.col("__word")), "left")
        new = written(both.select("id", "word", F.expr("came & ~coalesce(had, 0L)").alias("bits")).where("bits != 0"))
        opened = gathered([*opened, new])
    return closed, united(opened).groupBy("id", "word").agg(F.bit_or("bits").alias("bits"))


def canonical(edges: DataFrame, articles: DataFrame) -> DataFrame:
    """(id, target) of every source of ``edges`` (u, v) and the ``articles`` (id) it reaches."""
    closed, opened = reach(edges, articles)
    return unpacked(closed.unionByName(opened), "target")


def loops(edges: DataFrame) -> DataFrame:
    """(id, loop): vertices of ``edges`` (u, v), with the same number for those that lead to each other; others may be left out.

    Edges before or behind all loops go first.  Then each vertex learns the highest one that leads to it, and what leads to
    that one among those that learned of it makes one loop; this is repeated with the rest.
    """
    left = written(edges.where("u != v").select("u", "v").distinct())
    found = [left.select(F.col("u").alias("id"), F.col("u").alias("loop")).limit(0)]
    n = left.count()
    while n:
        kept = written(among(among(left, "u", marks(left.select(F.col("v").alias("id")))), "v", marks(left.select(F.col("u").alias("id")))))
        before, left, n = n, kept, kept.count()
        if n < before:
            continue
        top = written(left.select(F.col("u").alias("id")).distinct().withColumn("loop", F.col("id")))
        new = top
        while not new.isEmpty():
            came = left.join(short(new.withColumnRenamed("id", "u")), "u").groupBy(F.col("v").alias("id")).agg(F.max("loop").alias("came"))
            new = written(came.join(top, "id").where("came > loop").select("id", F.col("came").alias("loop")))
            top = written(top.unionByName(new).groupBy("id").agg(F.max("loop").alias("loop")))
        back = left.join(short(top.withColumnRenamed("id", "u")), "u").join(short(top.select(F.col("id").alias("v"), F.col("loop").alias("other"))), "v")
        back = written(back.where("loop = other").select("u", "v", "loop"))
        new = written(top.where("id = loop"))
        seen = [new]
        while not new.isEmpty():
            came = back.join(short(new.select(F.col("id").alias("v"))), "v").select(F.col("u").alias("id"), "loop").distinct()
            new = written(came.join(united(seen).select("id"), "id", "left_anti"))
            seen = gathered([*seen, new])
        found = gathered([*found, *seen])
        done = marks(united(seen))
        left = written(among(among(left, "u", done, outside=True), "v", done, outside=True))
        n = left.count()
    return written(united(found))


#: Members of a loop whose equal lines are made by one task.
SHARE = 64

#: Articles whose edges are kept together, as a power of two.
BLOCK = 12


def canonical_lists(edges: DataFrame, articles: DataFrame) -> DataFrame:
    """(id, arts): the targets of :func:`canonical` in order, joined by commas.

    Sources that lead to no source are dealt once.  Of the others, those that lead to each other have one line; what
    sources reach is told by vertices, and becomes packed sets of articles in one step, where the edges are read.
    """
    lead = among(edges, "v", marks(articles)).select(F.col("u").alias("id"), F.col("v").cast("bigint").alias("target"))
    inner = inner_edges(edges)
    opened = marks(inner.select("id"))
    listed = F.transform(F.array_sort(F.collect_set("target")), lambda t: t.cast("string"))
    plain = among(lead, "id", opened, outside=True).where("id IS NOT NULL").groupBy("id").agg(F.array_join(listed, ",").alias("arts"))

    ring = loops(among(inner, "mid", opened).select(F.col("id").alias("u"), F.col("mid").alias("v")).where("u IS NOT NULL"))
    known = short(ring.withColumnRenamed("id", "__id"))
    named = lambda rows, name: rows.join(known, F.col(name) == F.col("__id"), "left").withColumn(name, F.coalesce("loop", name)).drop("__id", "loop")
    joined = written(named(named(inner.select(F.col("id").alias("u"), F.col("mid").alias("v")), "u"), "v").distinct())
    far, near = reach(joined, joined.select(F.col("v").alias("id")))
    # a source that isn't known (null) may lead to sources or not
    own = joined.select("u").union(edges.sparkSession.sql("SELECT CAST(NULL AS BIGINT)")).distinct().select(F.col("u").alias("id"), F.col("u").alias("node"))
    after = written(unpacked(far.unionByName(near), "node").select("id", "node").unionByName(own))
    # all edges to neighbouring articles meet in one task, so that what sources reach by many ways is told once
    at = named(lead.withColumnRenamed("id", "at"), "at").withColumn("block", F.shiftright("target", BLOCK)).repartition("block")
    if after.count() <= 8 * BROADCAST_ROWS:
        lists = F.broadcast(after.groupBy("node").agg(F.collect_list(F.struct("id")).alias("ids")))
        met = at.join(lists, F.col("at").eqNullSafe(F.col("node"))).select(F.inline("ids"), "target", "block")
    else:
        met = at.join(after, F.col("at").eqNullSafe(F.col("node"))).select("id", "target", "block")

    place = F.row_number().over(Window.partitionBy("loop").orderBy("member")) - 1
    sizes = short(written(ring.groupBy("loop").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("shares"))))
    members = ring.withColumnRenamed("id", "member").withColumn("place", place).join(sizes, "loop").select("loop", "member", (F.col("place") % F.col("shares")).alias("turn"))
    dealt = packed(met, "target", "id", "block").join(sizes, F.col("id") == F.col("loop"), "left")
    dealt = dealt.select("id", "word", "bits", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("shares", F.lit(1)) - 1)).alias("share")).repartition("id", "share")
    text = lambda x: F.concat_ws(",", *[F.when(F.shiftrightunsigned(x["bits"], i).bitwiseAND(F.lit(1).cast("bigint")) == 1, (x["word"] * 64 + i).cast("string")) for i in range(64)])
    words = dealt.groupBy("id", "share").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    lines = words.select("id", "share", F.array_join(F.transform("words", text), ",").alias("arts"))
    whole = lines.join(members, (F.col("id") == F.col("loop")) & (F.col("share") == F.col("turn")), "left")
    return plain.unionByName(whole.select(F.coalesce("member", "id").alias("id"), "arts"))


def canonical_span(edges: DataFrame, articles: DataFrame) -> DataFrame:
    """(id, target): of the targets of :func:`canonical` the lowest and the highest, one row where they are the same.

    That tells which target is the only one, in two numbers a source.  Edges are tested where they are read; only the two
    numbers and the edges that lead to sources are dealt.
    """
    span = lambda rows: rows.groupBy("id").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    target = F.col("v").cast("bigint")
    first = written(span(among(edges, "v", marks(articles)).select(F.col("u").alias("id"), target.alias("low"), target.alias("high"))))
    inner = inner_edges(edges)
    ids = inner.select(F.col("id").alias("__id")).distinct()
    closed = first.join(ids, F.col("id").eqNullSafe(F.col("__id")), "left_anti")
    best = first.join(ids, F.col("id").eqNullSafe(F.col("__id")), "left_semi")
    mids = marks(inner.select(F.col("mid").alias("id")))
    new = written(among(first, "id", mids))
    while not new.isEmpty():
        came = span(inner.join(short(new.withColumnRenamed("id", "mid")), "mid").select("id", "low", "high"))
        had = best.select(F.col("id").alias("__id"), F.col("low").alias("had_low"), F.col("high").alias("had_high"))
        wider = came.join(had, F.col("id").eqNullSafe(F.col("__id")), "left").where("had_low IS NULL OR low < had_low OR high > had_high")
        grown = written(wider.select("id", F.least("low", "had_low").alias("low"), F.greatest("high", "had_high").alias("high")))
        best = written(span(best.unionByName(grown)))
        new = written(among(grown, "id", mids))
    return closed.unionByName(best).select("id", F.explode(F.array_distinct(F.array("low", "high"))).alias("target"))


def _ends(pages: DataFrame, canon: DataFrame, sets: list[DataFrame]) -> DataFrame:
    """(id, end, title) of the ids in all ``sets`` (:func:`marks`) that have one end: the only canonical target of an id, or the id itself where it has none.

    Titles stay where they are read, unless there are too many targets to be broadcast.
    """
    titles = pages.where(X.truthy(F.col("title"))).select(F.col("id").alias("end"), "title")
    asked = lambda rows, column: reduce(lambda left, marked: among(left, column, marked), sets, rows)
    spans = written(asked(canon, "id").groupBy("id").agg(F.min("target").alias("only"), F.max("target").alias("last")))
    own = among(asked(titles, "end"), "end", marks(spans.select("id")), outside=True).select(F.col("end").alias("id"), "end", "title")
    led = titles.join(short(spans.where("only = last").select("id", "only")), F.col("only") == F.col("end")).select("id", "end", "title")
    return written(own.unionByName(led).withColumn("title", X.normalize_title(F.col("title"))))


#: Ends of one part; Spark is left to join twice as many.
ENDS = 50_000


def _met(rows: DataFrame, key: str, ends: DataFrame, *others: DataFrame) -> DataFrame:
    """``rows`` joined by ``key`` with written ``ends``; where these are many, both are dealt to files, not shuffled.

    Of the rows, those go there whose numbers are all among the first columns, of the same names, of ``ends`` and ``others``.  The rows of an end stay in one task.
    """
    n = ends.count()
    if n <= 2 * ENDS:
        return rows.join(ends, key)
    for known in (ends, *others):
        rows = among(rows, known.columns[0], marks(known.select(F.col(known.columns[0]).alias("id"))))
    return dealt(rows, key, n // ENDS + 1).join(dealt(ends, key, n // ENDS + 1).hint("merge"), key)


def category_relation(links: DataFrame, pages: DataFrame, canon: DataFrame) -> DataFrame:
    """Edges (u, v, s, d) from the canonical titles of pages that aren't categories to the titles of their categories.

    A known target that is no category is an error when the result is read, or before where links are dealt.
    """
    types = pages.groupBy(F.col("id").alias("v")).agg(F.bool_or(F.col("type") == 2).alias("category"))
    bad = F.raise_error(F.concat(F.lit("no category: "), F.col("v").cast("string"))).cast("bigint")
    checked = links.join(types, "v").select("u", F.when(F.col("category"), F.col("v")).otherwise(bad).alias("v"))
    return relation(checked, pages, canon, "C1", (1, 3, 4), targets=links.select("v"))


def relation(links: DataFrame, pages: DataFrame, canon: DataFrame, source: str, u_types: tuple[int, ...] = (1,), v_types: tuple[int, ...] | None = None, targets: DataFrame | None = None) -> DataFrame:
    """Edges (u, v, s, d) between canonical titles of links (u, v) whose ends have the given types.

    Of ``canon`` (id, target) the lowest and the highest target of an id are enough.  Ends are found by page, so each link is joined twice only;
    ends of what links lead to (``targets``, with a column v, if told) are broadcast where they are few, so that links are dealt once, without titles,
    and only those with two ends.
    """
    typed = {types: [marks(pages.where(F.col("type").isin(*types)).select("id"))] if types else [] for types in {u_types, v_types}}
    linked = marks((links if targets is None else targets).select(F.col("v").alias("id")))
    first = _ends(pages, canon, typed[u_types]).select(F.col("id").alias("u"), F.col("end").alias("cu"), F.col("title").alias("tu"))
    second = _ends(pages, canon, [linked, *typed[v_types]]).select(F.col("id").alias("v"), F.col("end").alias("cv"), F.col("title").alias("tv"))
    found = _met(links.select("u", "v"), "u", first, second)
    found = found.join(F.broadcast(second), "v") if second.count() <= BROADCAST_ROWS else _met(found, "v", second)
    found = found.where("cu != cv")
    return found.select(F.col("tu").alias("u"), F.col("tv").alias("v"), F.lit(source).alias("s"), F.lit(1).alias("d"))


def edge_lines(edges: DataFrame) -> DataFrame:
    return edges.select(F.concat(F.lit("u:"), "u", F.lit(" v:"), "v", F.lit(" s:"), "s", F.lit(" d:"), F.col("d").cast("string")).alias("value"))


#: Rows of a task, where the number of tasks must follow the number of rows.
TASK_ROWS = 500_000


def bothdirs(edges: DataFrame) -> DataFrame:
    """The distinct edges (u, v) whose reverse is an edge too.

    Only edges between vertices that are both a source and a target are dealt, as pairs without direction, in tasks of bounded size.
    """
    ends = written(edges.select(F.col("u").alias("id")).distinct().join(edges.select(F.col("v").alias("id")).distinct(), "id", "left_semi"))
    ends = F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends
    kept = edges.select("u", "v")
    for end in ("v", "u"):
        kept = kept.join(ends.select(F.col("id").alias(end)), end, "left_semi")
    pairs = written(kept.select(F.least("u", "v").alias("low"), F.greatest("u", "v").alias("high"), (F.col("u") <= F.col("v")).alias("up"), (F.col("u") >= F.col("v")).alias("down")))
    dealt = pairs.repartition(pairs.count() // TASK_ROWS + 1, "low", "high")
    both = dealt.groupBy("low", "high").agg(F.bool_or("up").alias("up"), F.bool_or("down").alias("down")).where("up AND down")
    turned = F.array_distinct(F.array(F.struct(F.col("low").alias("u"), F.col("high").alias("v")), F.struct(F.col("high").alias("u"), F.col("low").alias("v"))))
    return both.select(F.inline(turned))


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u").alias("id")).union(edges.select(F.col("v").alias("id"))).distinct()


def dictionary(titles: DataFrame, anchors: DataFrame, pages: DataFrame) -> DataFrame:
    """(headword, entity, weight) from titles (headword, id, weight) and anchors (headword, id, weight).

    Weights are added by id, then by entity name (ids whose titles normalise alike merge).
    """
    by_id = titles.unionByName(anchors).where(F.length("headword") >= 2).groupBy("headword", "id").agg(F.sum("weight").alias("weight")).where("weight != 0")
    named = by_id.join(pages.where("type = 1").select("id", X.normalize_title(F.col("title")).alias("entity")), "id").where(X.truthy(F.col("entity")))
    return named.groupBy("headword", "entity").agg(F.sum("weight").cast("bigint").alias("weight"))


def dictionary_lines(entries: DataFrame) -> DataFrame:
    """(headword, entities): ``entity:weight`` by falling weight, then name."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("w"), "entity")))
    line = F.array_join(F.transform(listed, lambda x: F.concat(x["entity"], F.lit(":"), (-x["w"]).cast("string"))), " ")
    return entries.groupBy("headword").agg(line.alias("entities"))


def filter_dictionary(entries: DataFrame, edges: DataFrame) -> DataFrame:
    """The entries whose entity is a vertex of the graph."""
    return entries.join(vertices(edges).withColumnRenamed("id", "entity"), "entity", "left_semi")


def ngram_frequencies(texts: DataFrame, longest: int = 11) -> DataFrame:
    """(ngram, df): in how many lines of ``texts`` (text) each n-gram occurs."""
    return texts.select(F.explode(X.ngrams(F.col("text"), longest)).alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("df"))


def anchor_occurrence(texts: DataFrame, anchors: DataFrame, longest: int = 11) -> DataFrame:
    """(anchor, link_count, doc_freq) of the anchors (anchor, freq) that occur in ``texts``; only n-grams that are anchors are counted."""
    counts = written(anchors.groupBy("anchor").agg(F.sum("freq").cast("bigint").alias("link_count")))
    known = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    grams = texts.select(F.explode(X.ngrams(F.col("text"), longest)).alias("anchor")).join(known.select("anchor"), "anchor", "left_semi")
    return counts.join(grams.groupBy("anchor").agg(F.count(F.lit(1)).alias("doc_freq")), "anchor")


def sized(entries: DataFrame) -> DataFrame:
    """(n_headwords, n_entries) of a dictionary (headword, entity)."""
    return entries.agg(F.count_distinct("headword").alias("n_headwords"), F.count(F.lit(1)).alias("n_entries"))


def round_robin(rows: DataFrame, n: int, order: str) -> DataFrame:
    """``rows`` with part = position modulo n in the order of a column (counted per range partition, then summed up)."""
    parts = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("__p", F.spark_partition_id())
    parts = written(parts)
    sizes = parts.groupBy("__p").count()
    starts = sizes.withColumn("start", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = parts.join(F.broadcast(starts.select("__p", "start")), "__p").withColumn("__k", F.row_number().over(Window.partitionBy("__p").orderBy(order)))
    return placed.withColumn("part", ((F.col("start") + F.col("__k")) % n).cast("int")).drop("__p", "__k", "start")


def double_redirects(redirects: DataFrame) -> DataFrame:
    """Redirects whose target is a redirect."""
    return redirects.join(redirects.select(F.col("from_id").alias("to_id")).distinct(), "to_id", "left_semi")


def langlinks(pages: DataFrame, links: DataFrame, lang: str, include_categories: bool = False) -> DataFrame:
    """(id, title_from, title_to) of links (id, lang, title) in one language; with a ``position``, the last of a page counts."""
    if "position" in links.columns:
        links = links.groupBy("id", "lang").agg(F.max_by("title", "position").alias("title"))
    kept = links.where((F.col("lang") == lang) & X.truthy(F.col("title")))
    if include_categories:
        kept = kept.withColumn("title", F.regexp_replace("title", "(?i)^Category:", ""))
    else:
        kept, pages = kept.where(~F.col("title").rlike("(?i)^Category:")), pages.where("type = 1")
    return kept.join(pages.select("id", F.col("title").alias("t")), "id").select("id", X.normalize_title(F.col("t")).alias("title_from"), X.normalize_title(F.col("title")).alias("title_to"))
