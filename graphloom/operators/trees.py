"""Queries on ordered trees given as (node_id, parent_id, ordinal, name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.operators.relations import gathered, united, written


def with_paths(tree: DataFrame) -> DataFrame:
    """``tree`` with path (ids from the root) and address (``0:i:j``), built level by level; a node that is its own ancestor is an error."""
    tree = written(tree)
    level = written(tree.where("parent_id IS NULL").withColumns({"path": F.array("node_id"), "address": F.lit("0")}))
    parts = [level]
    while not level.isEmpty():
        above = level.select(F.col("node_id").alias("parent_id"), F.col("path").alias("up"), F.col("address").alias("at"))
        level = tree.join(above, "parent_id").withColumn("path", F.concat("up", F.array("node_id"))).withColumn("address", F.concat("at", F.lit(":"), F.col("ordinal").cast("string")))
        level = written(level.select(*parts[0].columns))
        parts = gathered([*parts, level])
    found = united(parts)
    lost = tree.join(found.select("node_id"), "node_id", "left_anti")
    # what hangs below no node at all is left out, but a node without a root above it is in a loop or below one
    loop = lost.join(tree.select(F.col("node_id").alias("parent_id")), "parent_id", "left_semi")
    if not loop.isEmpty() and not _hangs_loose(lost, tree):
        raise ValueError("a node is its own ancestor")
    return found


def _hangs_loose(lost: DataFrame, tree: DataFrame) -> bool:
    """Whether every node without a path is below one whose parent doesn't exist."""
    top = written(lost.join(tree.select(F.col("node_id").alias("parent_id")), "parent_id", "left_anti").select("node_id"))
    rest = lost.join(top, "node_id", "left_anti")
    while not top.isEmpty():
        top = written(rest.join(top.withColumnRenamed("node_id", "parent_id"), "parent_id", "left_semi").select("node_id"))
        rest = written(rest.join(top, "node_id", "left_anti"))
    return rest.isEmpty()


def ancestors(paths: DataFrame) -> DataFrame:
    """(node_id, pos, ancestor), nearest first."""
    up = F.reverse(F.slice("path", 1, F.size("path") - 1))
    return paths.select("node_id", F.posexplode(up).alias("pos", "ancestor"))


def descendants(paths: DataFrame) -> DataFrame:
    """(ancestor, node_id) for every node below another."""
    return ancestors(paths).select("ancestor", "node_id")


def leaves(tree: DataFrame) -> DataFrame:
    inner = tree.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("node_id")).distinct()
    return tree.join(inner, "node_id", "left_anti")


def depth_under(paths: DataFrame) -> DataFrame:
    """(node_id, depth): branches to the farthest node below."""
    below = paths.select(F.explode("path").alias("top"), F.size("path").alias("n"))
    deepest = below.groupBy(F.col("top").alias("node_id")).agg(F.max("n").alias("n"))
    return paths.join(deepest, "node_id").select("node_id", (F.col("n") - F.size("path")).alias("depth"))


def siblings(tree: DataFrame) -> DataFrame:
    """``tree`` with left and right sibling and the place among siblings, from 0."""
    order = Window.partitionBy("parent_id").orderBy("ordinal")
    return tree.withColumns({"left_id": F.lag("node_id").over(order), "right_id": F.lead("node_id").over(order), "place": F.row_number().over(order) - 1})


def common_ancestor(a: Column, b: Column) -> Column:
    """The lowest node on both paths, null if the trees differ."""
    both = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] == p["y"])
    return F.element_at(F.transform(both, lambda p: p["x"]), -1)


def roots(paths: DataFrame) -> DataFrame:
    """(node_id, root)."""
    return paths.select("node_id", F.element_at("path", 1).alias("root"))


def daughters(tree: DataFrame, node_id: int) -> DataFrame:
    return tree.where(F.col("parent_id") == node_id).orderBy("ordinal")


def is_daughter_of(tree: DataFrame, node_id: int) -> DataFrame:
    """(node_id, is_daughter) for every node."""
    return tree.select("node_id", F.coalesce(F.col("parent_id") == node_id, F.lit(False)).alias("is_daughter"))


def subtree(paths: DataFrame, node_id: int, with_self: bool = True) -> DataFrame:
    """The nodes below one."""
    below = paths.where(F.array_contains("path", node_id))
    return below if with_self else below.where(F.col("node_id") != node_id)


def leaves_under(paths: DataFrame) -> DataFrame:
    """(node_id, leaf): the leaves below each node; a leaf is its own."""
    return leaves(paths).select(F.explode("path").alias("node_id"), F.col("node_id").alias("leaf"))


def generation(paths: DataFrame, node_id: int, under: int | None = None) -> DataFrame:
    """The nodes as deep as one, of those below ``under`` only."""
    depth = paths.where(F.col("node_id") == node_id).select(F.size("path").alias("__depth"))
    same = paths.join(F.broadcast(depth), F.size("path") == F.col("__depth"), "left_semi")
    return same if under is None else same.where(F.array_contains("path", under))


def sisters(tree: DataFrame) -> DataFrame:
    """(node_id, left_sisters, right_sisters): the earlier and later siblings in order; of a root none."""
    order = Window.partitionBy("parent_id").orderBy("ordinal")
    left = F.collect_list("node_id").over(order.rowsBetween(Window.unboundedPreceding, -1))
    right = F.collect_list("node_id").over(order.rowsBetween(1, Window.unboundedFollowing))
    none = F.array().cast("array<bigint>")
    below = F.col("parent_id").isNotNull()
    return tree.select("node_id", F.when(below, left).otherwise(none).alias("left_sisters"), F.when(below, right).otherwise(none).alias("right_sisters"))


def at_address(paths: DataFrame, address: str) -> DataFrame:
    """The node at an address (``0:i:j``); a malformed address is an error, an unused one finds nothing."""
    if not address or not all(part.isdigit() for part in address.split(":")):
        raise ValueError(f"malformed address {address!r}")
    return paths.where(F.col("address") == address)


def common_of(paths: DataFrame, proper: bool = False) -> DataFrame:
    """One row, (common): the lowest node above or at all nodes of ``paths``; ``proper`` moves up from one of them."""
    places = paths.select("node_id", F.posexplode("path").alias("depth", "above"))
    shared = places.groupBy("depth", "above").agg(F.count(F.lit(1)).alias("n"))
    total = paths.agg(F.count(F.lit(1)).alias("total"))
    on_all = shared.join(F.broadcast(total), F.col("n") == F.col("total"))
    if proper:
        on_all = on_all.join(paths.select(F.col("node_id").alias("above")), "above", "left_anti")
    return on_all.agg(F.max_by("above", "depth").alias("common"))


def _in_order(paths: DataFrame, tree: DataFrame) -> DataFrame:
    """``paths`` with ``__order``, whose order is that of a walk."""
    ordinals = tree.select(F.col("node_id").alias("__n"), F.col("ordinal").alias("__o"))
    places = paths.select("node_id", F.posexplode("path").alias("__d", "__n")).join(ordinals, "__n")
    order = places.groupBy("node_id").agg(F.sort_array(F.collect_list(F.struct("__d", "__o", "__n"))).alias("__order"))
    return paths.join(order.select("node_id", F.transform("__order", lambda x: F.struct(x["__o"], x["__n"])).alias("__order")), "node_id")


def walk(paths: DataFrame, tree: DataFrame, prune: Column | None = None) -> DataFrame:
    """``paths`` in the order of a walk (column ``step``, from 0), without what lies below nodes where ``prune`` holds."""
    if prune is not None:
        cut = paths.where(prune).select(F.col("node_id").alias("__cut"))
        above = F.slice("path", 1, F.size("path") - 1)
        hidden = paths.select("node_id", F.explode(above).alias("__cut")).join(cut, "__cut").select("node_id").distinct()
        paths = paths.join(hidden, "node_id", "left_anti")
    ordered = _in_order(paths, tree)
    # a walk numbers all nodes, so it is one sequence
    return ordered.withColumn("step", F.row_number().over(Window.orderBy("__order")) - 1).drop("__order")


def dump_names(paths: DataFrame, tree: DataFrame, indent: str = "  ") -> DataFrame:
    """(step, line): the names in walking order, indented by depth."""
    return walk(paths, tree).select("step", F.concat(F.expr(f"repeat('{indent}', size(path) - 1)"), F.coalesce("name", F.lit(""))).alias("line"))


def to_notation(paths: DataFrame, tree: DataFrame) -> DataFrame:
    """(node_id, notation) of the roots: nested JSON lists, a node's daughters before its name.

    Built from the deepest level up, one aggregation a level; a node's text holds its whole subtree.
    """
    quoted = F.to_json(F.struct(F.coalesce("name", F.lit("")).alias("n")))
    named = written(paths.join(tree.select("node_id", "ordinal"), "node_id") if "ordinal" not in paths.columns else paths)
    named = named.withColumn("q", quoted).select("node_id", "parent_id", "ordinal", F.size("path").alias("depth"), F.expr("substring(q, 6, length(q) - 6)").alias("quoted"))
    depth = named.agg(F.max("depth")).first()[0] or 0
    below = None
    for level in range(depth, 0, -1):
        here = named.where(F.col("depth") == level)
        if below is not None:
            lists = below.groupBy(F.col("parent_id").alias("node_id")).agg(F.sort_array(F.collect_list(F.struct("ordinal", "notation"))).alias("d"))
            here = here.join(lists, "node_id", "left").withColumn("inner", F.array_join(F.transform("d", lambda x: x["notation"]), ","))
        else:
            here = here.withColumn("inner", F.lit(None).cast("string"))
        notation = F.concat(F.lit("["), F.when(F.col("inner").isNotNull(), F.concat("inner", F.lit(","))).otherwise(F.lit("")), "quoted", F.lit("]"))
        below = written(here.select("node_id", "parent_id", "ordinal", notation.alias("notation")))
    return below.select("node_id", "notation") if below is not None else named.select("node_id", F.lit("").alias("notation"))


def from_notation(notation: str) -> list[tuple[int, int | None, int, str]]:
    """(node_id, parent_id, ordinal, name) of a tree in nested lists; node 0 is the root."""
    import json

    rows, todo = [], [(json.loads(notation), None, 0)]
    while todo:
        value, parent, ordinal = todo.pop()
        node = len(rows)
        *inner, name = value if isinstance(value, list) else [value]
        if isinstance(name, list):
            inner, name = [*inner, name], ""
        rows.append((node, parent, ordinal, name))
        todo.extend((child, node, k) for k, child in reversed(list(enumerate(inner))))
    return rows


def add_daughters(tree: DataFrame, paths: DataFrame, node_id: int, daughter_ids: list[int], left: bool = False) -> DataFrame:
    """``tree`` with nodes moved below another, behind its last daughter or (``left``) before its first; a node above it can't become its daughter."""
    above = paths.where(F.col("node_id") == node_id).select("path").first()
    if above is None:
        raise ValueError(f"no node {node_id}")
    if set(above.path) & set(daughter_ids):
        raise ValueError(f"{sorted(set(above.path) & set(daughter_ids))} can't be below {node_id}: they are above it")
    edge = tree.where(F.col("parent_id") == node_id).agg(F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi")).first()
    start = (edge.lo or 0) - len(daughter_ids) if left else (edge.hi if edge.hi is not None else -1) + 1
    place = F.create_map(*[F.lit(x) for k, d in enumerate(daughter_ids) for x in (d, start + k)])
    moved = F.col("node_id").isin(daughter_ids)
    return tree.withColumns({"ordinal": F.when(moved, place[F.col("node_id")]).otherwise(F.col("ordinal")).cast("bigint"), "parent_id": F.when(moved, F.lit(node_id)).otherwise(F.col("parent_id")).cast("bigint")})


def unlink(tree: DataFrame, node_id: int) -> DataFrame:
    """``tree`` with a node made a root of its own."""
    return tree.withColumn("parent_id", F.when(F.col("node_id") != node_id, F.col("parent_id")))


def replace_with_daughters(tree: DataFrame, node_id: int) -> DataFrame:
    """``tree`` without a node, its daughters in its place (at its ordinal, by theirs)."""
    me = tree.where(F.col("node_id") == node_id).select("parent_id", "ordinal").first()
    if me is None:
        raise ValueError(f"no node {node_id}")
    mine = F.col("parent_id") == node_id
    order = Window.partitionBy("parent_id").orderBy("__o", "__i")
    rest = tree.where(F.col("node_id") != node_id).withColumns({"__o": F.when(mine, F.lit(me.ordinal)).otherwise(F.col("ordinal")), "__i": F.when(mine, F.col("ordinal")).otherwise(F.lit(-1))})
    rest = rest.withColumn("parent_id", F.when(mine, F.lit(me.parent_id)).otherwise(F.col("parent_id")).cast("bigint"))
    return rest.withColumn("ordinal", (F.row_number().over(order) - 1).cast("bigint")).drop("__o", "__i")


def copy_subtree(paths: DataFrame, tree: DataFrame, node_id: int, offset: int) -> DataFrame:
    """The nodes below one and itself, as a tree of its own with ids raised by ``offset``."""
    below = tree.join(subtree(paths, node_id).select("node_id"), "node_id", "left_semi")
    parent = F.when(F.col("node_id") != node_id, F.col("parent_id") + offset)
    return below.withColumns({"parent_id": parent}).withColumn("node_id", F.col("node_id") + offset)


def delete_subtree(paths: DataFrame, tree: DataFrame, node_id: int) -> DataFrame:
    return tree.join(subtree(paths, node_id).select("node_id"), "node_id", "left_anti")


def random_tree(spark, n: int, seed: int = 0) -> DataFrame:
    """A random tree of ``n`` nodes: each but the first hangs below one of the nodes before it."""
    nodes = spark.range(n).withColumnRenamed("id", "node_id")
    parent = F.pmod(F.xxhash64("node_id", F.lit(seed)), F.col("node_id"))
    nodes = nodes.withColumn("parent_id", F.when(F.col("node_id") > 0, parent))
    order = Window.partitionBy("parent_id").orderBy("node_id")
    return nodes.select("node_id", "parent_id", (F.row_number().over(order) - 1).cast("bigint").alias("ordinal"), F.concat(F.lit("n"), F.col("node_id").cast("string")).alias("name"))


def drawn(paths: DataFrame, tree: DataFrame) -> str:
    """A small tree as text, on the driver."""
    rows = walk(paths, tree).orderBy("step").select(F.size("path").alias("depth"), "name").collect()
    return "\n".join("|  " * max(0, r.depth - 2) + ("+- " if r.depth > 1 else "") + (r.name or "") for r in rows)
