"""Queries on XML texts, ordered trees and event streams, with SQL twins."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import xml as M
from graphloom.operators import trees
from graphloom.plans.queries import TREE_SQL, query, table, tree
from graphloom.streaming import stages

C = F.col


def nested(spark: SparkSession, d: str) -> DataFrame:
    """(id, xml) of each region: its nations by key, in each its suppliers by key."""
    supplier = table(spark, d, "supplier").groupBy(C("s_nationkey").alias("k")).agg(F.array_sort(F.collect_list("s_suppkey")).alias("s"))
    nation = table(spark, d, "nation").join(supplier, C("k") == C("n_nationkey"), "left")
    inner = F.array_join(F.transform(F.coalesce("s", F.array().cast("array<bigint>")), lambda s: F.concat(F.lit('<s id="'), s.cast("string"), F.lit('"/>'))), "")
    nation = nation.withColumn("x", F.concat(F.lit('<n id="'), C("n_nationkey").cast("string"), F.lit('" name="'), "n_name", F.lit('">'), inner, F.lit("</n>")))
    listed = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "x"))).alias("n"))
    return listed.select(C("n_regionkey").alias("id"), F.concat(F.lit("<r>"), F.array_join(F.transform("n", lambda n: n["x"]), ""), F.lit("</r>")).alias("xml"))


_NEST = """s AS (SELECT n_regionkey AS r, n_nationkey AS n, count(s_suppkey) AS k FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2),
  g AS (SELECT r AS id, count(*)::INT AS n, sum(k)::INT AS s, count(*) FILTER (k > 0)::INT AS busy, arg_min(k, n)::INT AS first, arg_max(k, n)::INT AS last FROM s GROUP BY 1)"""
AXES = {
    "ax_child": ("count(r/child::n)", "n"), "ax_descendant": ("count(r/descendant::s)", "s"), "ax_descendant_or_self": ("count(r/descendant-or-self::*)", "1 + n + s"),
    "ax_parent": ("count(//s/parent::n)", "busy"), "ax_ancestor": ("count(//s/ancestor::*)", "CASE WHEN busy > 0 THEN busy + 1 ELSE 0 END"),
    "ax_ancestor_or_self": ("count(//s/ancestor-or-self::*)", "CASE WHEN busy > 0 THEN busy + 1 ELSE 0 END + s"), "ax_self": ("count(r/n/self::n)", "n"), "ax_attribute": ("count(//n/attribute::id)", "n"),
    "ax_following_sibling": ("count(r/n[1]/following-sibling::n)", "n - 1"), "ax_preceding_sibling": ("count(r/n[last()]/preceding-sibling::*)", "n - 1"),
    "ax_following": ("count(r/n[1]/following::s)", "s - first"), "ax_preceding": ("count(r/n[last()]/preceding::s)", "s - last"), "ax_any": ("count(//n/@*)", "2 * n"),
    "ax_union": ("count(//n | //s | r/n[1])", "n + s"), "ax_dots": ("count(//n/../n/.)", "n"), "ax_node": ("count(r/node())", "n"),
}


@query("xpath_axes", f"WITH {_NEST} SELECT id, " + ", ".join(f"({sql})::DOUBLE AS {name}" for name, (_, sql) in AXES.items()) + " FROM g")
def xpath_axes(spark, d):
    return nested(spark, d).select("id", *[M.find_number(C("xml"), path).alias(name) for name, (path, _) in AXES.items()])


STRINGS = {
    "f_string": ("string(n/@name)", "n_name"), "f_concat": ("concat(n/@name, '-', n/@id)", "n_name || '-' || n_nationkey"), "f_before": ("substring-before(n/@name, 'A')", "CASE WHEN contains(n_name, 'A') THEN split_part(n_name, 'A', 1) ELSE '' END"),
    "f_after": ("substring-after(n/@name, 'A')", "CASE WHEN contains(n_name, 'A') THEN substr(n_name, strpos(n_name, 'A') + 1) ELSE '' END"), "f_substring": ("substring(n/@name, 2, 3)", "substr(n_name, 2, 3)"),
    "f_space": ("normalize-space(concat('  ', n/@name, '   x '))", "n_name || ' x'"), "f_translate": ("translate(n/@name, 'AEI', 'ae')", "translate(n_name, 'AEI', 'ae')"), "f_name": ("name(n/@*[1])", "'id'"),
}
NUMBERS = {
    "f_length": ("string-length(n/@name)", "length(n_name)"), "f_plus": ("n/@id + 2", "n_nationkey + 2"), "f_minus": ("n/@id - 2", "n_nationkey - 2"), "f_times": ("n/@id * 3", "n_nationkey * 3"), "f_div": ("n/@id div 2", "n_nationkey / 2"),
    "f_mod": ("n/@id mod 7", "n_nationkey % 7"), "f_negative": ("-(n/@id + 1)", "-(n_nationkey + 1)"), "f_floor": ("floor(n/@id div 2)", "floor(n_nationkey / 2)"), "f_ceiling": ("ceiling(n/@id div 2)", "ceil(n_nationkey / 2)"), "f_number": ("number(n/@id)", "n_nationkey"),
}
TESTS = {
    "f_starts": ("starts-with(n/@name, 'A')", "starts_with(n_name, 'A')"), "f_contains": ("contains(n/@name, 'IA')", "contains(n_name, 'IA')"), "f_boolean": ("boolean(n/@id)", "true"), "f_not": ("not(n/@id = 3)", "n_nationkey <> 3"),
    "f_true": ("true()", "true"), "f_false": ("false()", "false"), "f_or": ("n/@id = 3 or n/@id = 4", "n_nationkey IN (3, 4)"), "f_and": ("n/@id > 3 and n/@id < 9", "n_nationkey > 3 AND n_nationkey < 9"), "f_le": ("n/@id <= 5", "n_nationkey <= 5"),
    "f_ge": ("n/@id >= 5", "n_nationkey >= 5"), "f_ne": ("n/@id != 5", "n_nationkey <> 5"), "f_position": ("n[position() = 1]/@id = 5", "n_nationkey = 5"),
}


@query("xpath_functions", "SELECT n_nationkey AS id, " + ", ".join([f"{sql} AS {k}" for k, (_, sql) in STRINGS.items()] + [f"({sql})::DOUBLE AS {k}" for k, (_, sql) in NUMBERS.items()] + [f"({sql}) AS {k}" for k, (_, sql) in TESTS.items()]) + " FROM nation")
def xpath_functions(spark, d):
    xml = F.concat(F.lit('<n id="'), C("n_nationkey").cast("string"), F.lit('" name="'), "n_name", F.lit('"/>'))
    rows = table(spark, d, "nation").select(C("n_nationkey").alias("id"), xml.alias("xml"))
    x = C("xml")
    return rows.select("id", *[M.find_value(x, p).alias(k) for k, (p, _) in STRINGS.items()], *[M.find_number(x, p).alias(k) for k, (p, _) in NUMBERS.items()], *[M.exists(x, p).alias(k) for k, (p, _) in TESTS.items()])


@query(
    "xpath_matches",
    """SELECT n_regionkey AS id, bool_or(regexp_matches(n_name, '^[A-C].*A$')) AS has, string_agg(n_nationkey::VARCHAR, '+' ORDER BY n_nationkey) AS ids, string_agg(n_name, '' ORDER BY n_nationkey) FILTER (n_nationkey > 9) AS late FROM nation GROUP BY 1""",
)
def xpath_matches(spark, d):
    x = C("xml")
    late = M.nodes_as_string(x, M.with_variables("r/n[@id > $least]/@name", {"least": 9}))
    return nested(spark, d).select("id", M.matches(x, "r/n/@name", "^[A-C].*A$").alias("has"), M.nodes_as_string(x, "r/n/@id", "+").alias("ids"), F.nullif(late, F.lit("")).alias("late"))


@query("xpath_round", "SELECT n_nationkey AS id, floor(n_nationkey / 2 - 5 + 0.5)::BIGINT AS r FROM nation")
def xpath_round(spark, d):
    return table(spark, d, "nation").select(C("n_nationkey").alias("id"), M.rounded(C("n_nationkey") / 2 - 5).alias("r"))


@query("json_to_xml", "SELECT n_nationkey AS id, n_name AS name, n_regionkey::DOUBLE AS region, 1.0::DOUBLE AS roots FROM nation")
def json_to_xml(spark, d):
    json = F.to_json(F.struct(F.struct(C("n_regionkey").alias("@region"), C("n_name").alias("$t")).alias("n")))
    xml = M.from_json(json, "n struct<`@region`:int,`$t`:string>", "r")
    rows = table(spark, d, "nation").select(C("n_nationkey").alias("id"), xml.alias("xml"))
    return rows.select("id", M.find_value(C("xml"), "r/n").alias("name"), M.find_number(C("xml"), "r/n/@region").alias("region"), M.find_number(C("xml"), "count(/*)").alias("roots"))


@query("json_sanitized", """SELECT n_nationkey AS id, '{"@id":' || n_nationkey || ',"b":"' || n_name || '"}' AS json FROM nation""")
def json_sanitized(spark, d):
    key = C("n_nationkey").cast("string")
    xml = F.concat(F.lit('<n id="'), key, F.lit('" _x="1"><_a>secret</_a><b>'), "n_name", F.lit("</b></n>"))
    return table(spark, d, "nation").select(C("n_nationkey").alias("id"), M.to_json(xml, "`@id` int, `@_x` int, _a string, b string", sanitize=True).alias("json"))


# trees


def _paths(spark, d):
    return trees.with_paths(tree(spark, d))


@query("tree_roots", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, path[1] AS root FROM paths")
def tree_roots(spark, d):
    return trees.roots(_paths(spark, d))


@query("tree_subtree", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, name FROM paths WHERE list_contains(path, 103)")
def tree_subtree(spark, d):
    return trees.subtree(_paths(spark, d), 103).select("node_id", "name")


@query("tree_leaves_under", f"WITH RECURSIVE {TREE_SQL} SELECT unnest(path) AS node_id, node_id AS leaf FROM paths WHERE node_id NOT IN (SELECT parent_id FROM tree WHERE parent_id IS NOT NULL)")
def tree_leaves_under(spark, d):
    return trees.leaves_under(_paths(spark, d))


@query("tree_generation", f"WITH RECURSIVE {TREE_SQL} SELECT node_id FROM paths WHERE len(path) = 2 AND path[1] = (SELECT path[1] FROM paths WHERE node_id = 103)")
def tree_generation(spark, d):
    paths = _paths(spark, d)
    root = paths.where("node_id = 103").first().path[0]
    return trees.generation(paths, 103, under=root).select("node_id")


@query("tree_daughter", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, coalesce(parent_id = 103, false) AS is_daughter FROM tree")
def tree_daughter(spark, d):
    return trees.is_daughter_of(tree(spark, d), 103)


@query(
    "tree_sisters",
    f"""WITH RECURSIVE {TREE_SQL} SELECT t.node_id, (SELECT count(*) FROM tree o WHERE o.parent_id = t.parent_id AND o.ordinal < t.ordinal) AS n_left,
        (SELECT min(o.node_id) FROM tree o WHERE o.parent_id = t.parent_id AND o.ordinal > t.ordinal) AS next_id FROM tree t""",
)
def tree_sisters(spark, d):
    found = trees.sisters(tree(spark, d))
    return found.select("node_id", F.size("left_sisters").cast("bigint").alias("n_left"), F.get("right_sisters", F.lit(0)).alias("next_id"))


@query("tree_at_address", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, name FROM paths WHERE address = '0:3'")
def tree_at_address(spark, d):
    return trees.at_address(_paths(spark, d), "0:3").select("node_id", "name")


@query("tree_common_of", f"WITH RECURSIVE {TREE_SQL} SELECT path[len(path) - 1] AS common FROM paths WHERE node_id = (SELECT min(node_id) FROM tree WHERE node_id >= 1000)")
def tree_common_of(spark, d):
    paths = _paths(spark, d)
    parent = paths.where("node_id >= 1000").orderBy("node_id").first().parent_id
    return trees.common_of(trees.subtree(paths, parent), proper=False)


@query("tree_dump_names", f"WITH RECURSIVE {TREE_SQL}, o AS (SELECT *, list_transform(path, lambda x: lpad(x::VARCHAR, 8, '0')) AS k FROM paths) SELECT (row_number() OVER (ORDER BY k) - 1)::INT AS step, repeat('  ', len(path) - 1) || name AS line FROM o")
def tree_dump_names(spark, d):
    return trees.dump_names(_paths(spark, d), tree(spark, d))


@query("tree_walk_pruned", f"WITH RECURSIVE {TREE_SQL} SELECT node_id FROM paths WHERE NOT (list_contains(path, 103) AND node_id <> 103)")
def tree_walk_pruned(spark, d):
    return trees.walk(_paths(spark, d), tree(spark, d), prune=F.col("node_id") == 103).select("node_id")


@query(
    "tree_notation",
    f"""WITH RECURSIVE {TREE_SQL}, leaf AS (SELECT parent_id, string_agg('["' || name || '"]', ',' ORDER BY ordinal) AS x FROM tree WHERE node_id >= 1000 GROUP BY 1),
        mid AS (SELECT t.parent_id, string_agg('[' || coalesce(x || ',', '') || '"' || name || '"]', ',' ORDER BY ordinal) AS x FROM tree t LEFT JOIN leaf l ON l.parent_id = t.node_id WHERE t.node_id BETWEEN 100 AND 999 GROUP BY 1)
        SELECT t.node_id, '[' || coalesce(x || ',', '') || '"' || name || '"]' AS notation FROM tree t LEFT JOIN mid m ON m.parent_id = t.node_id WHERE t.parent_id IS NULL""",
)
def tree_notation(spark, d):
    return trees.to_notation(_paths(spark, d), tree(spark, d))


@query("tree_pruned", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, parent_id FROM paths WHERE NOT list_contains(path, 103)")
def tree_pruned(spark, d):
    return trees.delete_subtree(_paths(spark, d), tree(spark, d), 103).select("node_id", "parent_id")


@query("tree_copied", f"WITH RECURSIVE {TREE_SQL} SELECT node_id + 50000 AS node_id, CASE WHEN node_id <> 103 THEN parent_id + 50000 END AS parent_id, name FROM paths WHERE list_contains(path, 103)")
def tree_copied(spark, d):
    return trees.copy_subtree(_paths(spark, d), tree(spark, d), 103, 50000).select("node_id", "parent_id", "name")


@query("tree_moved", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, CASE WHEN node_id IN (1001, 1002) THEN 103 ELSE parent_id END AS parent_id FROM tree")
def tree_moved(spark, d):
    t = tree(spark, d)
    return trees.add_daughters(t, trees.with_paths(t), 103, [1001, 1002]).select("node_id", "parent_id")


@query("tree_spliced", f"WITH RECURSIVE {TREE_SQL} SELECT node_id, CASE WHEN parent_id = 103 THEN (SELECT parent_id FROM tree WHERE node_id = 103) ELSE parent_id END AS parent_id FROM tree WHERE node_id <> 103")
def tree_spliced(spark, d):
    return trees.replace_with_daughters(tree(spark, d), 103).select("node_id", "parent_id")


# streams: a table read as a stream to its end gives the same as at once


def _streamed(frame: DataFrame, spark: SparkSession, name: str, mode: str) -> DataFrame:
    """The rows of a stream after all that its source holds; what a stream only adds goes to files, and not through the driver."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="graphloom-stream-")
    folder = f"{shared}/{name}-{uuid4().hex}"
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", f"{folder}/rows").start().awaitTermination()
        return spark.read.schema(frame.schema).parquet(f"{folder}/rows")
    writer.format("memory").queryName(name).start().awaitTermination()
    return spark.table(name)


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream; event time is a point in time there."""
    rows = spark.readStream.schema(table(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_counts", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_counts(spark, d):
    found = _streamed(stages.windowed_counts(_events(spark, d), "event_type"), spark, "stream_counts", "complete")
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_links", "SELECT event_id, event_type AS markup FROM events")
def stream_links(spark, d):
    texts = _events(spark, d).select("event_id", "ts", F.concat(F.lit("to [["), "event_type", F.lit("]] now")).alias("text"))
    return _streamed(stages.link_stream(texts, "event_id"), spark, "stream_links", "append")
