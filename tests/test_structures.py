"""Trees that change, trees as text, and XML helpers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions import text as X
from graphloom.functions import xml as M
from graphloom.operators import trees


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def tree(spark):
    return spark.createDataFrame([(1, None, 0, "r"), (2, 1, 0, "a"), (3, 1, 1, "b"), (4, 2, 0, 'c"'), (5, 2, 1, None)], "node_id long, parent_id long, ordinal long, name string")


def test_notation_both_ways(tree):
    paths = trees.with_paths(tree)
    notation = trees.to_notation(paths, tree).first().notation
    assert notation == '[[["c\\""],[""],"a"],["b"],"r"]'
    assert [(p, o, n) for _, p, o, n in trees.from_notation(notation)] == [(None, 0, "r"), (0, 0, "a"), (1, 0, 'c"'), (1, 1, ""), (0, 1, "b")]
    assert trees.drawn(paths, tree) == 'r\n+- a\n|  +- c"\n|  +- \n+- b'


def test_loops_are_errors(spark, tree):
    loop = spark.createDataFrame([(1, None, 0, "r"), (2, 3, 0, "a"), (3, 2, 0, "b"), (4, 3, 0, "c")], tree.schema)
    with pytest.raises(ValueError, match="own ancestor"):
        trees.with_paths(loop)
    loose = spark.createDataFrame([(1, None, 0, "r"), (2, 9, 0, "a"), (3, 2, 0, "b")], tree.schema)
    assert rows(trees.with_paths(loose).select("node_id")) == [(1,)]
    assert trees.with_paths(tree.limit(0)).count() == 0
    with pytest.raises(ValueError, match="above it"):
        trees.add_daughters(tree, trees.with_paths(tree), 4, [2])


def test_changes(tree):
    paths = trees.with_paths(tree)
    moved = trees.add_daughters(tree, paths, 2, [3], left=True)
    assert rows(trees.with_paths(moved).select("node_id", "address"))[2] == (3, "0:0:-1")
    assert rows(trees.unlink(tree, 2).where("parent_id IS NULL").select("node_id")) == [(1,), (2,)]
    assert rows(trees.replace_with_daughters(tree, 2).select("node_id", "parent_id", "ordinal")) == [(1, None, 0), (3, 1, 2), (4, 1, 0), (5, 1, 1)]
    assert rows(trees.delete_subtree(paths, tree, 2).select("node_id")) == [(1,), (3,)]
    assert rows(trees.daughters(tree, 1).select("node_id")) == [(2,), (3,)]
    assert trees.common_of(paths.where("node_id IN (2, 4)")).first().common == 2
    assert trees.common_of(paths.where("node_id IN (2, 4)"), proper=True).first().common == 1
    with pytest.raises(ValueError, match="malformed"):
        trees.at_address(paths, "0:x")


def test_random_tree(spark):
    t = trees.random_tree(spark, 200, seed=3)
    assert trees.with_paths(t).count() == 200 and rows(t) == rows(trees.random_tree(spark, 200, seed=3)) != rows(trees.random_tree(spark, 200, seed=4))


def test_xml(spark):
    assert M.with_variables("a[@x = $v and $vv]", {"v": "it's", "vv": 2}) == "a[@x = \"it's\" and 2]"
    schema = T._parse_datatype_string("`@_x` int, a struct<_b: int, c: int>, _d array<int>")
    assert M.public(schema).simpleString() == "struct<a:struct<c:int>>"
    df = spark.createDataFrame([("<r><n>1</n><n>2</n></r>",), (None,)], "x string")
    assert [r[0] for r in df.select(M.nodes_as_string(F.col("x"), "r/n/text()", ",")).collect()] == ["1,2", None]


def test_small_text_functions(spark):
    df = spark.createDataFrame([(512, "a [[b|c]] d\n\n[[c]] x\n\n[[e]]"), (1536, "p"), (5 << 30, None)], "n long, t string")
    assert [r[0] for r in df.select(X.pretty_bytes(F.col("n"))).collect()] == ["512 B", "1.50 KiB", "5.00 GiB"]
    assert [r[0] for r in df.select(X.without_anchor_paragraphs(F.col("t"), "c")).collect()] == ["[[e]]", "p", None]
    assert df.select(X.namespace_uri(F.lit("http://x.y/wiki/Main_Page"), "Category")).first()[0] == "http://x.y/wiki/Category"


def test_appended_rows_bypass_the_driver(spark):
    from graphloom.plans.queries import QUERIES

    found = QUERIES["stream_links"](spark, "/root/testdata/sf0.001")
    assert found.count() == 1000 and found.inputFiles()  # files, no table in the driver's memory
