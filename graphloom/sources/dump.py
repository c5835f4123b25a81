"""Sources: page dumps in XML, MySQL dumps, text relations."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CONTRIBUTOR = "contributor struct<username:string,id:bigint,ip:string>"
PAGE_SCHEMA = (
    "title string, ns int, id bigint, redirect struct<_title:string>, "
    f"revision array<struct<id:bigint,timestamp:string,comment:string,minor:string,{_CONTRIBUTOR.replace(' ', ':', 1)},text:struct<_VALUE:string>>>"
)


def read_pages(spark: SparkSession, path: str, fast: bool = False) -> DataFrame:
    """Pages of a dump (plain, gz or bz2); ``fast`` reads titles and the texts of first revisions only. Malformed XML is an error."""
    schema = "title string, revision array<struct<text:struct<_VALUE:string>>>" if fast else PAGE_SCHEMA
    pages = spark.read.format("xml").option("rowTag", "page").option("mode", "FAILFAST").schema(schema).load(path)
    if fast:
        return pages.select("title", F.element_at("revision", 1)["text"]["_VALUE"].alias("text"))
    return pages.withColumn("position", F.monotonically_increasing_id())


def latest(pages: DataFrame) -> DataFrame:
    """(id, title, redirect, text, timestamp, contributor, minor, position): the last revision of each page."""
    last = F.element_at("revision", -1)
    who = last["contributor"]
    return pages.select(
        "id", "title", F.col("redirect._title").alias("redirect"), F.coalesce(last["text"]["_VALUE"], F.lit("")).alias("text"),
        F.to_timestamp(last["timestamp"]).alias("timestamp"), F.coalesce(who["ip"], who["username"]).alias("contributor"), last["minor"].isNotNull().alias("minor"), "position",
    )


def revisions(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("id").alias("page_id"), "title", F.explode("revision").alias("r")).select("page_id", "title", "r.*")


def read_namespaces(spark: SparkSession, path: str) -> dict[str, int]:
    """Lower-cased namespace names and their keys, from the dump's header (a few dozen rows)."""
    rows = spark.read.format("xml").option("rowTag", "namespace").schema("_key int, _VALUE string").load(path)
    return {r._VALUE.strip().lower(): r._key for r in rows.where("_VALUE IS NOT NULL").distinct().collect() if r._VALUE.strip()}


def category_name(namespaces: dict[str, int]) -> str | None:
    """The lower-cased name of the category namespace."""
    return next((name for name, key in namespaces.items() if key == 14), None)


def namespaces_by_id(namespaces: dict[str, int]) -> list[tuple[int, str]]:
    return sorted((key, name) for name, key in namespaces.items())


def read_siteinfo(spark: SparkSession, path: str) -> DataFrame:
    """(sitename, base, generator, case, namespaces: a map from key to name) of a dump's header."""
    schema = "sitename string, base string, generator string, case string, namespaces struct<namespace:array<struct<_key:int,_VALUE:string>>>"
    found = spark.read.format("xml").option("rowTag", "siteinfo").schema(schema).load(path)
    entries = F.transform(F.coalesce("namespaces.namespace", F.array()), lambda n: F.struct(n["_key"], F.coalesce(n["_VALUE"], F.lit(""))))
    return found.select("sitename", "base", "generator", "case", F.map_from_entries(entries).alias("namespaces"))


#: fixed value: the newest version of the dump format that was tested
TESTED_VERSION = "0.10"


def version_key(version: Column) -> Column:
    """Dump versions compare component by component as numbers."""
    return F.transform(F.split(version, r"\."), lambda x: x.cast("int"))


def compare_versions(a: str, b: str) -> int:
    """-1, 0 or 1; a missing component counts as 0."""
    x, y = ([int(n) for n in v.split(".")] for v in (a, b))
    x, y = x + [0] * (len(y) - len(x)), y + [0] * (len(x) - len(y))
    return (x > y) - (x < y)


def check_version(spark: SparkSession, path: str, newest: str = TESTED_VERSION) -> str:
    """The version of a dump; a newer one than ``newest`` is an error.  Readers don't call it on their own."""
    head = spark.read.text(path).where(F.col("value").rlike("<mediawiki[^>]*version="))
    found = head.select(F.regexp_extract("value", '<mediawiki[^>]*version="([0-9.]+)"', 1).alias("v")).first()
    if found is None:
        raise ValueError("no version in the dump's header")
    if compare_versions(found.v, newest) > 0:
        raise ValueError(f"dump version {found.v} is newer than {newest}")
    return found.v


def compat_pages(pages: DataFrame, namespaces: dict[str, int]) -> DataFrame:
    """One row a page with namespace, redirect target, categories and editor; a page with several revisions is an error."""
    from graphloom.functions import languages
    from graphloom.functions import text as X

    several = F.raise_error(F.concat(F.lit("several revisions: "), "title")).cast("string")
    one = pages.withColumn("title", F.when(F.size("revision") > 1, several).otherwise(F.col("title")))
    last = latest(one)
    ns = X.title_namespace(F.col("title"), namespaces)
    named = F.regexp_extract_all("text", F.lit(r"(?i)\[\[\s*category\s*:\s*([^\]|]+)"), F.lit(1))
    return last.select("*", ns["ns"].alias("namespace"), F.coalesce("redirect", languages.redirect_markup(F.col("text"))).alias("redirect_to"), F.transform(named, lambda c: F.trim(c)).alias("categories"))


def compat_links(rows: DataFrame) -> DataFrame:
    """(from_id, namespace, to) of a dump of page links: its first three columns."""
    a, b, c = rows.columns[:3]
    return rows.select(F.col(a).alias("from_id"), F.col(b).alias("namespace"), F.col(c).alias("to"))


def read_elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """A row for each element ``tag`` at any depth: attributes as ``_name``, text as ``_VALUE``, children by name.

    ``schema`` picks what is kept, so a short form without children costs no more than it shows.
    """
    return spark.read.format("xml").option("rowTag", tag).option("mode", "FAILFAST").option("ignoreSurroundingSpaces", True).schema(schema).load(path)


def _fields(spark: SparkSession, path: str, pattern: str, fields: dict[str, str], strict: bool) -> DataFrame:
    lines = spark.read.text(path)
    if strict:
        bad = F.raise_error(F.concat(F.lit("malformed row: "), "value"))
        lines = lines.select(F.when(F.col("value").rlike(pattern), F.col("value")).otherwise(bad.cast("string")).alias("value"))
    else:
        lines = lines.where(F.col("value").rlike(pattern))
    return lines.select(*[F.regexp_extract("value", pattern, k).cast(kind).alias(name) for k, (name, kind) in enumerate(fields.items(), 1)])


def read_page_relation(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``id,"title",type``; titles may hold commas and quotes."""
    return _fields(spark, path, r'^(\d+),"(.+)",(\d+)$', {"id": "bigint", "title": "string", "type": "int"}, strict)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``from,to`` and anything behind."""
    return _fields(spark, path, r"^(\d+),(\d+)", {"from_id": "bigint", "to_id": "bigint"}, True)


def read_anchors(spark: SparkSession, path: str) -> DataFrame:
    return _fields(spark, path, r'^"?(.*?)"?,(\d+),(\d+)$', {"anchor": "string", "target_id": "bigint", "freq": "bigint"}, True)


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", ",")
    return spark.read.text(path).select(parts[0].cast("bigint").alias("id"), F.slice(parts, 2, 1 << 30).cast("array<bigint>").alias("arts"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """(u, v) of lines that hold ``u:`` and ``v:`` in either order; a line without one of them is an error."""
    ends = [F.regexp_extract("value", rf"\b{k}:(\S+)", 1) for k in "uv"]
    bad = F.raise_error(F.concat(F.lit("malformed row: "), "value")).cast("string")
    return spark.read.text(path).select(*[F.when((ends[0] != "") & (ends[1] != ""), end).otherwise(bad).alias(k) for k, end in zip("uv", ends, strict=True)])


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """(id, text) of ``id,"text"`` lines, escapes undone."""
    from graphloom.functions.text import unescape_text

    found = _fields(spark, path, r'^(\d+),"(.+?)"$', {"id": "bigint", "text": "string"}, False)
    return found.withColumn("text", unescape_text(F.col("text")))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(text): plain text, one text a line."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_langlinks(spark: SparkSession, path: str) -> DataFrame:
    """(id, lang, title) of a dump of language links; of two rows for a page and language the later one counts (in the order read)."""
    rows = read_mysql_dump(spark, path, "langlinks")
    id_, lang, title = rows.columns[:3]
    return rows.select(F.col(id_).alias("id"), F.col(lang).alias("lang"), F.col(title).alias("title"))


def find_dump(spark: SparkSession, folder: str) -> str:
    """The one dump of pages in a folder of any store that Spark reads; none or several are an error."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(s.getPath()) for s in fs.listStatus(path) if "pages-articles.xml" in s.getPath().getName().lower()]
    if len(found) != 1:
        raise ValueError(f"{folder} holds {len(found)} dumps of pages")
    return found[0]


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(headword, entity, weight) of ``headword entity:weight ...`` lines."""
    from graphloom.functions.text import parse_page_freq

    words = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(words[0].alias("headword"), F.explode(F.slice(words, 2, 1 << 30)).alias("e")).select("headword", parse_page_freq(F.col("e")).alias("p"))
    return rows.select("headword", F.col("p.page").alias("entity"), F.col("p.freq").cast("bigint").alias("weight"))


_VALUE = re.compile(r"\s*(?:'((?:[^'\\]|\\.|'')*)'|([^,()']+))\s*([,)])", re.S)
_ESCAPE = re.compile(r"\\(.)|''", re.S)
_SPECIAL = {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}
# fixed values: column types of the dump format by the Spark type that holds them
_MYSQL_TYPES = {
    "bigint": "int tinyint smallint mediumint bigint timestamp year", "double": "double float decimal",
    "string": "char varchar enum set blob tinyblob mediumblob longblob text tinytext mediumtext longtext binary varbinary date datetime",
}
_TYPE_OF = {name: kind for kind, names in _MYSQL_TYPES.items() for name in names.split()}


def parse_rows(statement: str) -> list[list[str | None]]:
    """The tuples of an INSERT statement, escapes decoded, NULL as None."""
    at, rows = statement.find("VALUES"), []
    at = statement.find("(", at)
    while at >= 0:
        row, at = [], at + 1
        while m := _VALUE.match(statement, at):
            quoted, bare = m[1], m[2]
            row.append(_ESCAPE.sub(lambda e: "'" if e[1] is None else _SPECIAL.get(e[1], e[1]), quoted) if quoted is not None else None if bare.strip() == "NULL" else bare.strip())
            at = m.end()
            if m[3] == ")":
                break
        else:
            raise ValueError(f"malformed tuple near {statement[at : at + 40]!r}")
        rows.append(row)
        at = statement.find("(", at)
    return rows


def mysql_schema(statement: str) -> T.StructType:
    """Columns of a CREATE TABLE statement."""
    fields = []
    for line in statement.splitlines():
        if m := re.match(r"\s*`(\w+)` (\w+)", line):
            if m[2].lower() not in _TYPE_OF:
                raise ValueError(f"unknown column type {m[2]}")
            fields.append(T.StructField(m[1], {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}[_TYPE_OF[m[2].lower()]]))
    return T.StructType(fields)


_CREATE = r"(?m)^CREATE TABLE `(\w+)`"


def mysql_tables(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, CREATE statement) of the tables of a MySQL dump, in the order of the file (a few rows)."""
    statements = spark.read.option("lineSep", ";\n").text(path)
    if statements.where(F.col("value").rlike(r"\A\s*-- MySQL dump")).isEmpty():
        raise ValueError("not a MySQL dump")
    found = statements.select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    rows = found.where(F.col("value").rlike(_CREATE)).orderBy("block", "n").select(F.regexp_extract("value", _CREATE, 1).alias("name"), "value").collect()
    return [(r.name, r.value[r.value.index("CREATE TABLE") :]) for r in rows]


def read_mysql_dump(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """One table of a MySQL dump (the first, unless named), typed by its DDL wherever that stands; a dump without it is an error."""
    tables = mysql_tables(spark, path)
    chosen = next(((name, ddl) for name, ddl in tables if table in (None, name)), None)
    if chosen is None:
        raise ValueError(f"no CREATE TABLE of {table or 'any table'}")
    name, schema = chosen[0], mysql_schema(chosen[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for statement in batch.column("value").to_pylist():
                rows = parse_rows(statement)
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(len(schema))], names=schema.names)

    statements = spark.read.option("lineSep", ";\n").text(path)
    own = statements.where(F.col("value").rlike(rf"(?m)^INSERT INTO `{name}`"))
    raw = own.mapInArrow(run, T.StructType([T.StructField(n, T.StringType()) for n in schema.names]))
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
