"""From the pages of a dump to its relations: types, redirects, links, categories, anchors, disambiguations.

Everything is a projection of the pages, a join with the title index, or a
sum; no step holds the titles or redirects of a dump on one machine.  Popular
titles make skewed joins, which adaptive execution splits.
"""

from __future__ import annotations

from functools import cached_property
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.functions import languages
from graphloom.functions import text as X
from graphloom.functions.wikitext import extract_infobox_links, extract_links, strip_templates
from graphloom.operators import relations
from graphloom.operators.relations import written
from graphloom.sources import sinks

#: Keys of the namespaces that count: articles and categories.
ARTICLES, CATEGORIES = 0, 14


class Relations:
    """The relations of one dump, each made when it is first asked for, with what it needs only.

    ``rejects`` (kind, id, title, target, ns) has the links that lead nowhere.
    """

    #: columns that are quoted in the text form of a relation
    QUOTED = {"page": ("title",), "translation": ("lang", "title"), "disambiguation": ("scope",), "anchor": ("anchor",)}

    def __init__(self, pages: DataFrame, namespaces: dict[str, int], lang: str = "en") -> None:
        self._pages, self._namespaces, self._lang = pages, namespaces, lang
        self._category = next((name for name, key in namespaces.items() if key == CATEGORIES), "category")

    @cached_property
    def _base(self) -> DataFrame:
        return written(summary(self._pages, self._namespaces, self._lang))

    @cached_property
    def page(self) -> DataFrame:
        return self._base.select("id", "title", "type")

    @cached_property
    def stats(self) -> DataFrame:
        return relations.page_stats(self.page)

    @cached_property
    def _redirects(self) -> tuple[DataFrame, DataFrame]:
        own = self._base.where(X.truthy(F.col("redirect"))).withColumn("link", parsed(F.col("redirect"), self._namespaces))
        own = own.where(F.col("link.ns").isin(ARTICLES, CATEGORIES)).select("id", F.col("title").alias("page_title"), F.col("link.ns").alias("ns"), F.col("link.title").alias("target_title"))
        return _split(_lookup(own, title_keys(self._base)), "redirect")

    @cached_property
    def redirect(self) -> DataFrame:
        return written(self._redirects[0].select(F.col("id").alias("from_id"), F.col("target").alias("to_id")))

    @cached_property
    def _final(self) -> DataFrame:
        return written(relations.resolve_redirects(self.redirect))

    @cached_property
    def _index(self) -> DataFrame:
        """Links resolve to what a title's page redirects to in the end."""
        ends = self._final.select(F.col("from_id").alias("target"), F.col("final_id"))
        return written(title_keys(self._base).join(ends, "target", "left").select("ns", "key", F.coalesce("final_id", "target").alias("target")))

    @cached_property
    def equivalence(self) -> DataFrame:
        same = self._base.where(F.col("ns") == CATEGORIES).select("id", F.col("title").alias("page_title"), F.lit(ARTICLES).alias("ns"), X.clean_title(F.col("title")).alias("target_title"))
        return _split(_lookup(same, self._index), "equivalence")[0].select(F.col("id").alias("category_id"), F.col("target").alias("article_id"))

    @cached_property
    def _links(self) -> DataFrame:
        stripped = self._base.withColumn("stripped", strip_templates("text")).where(X.truthy(F.col("stripped")))
        links = stripped.select("id", F.col("title").alias("page_title"), F.explode(extract_links("stripped")).alias("markup")).withColumn("link", parsed(F.col("markup"), self._namespaces))
        links = links.where(X.truthy(F.col("link.anchor")) & X.truthy(F.col("link.title")))
        return written(links.select("id", "page_title", "link.lang", "link.ns", F.col("link.title").alias("target_title"), "link.anchor"))

    @cached_property
    def translation(self) -> DataFrame:
        return self._links.where("lang IS NOT NULL").select("id", "lang", F.col("target_title").alias("title"))

    @cached_property
    def _articles(self) -> tuple[DataFrame, DataFrame]:
        found, lost = _split(written(_lookup(self._links.where("lang IS NULL").where(F.col("ns") == ARTICLES), self._index)), "pagelink")
        return found, lost

    @cached_property
    def pagelink(self) -> DataFrame:
        return self._articles[0].select(F.col("id").alias("from_id"), F.col("target").alias("to_id"))

    @cached_property
    def _parents(self) -> tuple[DataFrame, DataFrame]:
        return _split(_lookup(self._links.where("lang IS NULL").where(F.col("ns") == CATEGORIES), self._index), "categorylink")

    @cached_property
    def categorylink(self) -> DataFrame:
        return self._parents[0].select(F.col("target").alias("parent_id"), F.col("id").alias("child_id"))

    @cached_property
    def anchor(self) -> DataFrame:
        used = self._articles[0].groupBy("anchor", F.col("target").alias("target_id")).agg(F.count(F.lit(1)).alias("freq"))
        titles = self.page.where("type IN (1, 3)").join(self._final.select(F.col("from_id").alias("id"), "final_id"), "id", "left")
        titles = titles.select(F.col("title").alias("anchor"), F.when(F.col("type") == 1, F.col("id")).otherwise(F.coalesce("final_id", "id")).alias("target_id")).distinct()
        return relations.seed_anchors(used, titles).select(X.clean_text(F.col("anchor")).alias("anchor"), "target_id", "freq")

    @cached_property
    def _listed(self) -> tuple[DataFrame, DataFrame]:
        ambiguous = self._base.where(languages.is_disambiguation(F.col("text"), self._lang, self._category))
        ambiguous = ambiguous.withColumn("stripped", strip_templates("text")).where(X.truthy(F.col("stripped")))
        return _split(_lookup(disambiguation_lines(ambiguous, self._namespaces, self._lang), self._index), "disambiguation")

    @cached_property
    def disambiguation(self) -> DataFrame:
        return relations.disambiguation_index(self._listed[0]).select("id", F.col("target").alias("target_id"), "index", "scope")

    @cached_property
    def _inside(self) -> tuple[DataFrame, DataFrame]:
        boxes = self._base.where(F.contains(F.lower("text"), F.lit("{{infobox "))).select("id", F.col("title").alias("page_title"), F.explode(extract_infobox_links("text")).alias("markup"))
        boxes = boxes.withColumn("link", parsed(F.col("markup"), self._namespaces)).where(F.col("link.lang").isNull() & F.col("link.ns").isin(ARTICLES, CATEGORIES))
        return _split(_lookup(boxes.select("id", "page_title", "link.ns", F.col("link.title").alias("target_title")), self._index), "infobox")

    @cached_property
    def infobox(self) -> DataFrame:
        return self._inside[0].select(F.col("id").alias("from_id"), F.col("target").alias("to_id"))

    @cached_property
    def rejects(self) -> DataFrame:
        return relations.united([found[1] for found in (self._redirects, self._articles, self._parents, self._listed, self._inside)])

    def write(self, folder: str, done: set[str] | None = None, compression: str = "none") -> None:
        """All relations as text, one folder each; those in ``done`` (finished by an earlier run) are left alone."""
        for name in ("page", "stats", "redirect", "pagelink", "categorylink", "translation", "disambiguation", "equivalence", "anchor", "infobox", "rejects"):
            if name not in (done or ()):
                sinks.write_relation(getattr(self, name), str(PurePosixPath(folder) / name) if "://" not in folder else f"{folder}/{name}", self.QUOTED.get(name, ()), compression)


def finished(spark, folder: str) -> set[str]:
    """Names of the relations under ``folder`` that an earlier run wrote to the end (Spark marks them)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return set()
    return {s.getPath().getName() for s in fs.listStatus(path) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))}


def summary(pages: DataFrame, namespaces: dict[str, int], lang: str = "en") -> DataFrame:
    """(id, position, title, ns, type, key, text, redirect) of the articles and categories of ``pages`` (id, title, redirect, text, position).

    ``title`` is without its namespace, ``key`` its form in the title index, ``redirect`` the markup
    of what the page redirects to: the dump's own mark, else the text's.
    """
    category = next((name for name, key in namespaces.items() if key == CATEGORIES), "category")
    named = pages.withColumn("t", X.title_namespace(F.col("title"), namespaces))
    named = named.select("id", "position", F.col("t.title").alias("title"), F.col("t.key").alias("ns"), F.coalesce("text", F.lit("")).alias("text"), F.col("redirect").alias("mark"))
    named = named.where(F.col("ns").isin(ARTICLES, CATEGORIES))
    named = named.withColumn("redirect", F.coalesce("mark", languages.redirect_markup(F.col("text"), lang))).drop("mark")
    kind = X.page_type(F.col("ns"), F.col("redirect").isNotNull(), languages.is_disambiguation(F.col("text"), lang, category))
    return named.withColumns({"type": kind, "key": X.normalize_casing(X.clean_title(F.col("title")))})


def title_keys(pages: DataFrame) -> DataFrame:
    """(ns, key, target): the last page of a title that isn't a redirect, else its first redirect."""
    last = F.max_by("id", F.when(F.col("type") != 3, F.col("position")))
    first = F.min_by("id", F.when(F.col("type") == 3, F.col("position")))
    return pages.groupBy("ns", "key").agg(F.coalesce(last, first).alias("target"))


def parsed(markup: Column, namespaces: dict[str, int]) -> Column:
    """(lang, ns, title, anchor) of a link's markup: language prefix, then namespace, then ``title|anchor``."""
    language = X.markup_language(markup, namespaces)
    rest = X.markup_namespace(language["link"], namespaces)
    link = X.parse_link(rest["link"])
    return F.struct(language["lang"].alias("lang"), rest["key"].alias("ns"), link["title"].alias("title"), link["anchor"].alias("anchor"))


def _lookup(links: DataFrame, index: DataFrame) -> DataFrame:
    """``links`` (ns, target_title, ...) with ``target``, null where no page has the title."""
    links = links.withColumn("key", F.when(X.truthy(F.col("target_title")), X.normalize_casing(F.col("target_title"))))
    return links.join(index, ["ns", "key"], "left").drop("key")


def _split(found: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(links that found their page, rejects)."""
    lost = found.where("target IS NULL").select(F.lit(kind).alias("kind"), "id", F.col("page_title").alias("title"), F.col("target_title"), "ns")
    return found.where("target IS NOT NULL"), lost.withColumnRenamed("target_title", "target")


def disambiguation_lines(pages: DataFrame, namespaces: dict[str, int], lang: str = "en") -> DataFrame:
    """(id, page_title, line_no, ns, target_title, scope) of the first link in each line of ``pages`` (id, title, stripped).

    The lines end at the see-also heading or a language link; a line that names the page itself before its link doesn't count.
    """
    heading = rf"(?iU)={{2,}}\s*{languages.settings(lang).see_also}"
    lines = pages.select("id", F.col("title").alias("page_title"), F.posexplode(F.split("stripped", "\n")).alias("line_no", "line"))
    parts = F.split("line", r"\[\[|\]\]")
    lines = lines.withColumns({"before": parts[0], "markup": F.get(parts, F.lit(1)), "heading": F.col("line").rlike(heading)})
    counts = F.col("markup").isNotNull() & (F.instr(F.lower("before"), F.lower("page_title")) == 0)
    lines = lines.withColumn("link", F.when(counts, parsed(F.col("markup"), namespaces)))
    stop = F.min(F.when(F.col("heading") | F.col("link.lang").isNotNull(), F.col("line_no"))).over(Window.partitionBy("id"))
    lines = lines.withColumn("stop", stop).where("link IS NOT NULL AND (stop IS NULL OR line_no < stop)").where(F.col("link.ns").isin(ARTICLES, CATEGORIES))
    scope = F.regexp_replace("line", r"^\*+", "")
    scope = F.regexp_replace(scope, r"\[\[([^\]|]+)\|([^\]]+)\]\]", "$2")
    scope = F.regexp_replace(F.regexp_replace(scope, r"(?U)\[\[\s*([^\]]+)\]\]", "$1"), "'{2,}", "")
    return lines.select("id", "page_title", "line_no", F.col("link.ns").alias("ns"), F.col("link.title").alias("target_title"), X.clean_text(scope).alias("scope"))


def extract(pages: DataFrame, namespaces: dict[str, int], lang: str = "en") -> Relations:
    """The relations of ``pages`` (id, title, redirect, text, position), one row a page, as :func:`graphloom.sources.dump.latest` gives them.

    Null texts count as empty; an empty dump gives empty relations; pages of other namespaces are left out.
    """
    return Relations(pages, namespaces, lang)


def distinct_ids(pages: DataFrame) -> DataFrame:
    """``pages`` (id, ...); an id with two rows is an error when the result is read."""
    counted = pages.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("id")))
    bad = F.raise_error(F.concat(F.col("id").cast("string"), F.lit(" has more than one type"))).cast("bigint")
    return counted.withColumn("id", F.when(F.col("__n") == 1, F.col("id")).otherwise(bad)).drop("__n")


def canonical_pages(pages: DataFrame, pagelinks: DataFrame, disambiguations: DataFrame) -> DataFrame:
    """(id, target): the articles that a redirect or disambiguation page leads to; an article that links or is led to stands for itself.

    Of ``pagelinks`` (from_id, to_id) those of redirects count, of ``disambiguations`` (id, target_id) all; nothing that leads
    to a category does, and no redirect that is a category.  Loops are followed to whatever leaves them.
    """
    types = distinct_ids(pages).select("id", "type")
    kind = lambda k: types.select(F.col("id").alias(k), F.col("type").alias(f"{k}_type"))
    known = lambda df: df.join(kind("u"), "u", "left").join(kind("v"), "v", "left").where("v_type IS NULL OR v_type != 2")
    links = written(known(pagelinks.select(F.col("from_id").alias("u"), F.col("to_id").alias("v")).distinct()))
    lists = known(disambiguations.select(F.col("id").alias("u"), F.col("target_id").alias("v")).distinct())
    edges = written(links.where("u_type = 3").unionByName(lists).select("u", "v", "v_type").distinct())
    selves = links.where("u_type = 1 AND v_type = 1").select(F.col("u").alias("id")).union(edges.where("v_type = 1").select("v")).distinct()
    reached = relations.canonical(edges.select("u", "v"), types.where("type = 1").select("id"))
    return reached.unionByName(selves.select("id", F.col("id").alias("target"))).distinct()


def entity_dictionary(anchors: DataFrame, pages: DataFrame, canon: DataFrame, with_anchors: bool = True, preserve_case: bool = False) -> DataFrame:
    """(headword, entity, weight) from ``anchors`` (anchor, target_id, freq), ``pages`` (id, title, type) and ``canon`` (id, target).

    Titles lead with weight 1 to every canonical target of their page, anchors with their frequency to the only one:
    anchors of pages with several targets are left out.  Pages whose normalised title is shorter than two letters don't exist here.
    """
    known = distinct_ids(pages).select("id", X.normalize_title(F.col("title")).alias("t"), "type").where(F.length("t") >= 2)
    ids = known.select("id")
    links = canon.join(ids, "id", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi").select("id", "target").distinct()
    targets = links.groupBy("id").agg(F.min("target").alias("only"), F.count(F.lit(1)).alias("n"))

    titles = known.select("id", X.title_to_headword(F.col("t"), preserve_case).alias("headword")).where(X.truthy(F.col("headword")))
    rows = titles.join(links, "id", "left").select("headword", F.coalesce("target", "id").alias("id"), F.lit(1).cast("bigint").alias("weight"))
    if with_anchors:
        surface = anchors.select(X.normalize_anchor(F.col("anchor"), preserve_case).alias("headword"), F.col("target_id").alias("id"), F.col("freq").cast("bigint").alias("weight"))
        surface = surface.where(F.length("headword") > 1).groupBy("headword", "id").agg(F.sum("weight").alias("weight"))
        surface = surface.join(targets, "id", "left").where("n IS NULL OR n = 1")
        rows = rows.unionByName(surface.select("headword", F.coalesce("only", "id").alias("id"), "weight"))
    by_id = rows.groupBy("headword", "id").agg(F.sum("weight").alias("weight")).where("weight != 0")
    named = by_id.join(known.where("type = 1").where(X.truthy(F.col("t"))).select("id", F.col("t").alias("entity")), "id")
    return named.groupBy("headword", "entity").agg(F.sum("weight").alias("weight"))


def subset(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """The pages whose id is in ``ids`` (id)."""
    return pages.join(ids.select("id").distinct(), "id", "left_semi")


def proper_articles(pages: DataFrame) -> DataFrame:
    """Pages (title, ns or null, redirect) of the main namespace that aren't redirects."""
    return pages.where("ns = 0 AND redirect IS NULL")


def links_to_text(texts: DataFrame) -> DataFrame:
    """``texts`` (text, ...) with every link replaced by what it shows; links with a colon in the target (other namespaces and languages) go."""
    markup = r"(?s)\[\[((?:(?!\[\[|\]\]).)+)\]\]"
    gaps, found = F.split("text", markup, -1), F.regexp_extract_all("text", F.lit(markup), F.lit(1))
    sides = lambda m: F.split(m, r"\|", 2)
    shown = F.transform(found, lambda m: F.when(F.get(sides(m), F.lit(0)).contains(":"), F.lit("")).otherwise(F.element_at(sides(m), -1)))
    pieces = F.zip_with(gaps, shown, lambda g, s: F.concat(g, F.coalesce(s, F.lit(""))))
    return texts.withColumn("text", F.array_join(pieces, ""))
