"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Every element gets features (:mod:`graphloom.llm.dom`): tag, words of its naming
attributes, subtree text and link density, depth, sibling statistics.  Boosted
trees (:mod:`graphloom.llm.boosting`) give the probability that it belongs to the
article; a dynamic program picks the likeliest choice in which no kept node lies
inside a dropped one.  The trees are trained on ``TRAIN_PAGES`` invented pages
(:func:`example`), so no page of the input is learned from.

Defined cases: null, empty and tagless html (text outside any element is kept);
markup that is never closed or wrongly nested is repaired as browsers do, roughly;
a page without an article has an empty text; repeated rows are read alike; an
empty table gives an empty result; extra columns pass through :func:`extract`.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from graphloom.llm import boosting
from graphloom.llm.dom import LEXICON, Page

TRAIN_PAGES = 1500
#: Pages whose nodes are judged at a time.
STEP = 64

_SYLLABLES = "ta re mi so lan der ver ing tion que ado ment the and es or un la".split()


class _Writer:
    """Writes one invented page; what doesn't belong to the article is marked."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def words(self, n: int) -> str:
        r = self.rng
        out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 3))) for _ in range(n)]
        text = " ".join(w + r.choice(["", "", "", "", ",", "."]) for w in out)
        return text[:1].upper() + text[1:] + r.choice([".", "", "."])

    def attribute(self, group: str) -> str:
        r = self.rng
        word = r.choice(LEXICON[group].split())
        value = r.choice([word, f"{word}-{r.choice(['box', 'wrap', 'area', '1', 'inner', 'list'])}", f"{r.choice(['site', 'js', 'c', 'block'])}-{word}", f"{word}_{r.randint(1, 9)}"])
        return f' {r.choice(["class", "class", "id"])}="{value}"'

    def links(self, n: int) -> str:
        return "".join(f'<a href="/{k}">{self.words(self.rng.randint(1, 3))}</a>' + self.rng.choice([" ", " | ", ""]) for k in range(n))

    def link_list(self, n: int) -> str:
        return "<ul>" + "".join(f"<li>{self.links(1)}</li>" for _ in range(n)) + "</ul>"

    def marked(self, tag: str, attribute: str, inner: str) -> str:
        """A node outside the article."""
        return f"<{tag}{attribute} data-noise>{inner}</{tag}>"

    def boilerplate(self, kind: str) -> str:
        r = self.rng
        short = lambda: r.choice([self.words(r.randint(2, 25)), f"<p>{self.words(r.randint(3, 30))}</p>", f"<p>{self.words(r.randint(8, 60))}</p><p>{self.words(r.randint(4, 30))}</p>"])
        named = r.random() < 0.6
        if kind == "nav":
            inner = r.choice([self.link_list(r.randint(3, 10)), self.links(r.randint(3, 10))])
            return self.marked("nav" if named else r.choice(["div", "ul", "section"]), "" if named and r.random() < 0.6 else self.attribute("nav"), inner)
        if kind == "header":
            inner = r.choice([f"<h1>{self.words(2)}</h1>", f"<a href='/'>{self.words(2)}</a>", f"<div>{self.words(3)}</div>"]) + r.choice(["", f"<p>{self.words(5)}</p>", self.link_list(4)])
            return self.marked("header" if named else "div", "" if named and r.random() < 0.6 else self.attribute("header"), inner)
        if kind == "footer":
            inner = r.choice(["&copy; ", "&copy; ", "© 2024 ", "", "<p>"]) + self.words(r.choice([r.randint(1, 6), r.randint(3, 20), r.randint(10, 60)])) + r.choice(["", self.links(3), self.link_list(4)])
            return self.marked("footer" if named else "div", "" if named and r.random() < 0.6 else self.attribute("footer"), inner)
        if kind == "side":
            inner = r.choice(["", f"<h3>{self.words(2)}</h3>"]) + r.choice([self.link_list(r.randint(2, 8)), short()])
            return self.marked("aside" if named else r.choice(["div", "section"]), "" if named and r.random() < 0.6 else self.attribute("side"), inner)
        if kind == "form":
            inner = f"<label>{self.words(2)}</label><input type='text'><button>{self.words(1)}</button>" + r.choice(["", f"<p>{self.words(8)}</p>"])
            return self.marked("form", r.choice(["", self.attribute("form")]), inner) if named else self.marked("div", self.attribute("form"), r.choice([f"<form>{inner}</form>", short()]))
        if kind == "comment":
            one = lambda: f"<{t}{self.attribute('comment') if r.random() < 0.6 else ''}><p>{self.words(r.randint(3, 60))}</p></{t}>"
            t = r.choice(["div", "li", "article", "section"])
            return self.marked(r.choice(["section", "div", "ol"]), self.attribute("comment"), r.choice(["", f"<h3>{self.words(1)}</h3>"]) + "".join(one() for _ in range(r.randint(1, 5))))
        return self.marked(r.choice(["div", "div", "section", "aside", "p", "span"] if kind == "ad" else ["div", "div", "section", "aside", "p"]), self.attribute(kind), r.choice([self.words(r.randint(1, 25)), short() if r.random() < 0.7 else self.link_list(3)]))

    def block(self) -> str:
        r = self.rng
        kind = r.random()
        if kind < 0.62:
            text = self.words(r.choice([r.randint(1, 6), r.randint(10, 80), r.randint(20, 150)]))
            text = r.choice([text, text, f"<b>{text}", f"{text[: len(text) // 2]}<br>{text[len(text) // 2 :]}", f"{text} <a href='/x'>{self.words(3)}</a> {self.words(6)}", f"<em>{self.words(2)}</em> {text}"])
            return f"<p>{text}" + r.choice(["</p>", "</p>", "</p>", ""])
        if kind < 0.74:
            return f"<h{(k := r.randint(1, 4))}>{self.words(r.randint(2, 10))}</h{k}>"
        if kind < 0.84:
            tag = r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.words(r.randint(2, 25))}" + r.choice(["</li>", ""]) for _ in range(r.randint(2, 6))) + f"</{tag}>"
        if kind < 0.9:
            return f"<blockquote>{r.choice([self.words(20), f'<p>{self.words(25)}</p>'])}</blockquote>"
        if kind < 0.94:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{self.words(2)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>"
        if kind < 0.97:
            return f"<pre>{self.words(12)}</pre>"
        return f"<figure><img src='x'><figcaption>{self.words(8)}</figcaption></figure>"

    def page(self) -> str:
        r = self.rng
        inner = f"<h1>{self.words(r.randint(2, 12))}</h1>" if r.random() < 0.85 else ""
        for _ in range(r.choice([0, 1, 1, 2, 3, r.randint(1, 14), r.randint(4, 14)]) or (not inner)):
            inner += self.block()
            if r.random() < 0.08:
                inner += self.boilerplate(r.choice(["ad", "ad", "extra", "form", "notice", "side"]))
        if r.random() < 0.15:
            inner += self.boilerplate(r.choice(["comment", "extra", "nav"]))
        tag, attribute = r.choice([("article", ""), ("article", ""), ("article", self.attribute("content")), ("main", ""), ("div", self.attribute("content")), ("section", self.attribute("content")), ("div", "")])
        article = f"<{tag}{attribute}>{inner}</{tag}>" if r.random() < 0.94 else inner
        if r.random() < 0.3:
            article = f"<{(w := r.choice(['main', 'div', 'section']))}{r.choice(['', self.attribute('content')])}>{article}" + (self.boilerplate("comment") if r.random() < 0.3 else "") + f"</{w}>"
        before = [self.boilerplate(k) for k in r.choices(["nav", "header", "ad", "notice", "form", "side", "extra"], k=r.randint(0, 4))]
        after = [self.boilerplate(k) for k in r.choices(["footer", "footer", "side", "comment", "ad", "extra", "form", "nav", "notice"], k=r.randint(0, 4))]
        body = "".join(before) + article + "".join(after)
        if r.random() < 0.25:
            body = f'<div{r.choice(["", " class=wrapper", " id=container"])}>{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(3)}</title><script>var x='<p>';</script></head><body>{body}" + r.choice(["</body></html>", ""])


def example(seed: int) -> tuple[Page, list[int]]:
    """An invented page and, for each node, whether it belongs to the article (or holds it)."""
    page = Page(_Writer(random.Random(seed)).page())
    labels = [1] * len(page.tags)
    for i in range(1, len(labels)):
        labels[i] = int(labels[page.parents[i]] and "data-noise" not in page.attributes[i])
    return page, labels


@lru_cache(1)
def fit(pages: int = TRAIN_PAGES) -> boosting.BoostedTrees:
    """The trees; the same ones every time."""
    x, y = [], []
    for seed in range(pages):
        page, labels = example(seed)
        x += page.features()[1:]
        y += labels[1:]
    return boosting.train(np.array(x), np.array(y, float))


def texts_of(sources: list[str], trees: boosting.BoostedTrees) -> list[str]:
    """The main text of each page."""
    out: list[str] = []
    for at in range(0, len(sources), STEP):
        pages = [Page(s) for s in sources[at : at + STEP]]
        rows = [p.features() for p in pages]
        probability = trees.probability(np.array([r for page in rows for r in page])).tolist()
        start = 0
        for page, nodes in zip(pages, rows, strict=True):
            out.append(page.text(page.keep(probability[start : start + len(nodes)])))
            start += len(nodes)
    return out


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` (any columns) with ``text`` (empty if none) and ``n_chars``, its code points."""
    trees = fit()
    columns = [f for f in pages.schema if f.name not in ("text", "n_chars")]
    names = [f.name for f in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                texts = texts_of([s or "" for s in batch.column(html).to_pylist()], trees)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n) for n in names], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"]
                )

    schema = T.StructType([*columns, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*names).mapInArrow(run, schema)


def digest(pages: DataFrame) -> DataFrame:
    """The query's columns."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
