"""Column functions for titles, links, anchors and wikitext.

Patterns carry ``(?U)`` so that word and space classes follow Unicode, and
``(?d)`` where a dot must stop at line feeds only.  Null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRIM = r"(?U)^\s+|\s+$"


def _all(s: Column, *rules: tuple[str, str]) -> Column:
    for pattern, new in rules:
        s = F.regexp_replace(s, pattern, new)
    return s


def truthy(c: Column) -> Column:
    """Neither null nor empty nor the text ``0``."""
    return c.isNotNull() & (c != "") & (c != "0")


def clean_text(s: Column) -> Column:
    """Escape backslashes, quotes and line feeds, then trim (so outer line feeds survive as escapes)."""
    s = F.replace(F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return F.regexp_replace(s, _TRIM, "")


def unescape_text(s: Column) -> Column:
    """Undo the escapes one kind after the other."""
    return F.replace(F.replace(F.replace(s, F.lit("\\\\"), F.lit("\\")), F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))


def clean_title(s: Column) -> Column:
    """``clean_text``, underscores and runs of space as one space, section suffix removed."""
    return _all(clean_text(s), ("_+", " "), (r"(?U)\s+", " "), ("(?d)#.+", ""))


def normalize_casing(s: Column) -> Column:
    """Upper-case the first letter of each word and leave the rest."""
    parts = F.regexp_extract_all(s, F.lit(r"(?U)\w+|(?U)\W+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))), "")


def case_fixer(title: Column) -> Column:
    """Upper-case the first letter, or the first letter after the first colon prefix."""
    prefix = F.regexp_extract(title, r"(?s)^([^:]*:)?", 0)
    rest = F.substring(title, F.length(prefix) + 1, F.length(title))
    return F.concat(prefix, F.upper(F.substring(rest, 1, 1)), F.substring(rest, 2, 1 << 30))


def normalize_title(s: Column) -> Column:
    """Unescape quotes, cut at ``#``, trim, white space to underscores."""
    s = F.replace(F.replace(s, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))
    return _all(s, ("(?s)#.*", ""), (_TRIM, ""), (r"(?U)\s+", "_"))


def title_to_headword(s: Column, preserve_case: bool = False) -> Column:
    """Drop parentheses and outer underscores."""
    s = _all(s, (r"\([^)]+\)", ""), ("^_+|_+$", ""))
    return s if preserve_case else F.lower(s)


def normalize_anchor(s: Column, preserve_case: bool = False) -> Column:
    """Headword form of link text: outer quotes, parentheses, section and escaped quotes go, white space becomes underscores."""
    s = _all(s, ('^"|"$', ""), (r"\([^)]+\)", ""), ("(?s)#.*", ""), (r'\\\\\\"', ""), (r"(?U)\s+", "_"), ("^_+|_+$", ""))
    return s if preserve_case else F.lower(s)


def _namespace_map(namespaces: dict[str, int]) -> Column:
    pairs = [F.lit(x) for name, key in namespaces.items() for x in (name.lower(), key)]
    return F.create_map(*pairs) if pairs else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))


def title_namespace(title: Column, namespaces: dict[str, int]) -> Column:
    """(title, ns, key) of ``prefix:rest``; an unknown prefix belongs to the title (key 0)."""
    prefix = F.regexp_extract(title, r"(?s)^([^:]+):(.*)", 1)
    key = F.try_element_at(_namespace_map(namespaces), F.lower(prefix))
    known = (prefix != "") & key.isNotNull()
    return F.struct(
        F.when(known, F.regexp_extract(title, r"(?s)^([^:]+):(.*)", 2)).otherwise(title).alias("title"),
        F.when(known, prefix).otherwise("").alias("ns"),
        F.when(known, key).otherwise(0).alias("key"),
    )


def markup_namespace(markup: Column, namespaces: dict[str, int]) -> Column:
    """(link, ns, key) of a link's markup; repeated colons are swallowed, an unknown prefix is put back with one."""
    pattern = r"(?d)^(.+?):+(.+)"
    prefix, rest = F.regexp_extract(markup, pattern, 1), F.regexp_extract(markup, pattern, 2)
    key = F.try_element_at(_namespace_map(namespaces), F.lower(prefix))
    known = (prefix != "") & key.isNotNull()
    link = F.when(known, rest).when(prefix != "", F.concat(prefix, F.lit(":"), rest)).otherwise(markup)
    return F.struct(link.alias("link"), F.when(known, prefix).otherwise("").alias("ns"), F.when(known, key).otherwise(0).alias("key"))


def markup_language(markup: Column, namespaces: dict[str, int]) -> Column:
    """(link, lang): a prefix of two characters or more that starts with a-z and is no namespace is a language."""
    pattern = r"(?d)^([a-z].+?):(.+)"
    prefix = F.regexp_extract(markup, pattern, 1)
    is_lang = (prefix != "") & F.try_element_at(_namespace_map(namespaces), F.lower(prefix)).isNull()
    return F.struct(
        F.when(is_lang, F.regexp_extract(markup, pattern, 2)).otherwise(markup).alias("link"), F.when(is_lang, clean_text(prefix)).alias("lang")
    )


def parse_link(markup: Column) -> Column:
    """(title, anchor) of ``title|anchor``; both from the whole markup without a pipe."""
    pattern = r"(?d)^(.+?)\|(.+)"
    piped = markup.rlike(pattern)
    return F.struct(
        clean_title(F.when(piped, F.regexp_extract(markup, pattern, 1)).otherwise(markup)).alias("title"),
        clean_text(F.when(piped, F.regexp_extract(markup, pattern, 2)).otherwise(markup)).alias("anchor"),
    )


def parse_page_freq(s: Column) -> Column:
    """(page, freq) of ``page:freq``; the frequency defaults to 1."""
    page = F.regexp_extract(s, r"^(.*):([^:]*\d[^:]*)$", 1)
    freq = F.regexp_extract(s, r"^(.*):([^:]*\d[^:]*)$", 2)
    return F.struct(F.when(page == "", s).otherwise(page).alias("page"), F.when(page == "", F.lit(1)).otherwise(F.coalesce(freq.try_cast("bigint"), F.lit(1))).alias("freq"))


#: Wikitext to plain text, in order (pattern, replacement); the links rules come separately.
_BEFORE_LINKS = ((r"(?s)<!--.*?-->", ""), ("''+", ""), ("==+", ""), (r"\{\{[^{}]*\}\}", ""), (r"(?s)\{\{.*?\}\}", ""), (r"(?s)\{\|.*?\|\}", ""))
#: Links to the dictionary project keep what they show.
_WIKTIONARY = ((r"(?id)\[\[wiktionary:([^\[\]]+?)\|([^\[\]]+?)\]\]", "$2"), (r"(?id)\[\[wiktionary:([^\[\]]*?)\]\]", "$1"))
_LINKS = ((r"\[\[[^\[\]|:]+\|([^\[\]]+)\]\]", "$1"), (r"\[\[([^\[\]|:]+)\]\]", "$1"), *_WIKTIONARY, (r"\[\[[^\[\]]*\]\]", ""))
_AFTER_LINKS = (
    (r"\[https?://[^\s\]]+ ([^\]]+)\]", "$1"), (r"(?i)<ref[^<>]*/>", ""), (r"(?is)<ref>.*?</ref>", ""), (r"(?is)<ref [^<>]*>.*?</ref>", ""), ("\n{3,}", "\n\n"), (r"<[^<>]+>", ""),
)


def strip_text(s: Column, keep_links: bool = False) -> Column:
    """Plain text of wikitext without nested templates; ``keep_links`` leaves all links but those to the dictionary project."""
    return _all(s, *_BEFORE_LINKS, *(_WIKTIONARY if keep_links else _LINKS), *_AFTER_LINKS)


def flat_links(s: Column) -> Column:
    """Markups of the links of a text in which links don't nest."""
    return F.regexp_extract_all(s, F.lit(r"(?s)\[\[((?:(?!\[\[|\]\]).)+)\]\]"), F.lit(1))


def page_type(ns: Column, is_redirect: Column, is_disambiguation: Column) -> Column:
    """1 article, 2 category, 3 redirect, 4 disambiguation; null for other namespaces."""
    return F.when(ns == 0, F.when(is_redirect, 3).when(is_disambiguation, 4).otherwise(1)).when(ns == 14, F.when(is_redirect, 3).otherwise(2))


def pretty_number(n: Column) -> Column:
    return F.format_number(n, 0)


def pretty_bytes(n: Column) -> Column:
    """A size in the largest unit that it reaches, with two decimals: ``512 B``, ``1.50 KiB``."""
    text = F.concat(n.cast("string"), F.lit(" B"))
    for k, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        text = F.when(n >= 1024**k, F.concat(F.format_string("%.2f", n / 1024**k), F.lit(f" {unit}"))).otherwise(text)
    return text


def link_line(title: Column, target: Column) -> Column:
    """A link as a sentence; a page without a title shows none."""
    return F.format_string('Article "%s" links to "%s"', F.coalesce(title, F.lit("")), target)


def without_prefix(edge: Column) -> Column:
    """``u:x`` or ``v:x`` without its mark."""
    return F.regexp_replace(edge, "^[uv]:", "")


def namespace_uri(base: Column, kind: str) -> Column:
    """The address of a page of the same site: ``base`` (as in the dump's header) up to its last slash, then ``kind``."""
    return F.concat(F.regexp_replace(base, "[^/]*$", ""), F.lit(kind))


def without_anchor_paragraphs(text: Column, anchor: str) -> Column:
    """The paragraphs (between blank lines) that hold no link which shows ``anchor``."""
    return F.array_join(F.filter(F.split(text, "\n\n+"), lambda p: ~F.array_contains(F.transform(flat_links(p), lambda m: F.element_at(F.split(m, r"\|", 2), -1)), anchor)), "\n\n")


def ngrams(text: Column, longest: int = 11) -> Column:
    """All distinct runs of 1 to ``longest`` words within a line of a text."""
    words = F.filter(F.transform(F.split(text, "\n"), lambda line: F.filter(F.split(line, r"(?U)\s+"), lambda w: w != "")), lambda w: F.size(w) > 0)
    runs = lambda w: F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(w)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size(w) - i + 1)), lambda n: F.array_join(F.slice(w, i, n), " "))
        )
    )
    return F.coalesce(F.array_distinct(F.flatten(F.transform(words, runs))), F.array().cast("array<string>"))
