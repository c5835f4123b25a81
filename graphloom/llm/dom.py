"""A tolerant reader of HTML into flat node lists, with the features of every node."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from functools import lru_cache

# fixed values: element names by their role in HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: void elements that stand within a line or show nothing
UNBROKEN = VOID - {"br", "hr"}
SKIPPED = frozenset("script style noscript template head title svg math iframe object audio video canvas textarea select".split())
RAW = frozenset("script style title textarea noscript iframe".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strong sub sup time tt u var big".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: an opening tag of the key closes an open element of these, looked for up to an element of the scope
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}),
}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>""", re.S)
_ATTR = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

#: Attribute words by what they say about a node.
LEXICON = {
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc tabs topbar skip",
    "header": "header masthead branding logo hero top head",
    "footer": "footer foot colophon copyright legal bottom imprint",
    "side": "sidebar side aside rail widget widgets secondary complementary",
    "notice": "notice notices cookie cookies consent gdpr alert warning popup modal overlay toast banner paywall disclaimer announcement message",
    "ad": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion dfp",
    "form": "form search login signin signup newsletter subscribe subscription contact register",
    "comment": "comment comments reply replies discussion disqus respond responses reader thread feedback",
    "extra": "share sharing social related recommended recommendations tags meta popular trending latest",
    "content": "article content post entry main body story text prose page articlebody hentry",
}
GROUPS = tuple(LEXICON)
_WORD_GROUP = {word: k for k, words in enumerate(LEXICON.values()) for word in words.split()}
TAG_GROUPS = (
    ("article", "main"), ("section", "div"), ("p",), ("h1", "h2", "h3", "h4", "h5", "h6"), ("ul", "ol", "dl", "menu"), ("li", "dt", "dd"), ("nav",), ("header",),
    ("footer",), ("aside",), ("form", "fieldset", "button", "label", "dialog"), ("table", "tbody", "thead", "tr", "td", "th"), ("blockquote", "pre", "figure", "figcaption"),
)
_TAG_GROUP = {tag: k for k, tags in enumerate(TAG_GROUPS) for tag in tags}
N_FEATURES = len(TAG_GROUPS) + 2 * len(GROUPS) + 16


@lru_cache(50_000)
def _groups(attributes: str) -> frozenset[int]:
    """The lexicon groups of the words in an element's naming attributes."""
    found = set()
    for value in _ATTR.findall(attributes):
        for word in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", value):
            if (k := _WORD_GROUP.get(word.lower())) is not None:
                found.add(k)
    return frozenset(found)


class Page:
    """Classified nodes in page order (a parent before its children) and the pieces of text between tags.

    Node 0 is the page itself.  A piece belongs to the nearest classified element;
    inline elements without naming attributes aren't classified.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.groups, self.attributes = ["html"], [-1], [frozenset()], [""]
        #: (node, text, inside a link); a break between blocks is a space of node -1
        self.pieces: list[tuple[int, str, bool]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # (tag, its node or its nearest ancestor's)
        links = skipping = 0
        at, pieces, unescape = 0, self.pieces, html.unescape
        n = len(source)
        last = source.rfind(">") + 1  # no tag ends after it, so none is looked for there
        opened: Counter[str] = Counter()  # of each tag in the stack, so that an end tag without its element costs nothing

        def close(i: int) -> tuple[int, int]:
            gone = [closed for closed, _ in stack[i:]]
            opened.subtract(gone)
            del stack[i:]
            return gone.count("a"), sum(closed in SKIPPED for closed in gone)

        while at < n:
            m = _TOKEN.search(source, at, last) if at < last else None
            if m is None and (comment := source.find("<!--", at)) >= 0 or m and m[0].startswith("<!--") and not m[0].endswith("-->"):
                text, m, n = source[at : m.start() if m else comment], None, 0  # never closed: it takes the rest
            else:
                text = source[at : m.start() if m else n]
            if text and not skipping:
                pieces.append((stack[-1][1], unescape(text) if "&" in text else text, links > 0))
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if opened[tag] > 0:
                    i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
                    fewer_links, fewer_skipped = close(i)
                    links, skipping = links - fewer_links, skipping - fewer_skipped
                if tag not in INLINE and tag not in UNBROKEN:
                    pieces.append((-1, " ", False))
                continue
            if tag in ("html", "body") and not skipping:
                continue
            if skipping and tag == "body":  # a head that was never closed
                close(1)
                links = skipping = 0
                continue
            if tag not in INLINE and tag not in UNBROKEN:
                pieces.append((-1, " ", False))
            if tag in VOID:
                continue
            if tag in CLOSES_P or tag in CLOSES:
                closing, scope = CLOSES.get(tag, (frozenset(("p",)), frozenset(("td", "th", "li", "button", "table"))))
                for i in range(len(stack) - 1, 0, -1) if any(opened[c] > 0 for c in closing) else ():
                    if stack[i][0] in closing:
                        links -= close(i)[0]
                        break
                    if stack[i][0] in scope:
                        break
            if m[3].endswith("/") and tag not in CLOSES_P and tag not in INLINE:
                continue
            groups = _groups(m[3]) if m[3] else frozenset()
            if (tag in INLINE and not groups) or tag in SKIPPED:
                node = stack[-1][1]
            else:
                node = len(self.tags)
                self.tags.append(tag)
                self.parents.append(stack[-1][1])
                self.groups.append(groups)
                self.attributes.append(m[3])
            stack.append((tag, node))
            opened[tag] += 1
            links += tag == "a"
            skipping += tag in SKIPPED
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else n
                skipping -= close(len(stack) - 1)[1]

    def features(self) -> list[list[float]]:
        """One row for each node: its tag, naming attributes (own and inherited), subtree densities, depth and sibling statistics."""
        n = len(self.tags)
        parents = self.parents
        own, chars, linked, marks, nodes, blocks, controls = ([0] * n for _ in range(7))
        for node, text, in_link in self.pieces:
            if node >= 0:
                k = len(text.strip())
                own[node] += k
                chars[node] += k
                linked[node] += k * in_link
                marks[node] += text.count(".") + text.count(",")
        rights = [0] * n
        for node, text, _ in self.pieces:
            if node >= 0 and "©" in text:
                rights[node] = 1
        depth, inherited, inside = [0] * n, [frozenset()] * n, [0] * n
        siblings: dict[tuple[int, str], int] = {}
        children, place = [0] * n, [0] * n
        for i in range(1, n):
            p = parents[i]
            depth[i] = depth[p] + 1
            inherited[i] = inherited[p] | self.groups[p]
            inside[i] = inside[p] or self.tags[p] in ("article", "main")
            key = (p, self.tags[i])
            siblings[key] = siblings.get(key, 0) + 1
            place[i] = children[p]
            children[p] += 1
        for i in range(n - 1, 0, -1):
            p = parents[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            marks[p] += marks[i]
            nodes[i] += 1
            nodes[p] += nodes[i]
            blocks[p] += blocks[i] + (self.tags[i] == "p")
            controls[p] += controls[i] + (self.tags[i] in ("form", "button", "label", "fieldset"))
            rights[p] |= rights[i]
        total = max(1, chars[0])
        rows = []
        for i in range(n):
            p = max(0, parents[i])
            row = [0.0] * N_FEATURES
            if (k := _TAG_GROUP.get(self.tags[i])) is not None:
                row[k] = 1.0
            at = len(TAG_GROUPS)
            for k in self.groups[i]:
                row[at + k] = 1.0
            at += len(GROUPS)
            for k in inherited[i]:
                row[at + k] = 1.0
            at += len(GROUPS)
            c = max(1, chars[i])
            row[at:] = (
                math.log1p(chars[i]), chars[i] / total, linked[i] / c, chars[i] / max(1, nodes[i]), own[i] / c, marks[i] / c, blocks[i], controls[i],
                float(rights[i]), float(depth[i]), float(inside[i]), siblings.get((p, self.tags[i]), 1), children[p], place[i] / max(1, children[p] - 1), nodes[i],
                chars[i] / max(1, chars[p]),
            )
            rows.append(row)
        return rows

    def keep(self, probability: list[float]) -> list[bool]:
        """The likeliest choice of nodes in which nothing is kept inside what is dropped."""
        n = len(self.tags)
        kept, dropped = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            p = min(1 - 1e-9, max(1e-9, probability[i]))
            kept[i] += math.log(p)
            dropped[i] += math.log(1 - p)
            if i:
                kept[self.parents[i]] += max(kept[i], dropped[i])
                dropped[self.parents[i]] += dropped[i]
        out = [True] * n
        for i in range(1, n):
            out[i] = out[self.parents[i]] and kept[i] >= dropped[i]
        return out

    def text(self, keep: list[bool]) -> str:
        """The text of the kept nodes, white space turned into single spaces."""
        return " ".join("".join(t for node, t, _ in self.pieces if node < 0 or keep[node]).split())
