"""Main text of web pages by tag-path ratios (operator 11).

A page is read once into text nodes (the text of one block) with the path of
block elements from the root down to each; inline elements don't end a block
and are no part of a path. Then, page by page:

1. Aggregate. Every path gets the text length and the punctuation of its
   nodes, link text left out, as ratios to the number of its nodes: a path
   that carries an article has long, punctuated nodes, one of a menu short
   ones.
2. Smooth. In page order each node takes a Gaussian mean of the ratios around
   it, weighted by how much of the path the nodes share, so a heading between
   paragraphs counts as text and a menu beside them does not.
3. Fuse. Length ratio times one plus punctuation ratio. Elements whose tag,
   role or class says what they are (menus, notices, forms, comments) count
   as nothing, whatever they contain.
4. Threshold. Paths that reach ``share`` of the best fused score are content.
   Their nodes vote for the content's element: ``article``, else ``main``,
   else the deepest element that holds most of their text. All of its text
   is returned, so a short paragraph is not lost; text elsewhere is not.

Work and memory are those of one page at a time; nothing is shuffled.

Defined results: a null or empty page, and one without content, gives an
empty text; a page without tags is one block; repeated rows and rows without
an id are read each; unclosed and misplaced tags are mended as browsers do in
the cases below, an unfinished tag or comment at the end is dropped; extra
columns of any name are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# What HTML says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())  # no tags inside
BLOCK = frozenset(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav noscript ol option p pre search section select summary "
    "table tbody td template tfoot th thead tr ul button svg math canvas object audio video optgroup datalist textarea title script "
    "style iframe xmp noembed noframes".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
#: What an opening tag ends, and the elements it doesn't look beyond.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
        "option": ({"option"}, {"select"}), "body": ({"head"}, set())}
SCOPE = frozenset("table td th caption template object".split())  # closing tags don't reach beyond
# Elements that are no main text, by tag, role and the words of class and id.
NOT_TEXT = frozenset("head title script style noscript template iframe noembed noframes object svg math canvas audio video select "
                     "option optgroup datalist textarea button nav footer aside form dialog menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adslot adbox sponsor sponsored sponsors promo promos promotion banner banners "
    "nav navbar navigation menu menus menubar submenu breadcrumb breadcrumbs pagination pager header masthead topbar toolbar footer "
    "footers bottombar copyright legal sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices "
    "notification notifications alert popup modal overlay newsletter subscribe subscription signup login signin register paywall "
    "form forms search searchbox comment comments commentlist disqus reply replies respond discussion feedback share sharing social "
    "related recommended recommendation recommendations teaser teasers outbrain taboola tagcloud hidden".split())
UNLESS = frozenset("has with no without".split())  # "has-sidebar" is no sidebar

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+)(>|\Z)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
SAYS = re.compile(r"\b(?:class|id|role|hidden|style)\b", re.I)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Characters that count as punctuation (fixed value).
PUNCTUATION = re.compile("[.,;:!?…、。，．：；！？،؛؟]")
WIDTH, REACH = 1.0, 2  # of the smoothing, in nodes

OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
                 ("paths", pa.list_(pa.string()))])
OUT_DDL = "page_id bigint, url string, text string, n_chars bigint, paths array<string>"


class Page:
    """Elements (tag, parent, label, whether they can be main text) and text
    nodes (element, text, length and punctuation outside links)."""

    def __init__(self, html: str):
        self.tag, self.parent, self.label, self.out = [""], [-1], [""], [False]
        self.soft = [False]  # out by a word only
        self.nodes: list[tuple[int, str, int, int]] = []
        self.open = [0]
        self.parts: list[tuple[bool, str]] = []
        self.link = False
        at = 0
        while (m := TOKEN.search(html, at)) is not None:
            self.text(html[at:m.start()])
            at = m.end()
            name = m[2]
            if name is None or not m[4]:  # a comment, a declaration, or an unfinished tag
                continue
            name = name.lower()
            if m[1]:
                self.end(name)
            else:
                self.start(name, m[3])
                if name in RAW:
                    close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                    raw = html[at:close.start() if close else len(html)]
                    at += len(raw)
                    if name == "textarea":
                        self.text(raw)
        self.text(html[at:])
        self.flush()

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append((self.link, unescape(raw) if "&" in raw else raw))

    def flush(self) -> None:
        """Ends the block."""
        if self.parts:
            text = " ".join("".join(t for _, t in self.parts).split())
            if text:
                own = " ".join("".join(t for in_link, t in self.parts if not in_link).split())
                self.nodes.append((self.open[-1], text, len(own), len(PUNCTUATION.findall(own))))
            self.parts = []

    def start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.link = True
            return
        if name == "br" or name == "hr":
            self.flush()
            if name == "hr":
                self.pop_to({"p"}, SCOPE)
            return
        if name in VOID or name not in BLOCK:
            return
        self.flush()
        self.link = False
        if name in CLOSES_P:
            self.pop_to({"p"}, SCOPE | {"button"})
        if name in ENDS:
            self.pop_to(*ENDS[name])
        words, role, unseen = self.says(attributes) if SAYS.search(attributes) else ((), "", False)
        soft = name not in ("html", "body", "main") and bool(HINTS.intersection(words))
        up = self.open[-1]
        self.open.append(len(self.tag))
        self.tag.append(name)
        self.parent.append(up)
        self.label.append(".".join((name, *sorted(set(words)))))
        self.out.append(name in NOT_TEXT or role in ROLES or unseen)
        self.soft.append(soft)

    def says(self, attributes: str) -> tuple[list[str], str, bool]:
        """Words of class and id, the role, whether it is hidden."""
        words, role, unseen = [], "", False
        for k, *v in ATTRIBUTE.findall(attributes):
            k, v = k.lower(), unescape("".join(v))
            if k in ("class", "id"):
                for one in v.split():
                    w = [x.lower() for x in WORD.findall(one)]
                    words += [x for i, x in enumerate(w) if not i or w[i - 1] not in UNLESS]
            elif k == "role":
                role = v.strip().lower()
            elif k == "hidden" or (k == "style" and UNSEEN.search(v)):
                unseen = True
        return words, role, unseen

    def end(self, name: str) -> None:
        if name == "a":
            self.link = False
        elif name == "br":
            self.flush()
        elif name in BLOCK and name not in ("html", "body"):
            self.flush()
            self.link = False
            same = {"h1", "h2", "h3", "h4", "h5", "h6"} if name in ("h1", "h2", "h3", "h4", "h5", "h6") else {name}
            self.pop_to(same, SCOPE if name not in SCOPE else {"table"} if name in ("td", "th", "caption") else set())

    def pop_to(self, names: set[str], beyond) -> None:
        """Closes the nearest open element of these names, if none of those
        beyond which one doesn't look is before it."""
        for k in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[k]]
            if t in names:
                del self.open[k:]
                return
            if t in beyond:
                return

    def excluded(self) -> list[bool]:
        """Of each element, whether it or one around it is no main text. A
        word excludes no element that holds an article or main element, nor
        do ``header`` and its word inside an article; a form that holds one
        is the page's."""
        n = len(self.tag)
        holds, within = [False] * n, [False] * n
        core = [t in ("article", "main") and not self.out[k] and not self.soft[k] for k, t in enumerate(self.tag)]
        for k in range(n - 1, 0, -1):
            if core[k] or holds[k]:
                holds[self.parent[k]] = True
        gone = [False] * n
        for k in range(1, n):
            up = self.parent[k]
            within[k] = within[up] or core[up]
            words = set(self.label[k].split(".")[1:])
            head = self.tag[k] == "header" or (self.soft[k] and words & HINTS == {"header"})
            own = self.out[k] or self.soft[k] or head
            if own and head and not self.out[k] and within[k]:
                own = False
            if own and holds[k] and (self.tag[k] == "form" or not self.out[k]):
                own = False
            gone[k] = gone[up] or own
        return gone

    def path(self, k: int) -> tuple[str, ...]:
        labels = []
        while k > 0:
            labels.append(self.label[k])
            k = self.parent[k]
        return tuple(reversed(labels))


def content_paths(nodes: list[tuple[tuple[str, ...], int, int]], share: float) -> set[tuple[str, ...]]:
    """The content paths among (path, length, punctuation) of nodes in order."""
    total: dict[tuple[str, ...], list[int]] = {}
    for p, n, k in nodes:
        t = total.setdefault(p, [0, 0, 0])
        t[0] += n
        t[1] += k
        t[2] += 1
    paths = [p for p, _, _ in nodes]
    length = [total[p][0] / total[p][2] for p in paths]
    marks = [total[p][1] / total[p][2] for p in paths]
    common: dict[tuple, float] = {}

    def alike(a: tuple[str, ...], b: tuple[str, ...]) -> float:
        if a == b:
            return 1.0
        if (a, b) not in common:
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            common[a, b] = n / max(len(a), len(b), 1)
        return common[a, b]

    around = [(d, math.exp(-d * d / (2 * WIDTH * WIDTH))) for d in range(-REACH, REACH + 1)]
    best: dict[tuple[str, ...], float] = {}
    for i, p in enumerate(paths):
        weight = long = punctuated = 0.0
        for d, g in around:
            if 0 <= i + d < len(paths):
                w = g * alike(p, paths[i + d])
                weight += w
                long += w * length[i + d]
                punctuated += w * marks[i + d]
        best[p] = max(best.get(p, 0.0), long / weight * (1 + punctuated / weight))
    least = share * max(best.values(), default=0.0)
    return {p for p, s in best.items() if s > 0 and s >= least}


def main_text(html: str | None, share: float = 0.2) -> tuple[str, list[str]]:
    """(main text, content paths) of a page."""
    if not html:
        return "", []
    page = Page(html)
    gone = page.excluded()
    kept = [x for x in page.nodes if not gone[x[0]]]
    route = {k: page.path(k) for k in {x[0] for x in kept}}
    chosen = content_paths([(route[k], n, m) for k, _, n, m in kept], share)
    if not chosen:  # nothing but links
        chosen = set(route.values())
    votes = [0] * len(page.tag)
    for k, text, _, _ in kept:
        if route[k] in chosen:
            votes[k] += len(text)
    for k in range(len(votes) - 1, 0, -1):
        votes[page.parent[k]] += votes[k]
    inside = region(page, votes, gone)
    text = " ".join(t for k, t, _, _ in kept if inside[k])
    return text, sorted("/".join(p) for p in {route[k] for k, _, _, _ in kept if inside[k]})


def region(page: Page, votes: list[int], gone: list[bool]) -> list[bool]:
    """Of each element, whether it lies in the content's element."""
    n = len(page.tag)
    roots: set[int] = set()
    for tag in ("article", "main"):
        roots = {k for k in range(1, n) if page.tag[k] == tag and votes[k] and not gone[k]}
        if roots:
            break
    else:
        children: dict[int, list[int]] = {}
        for k in range(1, n):
            if votes[k]:
                children.setdefault(page.parent[k], []).append(k)
        at = 0
        while children.get(at):
            k = max(children[at], key=votes.__getitem__)
            # Paragraphs and headings are no container: a sole one is read with its siblings.
            if votes[k] < 0.9 * votes[at] or page.tag[k] in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"):
                break
            at = k
        roots = {at}
    inside = [False] * n
    for k in range(n):
        inside[k] = k in roots or (k > 0 and inside[page.parent[k]])
    return inside


def extract(pages: DataFrame, share: float = 0.2, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) and the paths that the text
    was taken from, of every page."""
    if not 0 < share <= 1:
        raise ValueError("share: above 0, 1 at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                found = [main_text(h.as_py(), share) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays([
                    part.column("page_id"), part.column("url"), pa.array([t for t, _ in found], pa.string()),
                    pa.array([len(t) for t, _ in found], pa.int64()), pa.array([p for _, p in found], pa.list_(pa.string()))],
                    schema=OUT)

    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(run, OUT_DDL)
