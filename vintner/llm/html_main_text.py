"""The main text of web pages by scoring the containers of the element tree.

Every paragraph earns points for its length and its commas and passes them to all its ancestors, less with
each level. A container's points are discounted by the share of its text that is inside links. The best
container is the article (or the article or main element around it, or the ancestor that holds most of
several good containers), and those of its siblings are kept that score well themselves or are plain
paragraphs or headings. Menus, headers, footers, sidebars,
notices, adverts, forms and reader comments are left out before any points are given, by element, role
and the words in class and id.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = "page_id long, url string, text string, n_chars long"

# Outside quotes a tag ends before the next "<", so that what is never closed is looked at once.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Of attributes read backwards: the slash at the end belongs to a value without quotes.
_UNQUOTED = re.compile(r"""/[^\s"'>=]*+\s*+=""")
_WORD = re.compile(r"[a-z]+")
_OF_OTHERS = re.compile(r"(?:with|has|no|without)[-_]\w+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg math select".split())
#: Of these only the tag is passed over if the page never ends them.
MAY_STAY_OPEN = frozenset("svg math select noscript noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike"
    " strong sub sup time tt u var wbr ruby rb rt rp img picture source".split()
)
#: Elements that begin a block of text; all others, also unknown ones, run on in the text around them.
BLOCKS = frozenset(
    "#root address applet article aside audio blockquote body button canvas caption center colgroup datalist dd details"
    " dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html"
    " legend li listing main marquee menu nav object ol optgroup option p plaintext pre search section summary table"
    " tbody td tfoot th thead tr ul video".split()
)
LEFT_OUT = frozenset(
    "nav header footer aside form button fieldset menu dialog object applet audio video canvas datalist head".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form tablist toolbar".split()
)
#: Words of a class or id that mark a container as something beside the article.
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion"
    " sidebar sidebars aside rail nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager"
    " header masthead topbar footer footers toolbar cookie cookies consent gdpr notice notices popup modal overlay"
    " newsletter subscribe subscription signup login signin share sharing social related recommended widget widgets"
    " skip hidden copyright legal disclaimer".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
#: Of these, words that titles of sections and names of article parts have as well.
AMBIGUOUS = frozenset(
    "related legal sharing share notice notices header widget widgets social discussion respond reply replies"
    " promotion disclaimer copyright subscription recommended hidden skip banner consent".split()
)
#: Words that with those make up an id that names a part of a page and not its subject.
PARTS = BESIDE | COMMENTS | frozenset("section area list block box wrap wrapper container content inner main top bottom left right".split())
#: Least characters of running text, and the most of it that may be in links.
RUNNING, LINKED = 80, 0.3
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr li main menu nav ol p pre section table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article main section div body html td center".split())
#: An opening tag that ends an open element of the second group, if no element of the third is in between.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
#: Shares of a paragraph's points for its container, the next two ancestors, and from each to the next beyond.
_LEVELS, _FURTHER = (1.0, 0.5, 1 / 6), 2 / 3
#: A container whose own paragraphs have this share of the best one's points is part of the article, and the
#: article holds this share of the points of all of those.
GOOD, MOST = 0.25, 0.75


class _Tree:
    """Elements as parallel lists; an element comes after its parent."""

    def __init__(self, page: str):
        self.tag, self.parent, self.out, self.soft, self.kind = ["#root"], [-1], [False], [False], [""]
        self.doubt, self._guarded = [False], [False]  # out unless it has running text; inside an article or main element
        self.texts: list[tuple[int, str]] = []  # element, text (a line break is a space of the element)
        open_ = [0]
        # Places in ``open_``, so that no walk over the open elements is needed: by name, of blocks, of blocks but
        # paragraphs, and of all but the page itself.
        self._places: dict[str, list[int]] = {}
        self._blocks: list[int] = []
        self._walls: list[int] = []
        self._within: list[int] = []
        at, n = 0, len(page)
        endless: set[str] = set()  # names without an end tag in the rest of the page
        while at < n:
            found = _TOKEN.search(page, at)
            if found is None:
                self.texts.append((open_[-1], page[at:]))
                break
            if found.start() > at:
                self.texts.append((open_[-1], page[at : found.start()]))
            at = found.end()
            name = found[2] or found[5]
            if name is None:
                continue
            name = name.lower()
            if found[1] or found[4]:
                self._close(open_, name)
                continue
            attributes = found[3] if found[2] else found[6]
            if name in VOID:
                if name in ("br", "hr"):
                    self.texts.append((open_[-1], " "))
                continue
            if name in RAW:
                if name in ("svg", "math") and attributes.endswith("/") and not _UNQUOTED.match(attributes[::-1]):
                    continue
                end = None if name in endless else re.compile(f"</{re.escape(name)}[\\s/>]", re.I).search(page, at)
                if end is None:
                    if name not in MAY_STAY_OPEN:
                        break
                    endless.add(name)
                    continue
                at = page.find(">", end.end() - 1) + 1 or n
                continue
            if name == "body":
                self._drop(open_, self._within[0] if self._within else len(open_))
            if name in CLOSES_P:
                self._close_open_p(open_)
            if name in _IMPLIED:
                ends, borders = _IMPLIED[name]
                self._imply(open_, ends, borders)
            self._add(open_[-1], name, attributes)
            if not attributes.endswith("/") or name in CONTAINERS:
                self._open(open_, name)

    def _add(self, parent: int, name: str, attributes: str) -> None:
        out, soft, kind = name in LEFT_OUT, False, ""
        doubt, guarded, classes, ids = False, self._guarded[parent], "", ""
        if attributes and not attributes.isspace():
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values).lower()
                if key in ("class", "id"):
                    kind += " " + value
                    classes, ids = (classes + " " + value, ids) if key == "class" else (classes, ids + " " + value)
                elif key == "role":
                    out |= value.strip() in ROLES
                elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                    out = True
                elif key == "style":
                    out |= "display:none" in value.replace(" ", "")
            words = set(_WORD.findall(_OF_OTHERS.sub("", kind)))
            if name in ("p", "section") or name in HEADINGS or (guarded and name not in ("html", "body", "main", "article")):
                if name not in INLINE and words & (BESIDE | COMMENTS):
                    sure = _sure(classes, ids, name == "p" or name in HEADINGS)
                    soft, doubt = sure, not sure
                    out |= sure and bool(words & (COMMENTS - AMBIGUOUS))
            elif name == "article":
                named = set(_WORD.findall(ids))
                out |= bool(set(_WORD.findall(classes)) & COMMENTS) or (bool(named & COMMENTS) and named <= PARTS)
            else:
                out |= bool(words & COMMENTS) and name not in ("html", "body", "main")
                soft = bool(words & BESIDE) and name not in ("html", "body", "main") and name not in INLINE
        self.doubt.append(doubt)
        self._guarded.append(guarded or (not out and name in ("article", "main")))
        self.tag.append(name)
        self.parent.append(parent)
        self.out.append(out)
        self.soft.append(soft)
        self.kind.append(kind.strip())

    def _open(self, open_: list[int], name: str) -> None:
        place = len(open_)
        self._places.setdefault(name, []).append(place)
        if name in BLOCKS:
            self._blocks.append(place)
            if name != "p":
                self._walls.append(place)
        if name != "html":
            self._within.append(place)
        open_.append(len(self.tag) - 1)

    def _drop(self, open_: list[int], k: int) -> None:
        for i in open_[k:]:
            self._places[self.tag[i]].pop()
        for places in (self._blocks, self._walls, self._within):
            while places and places[-1] >= k:
                places.pop()
        del open_[k:]

    def _close(self, open_: list[int], name: str) -> None:
        """End the innermost open element of this name; an inline one does not end blocks around it."""
        places = self._places.get(name)
        if not places:
            return
        if (name == "p" or name not in BLOCKS) and self._walls and self._walls[-1] > places[-1]:
            return
        self._drop(open_, places[-1])

    def _close_open_p(self, open_: list[int]) -> None:
        if self._blocks and self.tag[open_[self._blocks[-1]]] == "p":
            self._drop(open_, self._blocks[-1])

    def _imply(self, open_: list[int], ends: set[str], borders: set[str]) -> None:
        """End the outermost of these elements inside the innermost border."""
        border = max((self._places[x][-1] for x in borders if self._places.get(x)), default=0)
        first = [p[k] for p in (self._places.get(x, []) for x in ends) if (k := bisect(p, border)) < len(p)]
        if first:
            self._drop(open_, min(first))


def _sure(classes: str, ids: str, plain: bool) -> bool:
    """Whether class and id can only mean something beside the article; for plain text whole class tokens must."""
    marks = (BESIDE | COMMENTS) - AMBIGUOUS
    for token in _OF_OTHERS.sub("", classes).split():
        if token in marks or (not plain and marks.intersection(_WORD.findall(token))):
            return True
    words = set(_WORD.findall(_OF_OTHERS.sub("", ids)))
    return not plain and bool(words & marks) and words <= PARTS


def main_text(page: str | None) -> str:
    """The main text, its blocks joined by one space; empty if there is none."""
    if not page:
        return ""
    tree = _Tree(page)
    n = len(tree.tag)
    tag, parent = tree.tag, tree.parent
    # A container that holds an article is not beside it, whatever its class says; nor is one that holds
    # paragraphs and most of the text, on a page that marks no article.
    holds, inside, paragraphs_in, away = [False] * n, [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        away[i] = away[parent[i]] or tree.out[i]
    in_links, link = [0] * n, [False] * n
    for i in range(1, n):
        link[i] = link[parent[i]] or tag[i] == "a"
    for i, t in tree.texts:
        size = 0 if away[i] else len(t)
        inside[i] += size
        in_links[i] += size if link[i] else 0
    for i in range(n - 1, 0, -1):
        holds[i] |= tag[i] in ("article", "main") and not tree.out[i]
        holds[parent[i]] |= holds[i]
        inside[parent[i]] += inside[i]
        in_links[parent[i]] += in_links[i]
        paragraphs_in[parent[i]] += paragraphs_in[i] + (tag[i] == "p")
    if not holds[0]:
        holds = [2 * x > inside[0] and p > 1 for x, p in zip(inside, paragraphs_in, strict=True)]
    out = [False] * n
    block = [0] * n
    for i in range(1, n):
        p = parent[i]
        out[i] = out[p] or tree.out[i] or (tree.soft[i] and not holds[i])
        if tree.doubt[i]:
            # A heading or paragraph of text stays, however short; other elements need running text.
            long = tag[i] == "p" or tag[i] in HEADINGS or inside[i] >= RUNNING
            out[i] |= not long or in_links[i] > LINKED * inside[i]
        block[i] = i if tag[i] in BLOCKS else block[p]
    texts = [(i, unescape(t) if "&" in t else t) for i, t in tree.texts if not out[i]]
    length, linked = [0] * n, [0] * n
    paragraphs: dict[int, list[str]] = {}
    for i, t in texts:
        size = len(t.strip())
        length[i] += size
        if link[i]:
            linked[i] += size
        paragraphs.setdefault(block[i], []).append(t)
    for i in range(n - 1, 0, -1):
        length[parent[i]] += length[i]
        linked[parent[i]] += linked[i]
    points = [0.0] * n
    own = [0.0] * n  # of paragraphs right in a container
    for b, parts in paragraphs.items():
        words = "".join(parts).strip()
        if not words or tag[b] in HEADINGS:
            continue
        worth = 1 + words.count(",") + min(len(words) / 100, 3.0)
        if len(words) < 25:
            worth = len(words) / 25
        worth *= 1 - linked[b] / max(length[b], 1)
        to = b if tag[b] in CONTAINERS or not b else parent[b]
        own[to] += worth
    # Sums of the paragraphs one, two and more levels below, the last less with each level.
    below, deeper, deepest = [0.0] * n, [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        points[i] = own[i] * _LEVELS[0] + below[i] * _LEVELS[1] + (deeper[i] + deepest[i]) * _LEVELS[2]
        if i:
            below[parent[i]] += own[i]
            deeper[parent[i]] += below[i]
            deepest[parent[i]] += (deeper[i] + deepest[i]) * _FURTHER
    score = [points[i] * (1 - linked[i] / max(length[i], 1)) for i in range(n)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if not score[best]:
        best = next((i for i in range(n) if tag[i] in ("article", "main") and not out[i]), -1)
        if best < 0:
            return ""
    at = best
    last_article = next((i for i in range(best, 0, -1) if tag[i] == "article"), 0)
    while at > 0:
        if tag[at] == "article" or (tag[at] == "main" and last_article <= at):
            best = at
            break
        at = parent[at]
    keep = [False] * n
    top, good = _shared(tree, best, own, linked, length)
    if top != best:
        # What lies between the containers goes along, but for lists of links.
        keep[top] = True
        for i in range(1, n):
            if parent[i] == top and not good[i] and 2 * linked[i] >= length[i] > 0 and tag[i] not in INLINE:
                out[i] = True
        for i in range(1, n):
            out[i] |= out[parent[i]]
        texts = [(i, t) for i, t in texts if not out[i]]
    keep[best] = True
    for i in range(1, n):
        if top == best and parent[i] == parent[best] and i != best and not out[i] and _goes_along(tree, i, best, score, length, linked, paragraphs):
            keep[i] = True
    for i in range(1, n):
        keep[i] |= keep[parent[i]]
    pieces, last = [], -1
    for i, t in texts:
        if keep[i]:
            if block[i] != last:
                pieces.append(" ")
                last = block[i]
            pieces.append(t)
    return " ".join("".join(pieces).split())


def _shared(tree: _Tree, best: int, own: list[float], linked: list[int], length: list[int]) -> tuple[int, list[float]]:
    """The best container or the nearest ancestor with most of the good containers; points of those in each element."""
    n = len(own)
    value = [own[i] * (1 - linked[i] / max(length[i], 1)) for i in range(n)]
    least = GOOD * max(value)
    good = [x if x >= least else 0.0 for x in value]
    for i in range(n - 1, 0, -1):
        good[tree.parent[i]] += good[i]
    at = best
    while at > 0 and tree.tag[best] not in ("article", "main") and good[at] < MOST * good[0]:
        at = tree.parent[at]
    return at, good


def _goes_along(tree: _Tree, i: int, best: int, score, length, linked, paragraphs) -> bool:
    """Whether a sibling of the best container belongs to the article."""
    if tree.tag[best] in ("body", "html") or tree.tag[i] in INLINE:
        return False
    density = linked[i] / max(length[i], 1)
    if tree.tag[best] in ("article", "main"):
        return tree.tag[i] == tree.tag[best] and score[i] >= 0.2 * score[best]
    if score[i] + (0.2 * score[best] if tree.kind[i] and tree.kind[i] == tree.kind[best] else 0) >= max(0.2 * score[best], 1.0):
        return True
    if tree.tag[i] in HEADINGS:
        return i < best and density < 0.5
    return tree.tag[i] == "p" and bool(length[i]) and density < 0.25


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) of every row.

    A null or empty page, and one without any paragraph, has the empty text. Repeated rows stay; other
    columns are not read. Unknown elements do not end a block of text, and reading takes time linear in the page. Broken markup is read as browsers do in the common cases: open paragraphs and
    list items end where the next begins, ends without a begin are passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return slim.mapInArrow(run, PAGES)
