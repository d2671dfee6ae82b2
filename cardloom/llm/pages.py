"""Main text of web pages by tag-path ratios.

A page is read once, tag by tag, into its text blocks in page order.  Each block
has the path of tags (with classes) from the root to it.  Per path,

    text ratio = characters outside links / blocks,   punctuation ratio = marks / blocks,

are aggregated and fused to f = sqrt(text ratio * (1 + punctuation ratio)) * (1 - share of
link characters)^2, and f / (f + ``HALF``) is the path's score, so that short pieces of an article
are not far below its long ones.  Three things follow from it.

* The content root is the deepest single element that holds most of the page's weight
  (characters and punctuation, by score), but no part of an article or main element, and
  not without the headings, paragraphs and elements of its kind beside it.
* Under it the scores are smoothed along the page by a Gaussian window, and each path takes the
  mean over its blocks, times its share of text outside links.
* Paths that reach the share ``LEAST_SHARE`` of the best one are content.

What markup says of an element is a prior: it multiplies weights and scores, but no
element is left out for it as long as nothing on the page scores better.  Menus, page headers, footers,
asides, forms and such roles have a low one, so have elements whose class or id names a notice, advert, sidebar
or reader comments.  A name is read by its last word that says something ("cookie-bar" is about
cookies, "share-price" about a price), and names that hold most of the page's text are names of layout
and say nothing.  What readers wrote goes, however long it is,
where an article or main element or one without such a name holds text beside it.  Headings and lists that are all links
are read by their place among what is kept.  Text that no browser shows has no blocks.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape
from math import exp, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Share of the weight that an element must hold to be entered, share of the best score that makes content, reach of the window in blocks.
ROOT_SHARE, LEAST_SHARE, REACH = 0.8, 0.15, 3
#: The fused ratio of a score of one half; a page without a path of at least FLOOR has no content.
HALF, FLOOR = 4.0, 0.05
_WINDOW = [exp(-((i / 1.5) ** 2) / 2) for i in range(-REACH, REACH + 1)]

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noscript object ol optgroup option p pre search section select summary table tbody td template "
    "tfoot th thead tr ul".split()
)
#: Their text is never read as markup.
_RAW = frozenset("script style title textarea iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("datalist head noscript object optgroup option select svg template".split())
#: Priors of elements by tag (a header's only outside articles), by role, by name.
_BY_TAG = dict.fromkeys("aside button dialog footer header menu nav search".split(), 0.02) | {"form": 0.07, "fieldset": 0.07}
_BY_ROLE = dict.fromkeys("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split(), 0.02) | {"form": 0.07}
BY_NAME, BY_READERS = 0.1, 0.03
#: A start tag of the first closes an open one of the second.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("td", "th", "tr", "tbody", "thead"), "tfoot": ("td", "th", "tr", "tbody", "thead"),
}
#: Their text belongs to that of the elements beside them.
_TOGETHER = frozenset("h1 h2 h3 h4 h5 h6 p".split())
_HEADINGS = _TOGETHER - {"p"}
#: Elements that stand in another one as its parts.
_WITHIN = _TOGETHER | frozenset("ul ol li dl dt dd hgroup".split())
_LISTS = frozenset("ul ol dl menu select table".split())
_BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer share sharing social related recommended widget widgets "
    "toolbar pagination pager skip copyright siteheader pageheader".split()
)
_READERS = frozenset("comment comments commentlist replies reply disqus respond".split())
#: Last words of names that leave their meaning to the word before.
_GENERIC = frozenset(
    "list items item posts post articles stories box wrap wrapper container holder area section block bar inner content text form links link button buttons icons media panel slot unit zone "
    "row column group thread info message trail primary secondary top bottom left right main".split()
)
#: First words of names that say what a page has or lacks, not what an element is.
_LAYOUT = frozenset("with without has no".split())
_WORD, _SIZE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])"), re.compile(r"\d+x\d+")
#: Shares of the text outside links that make a name one of layout: where it is a single word or speaks of readers, and others.
PLAIN_NAME, PART_NAME = 0.8, 0.5
_TAG = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/><]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)(>?)|(!--)|([!?/]))""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_MARKS = re.compile(r"""[.,;:!?…¿¡。，；：！？、«»"“”]""")


@lru_cache(maxsize=1 << 16)
def meaning(name: str) -> str:
    """The word that says what a class or id is about, in lower case; none for names of layout."""
    words = [w.lower() for w in _WORD.findall(_SIZE.sub(" ", name))]
    if not words or words[0] in _LAYOUT:
        return ""
    if len(words) > 1 and words[-2] + words[-1] in _BOILERPLATE:  # side-bar, site-header
        return words[-2] + words[-1]
    while len(words) > 1 and words[-1] in _GENERIC:
        words.pop()
    return words[-1]


class _Element:
    __slots__ = ("tag", "parent", "number", "path", "out", "link", "names", "parts", "chars")

    def __init__(self, tag, parent, number, path, out, link, names=()):
        self.names = names
        self.tag, self.parent, self.number, self.path, self.out, self.link = tag, parent, number, path, out, link
        self.parts: list[str] = []
        self.chars = 0


class _Page:
    """Text blocks of a page: (path, element number, text, characters in links), and each element's parent."""

    def __init__(self, html: str):
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, int, str, int]] = []
        self.parents: list[int] = [-1]
        self.priors: list[float] = [1.0]
        self.named: dict[str, list[int]] = {}  # names that may be boilerplate, their elements but those within others
        self.naming: Counter = Counter()
        self.tags: list[str] = [""]
        self.paths_of: list[int] = [0]
        root = _Element("", None, 0, 0, False, False)
        self.open, self.count = [root], Counter()
        self.link = False
        self._read(html)
        while len(self.open) > 1:
            self._pop()
        self._flush(root)

    def _flush(self, e: _Element) -> None:
        """End the block that an element has been collecting."""
        if e.parts:
            text = " ".join("".join(e.parts).split())
            if text and not e.out:
                self.blocks.append((e.path, e.number, text, min(e.chars, len(text))))
            e.parts, e.chars = [], 0

    def _text(self, text: str) -> None:
        e = self.open[-1]
        if not e.out:
            text = unescape(text) if "&" in text else text
            e.parts.append(text)
            if self.link:
                e.chars += len(text)

    def _pop(self) -> None:
        e = self.open.pop()
        self._flush(e)
        self.count[e.tag] -= 1
        for name in e.names:
            self.naming[name] -= 1
        self.link = e.link

    def _until(self, tags: tuple[str, ...]) -> None:
        """Close the innermost open element of these tags, and all in it, unless a list stands between."""
        if any(self.count[t] > 0 for t in tags):
            for e in reversed(self.open):
                if e.tag in tags:
                    while self.open[-1] is not e:
                        self._pop()
                    self._pop()
                    return self._until(tags) if len(tags) > 1 else None
                if e.tag in _LISTS:
                    return None
        return None

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.link = True
            return
        if tag not in _BLOCKS:
            if tag == "br":
                self._text(" ")
            elif tag in ("button", "svg", "datalist"):
                self._push(tag, attributes)
            return
        while self.open[-1].tag == "p" or tag[0] == "h" and self.open[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._pop()
        if tag in _CLOSES:
            self._until(_CLOSES[tag])
        if tag in _VOID:
            self._flush(self.open[-1])
            return
        self._flush(self.open[-1])
        self._push(tag, attributes)

    def _push(self, tag: str, attributes: str) -> None:
        above = self.open[-1]
        out, label, names, prior = above.out or tag in _UNSEEN, tag, set(), self.priors[above.number]
        if tag != "header" or not (self.count["article"] > 0 or self.count["main"] > 0):
            prior *= _BY_TAG.get(tag, 1.0)
        if attributes and not out:
            given: dict[str, str] = {}
            for m in _ATTRIBUTE.finditer(attributes):
                given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            out = "hidden" in given or given.get("aria-hidden", "").lower() == "true"
            prior *= _BY_ROLE.get(given.get("role", "").lower(), 1.0)
            own = given.get("class", "").split()
            if own:
                label = f"{tag}.{' '.join(own)}"
            if tag not in ("body", "html", "article", "main"):
                names.update(x for x in own + given.get("id", "").split() if meaning(x) in _BOILERPLATE or meaning(x) in _READERS)
        key = (above.path, label)
        path = self.paths.setdefault(key, len(self.paths) + 1)
        self.parents.append(above.number)
        self.priors.append(prior)
        self.tags.append(tag)
        self.paths_of.append(path)
        self.open.append(_Element(tag, above, len(self.parents) - 1, path, out, self.link, names))
        self.count[tag] += 1
        for name in names:
            if not self.naming[name]:
                self.named.setdefault(name, []).append(len(self.parents) - 1)
            self.naming[name] += 1

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        elif tag == "p" and self.open[-1].tag != "p":
            self._flush(self.open[-1])
        elif self.count[tag] > 0:
            while self.open[-1].tag != tag:
                self._pop()
            self._pop()
        elif tag == "br":
            self._text(" ")

    def _read(self, html: str) -> None:
        at, size, lower = 0, len(html), None
        while at < size:
            m = _TAG.search(html, at)
            if m is None:
                self._text(html[at:])
                return
            if m.start() > at:
                self._text(html[at : m.start()])
            at = m.end()
            if m[2] is not None:
                tag = m[2].lower()
                if not m[4]:  # a quote that never ends, or a second "<" at the end of the text
                    close = html.find(">", at)
                    at = size if close < 0 else close + 1
                if m[1]:
                    self._end(tag)
                elif tag in _RAW:
                    lower = lower or _lowered(html)
                    close = lower.find(f"</{tag}", at)
                    close = html.find(">", close) if close >= 0 else -1
                    at = size if close < 0 else close + 1
                else:
                    self._start(tag, m[3])
            else:
                close = html.find("-->" if m[5] else ">", at - 2 if m[5] else at)
                at = size if close < 0 else close + (3 if m[5] else 1)


def _name_priors(page: _Page) -> None:
    """Lower the priors of elements whose class or id is boilerplate and no name of layout, with all they hold."""
    if not page.named:
        return
    parents, priors = page.parents, page.priors
    readers = {n for n in page.named if meaning(n) in _READERS}
    of_readers = {e for n in readers for e in page.named[n]}
    of_others = {e for n in page.named if n not in readers for e in page.named[n]}
    article, inside, called = ([False] * len(parents) for _ in range(3))  # of an article, of what readers wrote, of another name
    for e in range(1, len(article)):
        article[e] = article[parents[e]] or page.tags[e] in ("article", "main")
        inside[e] = inside[parents[e]] or e in of_readers
        called[e] = called[parents[e]] or e in of_others
    beside = [e for _, e, text, linked in page.blocks if not inside[e] and priors[e] == 1 and linked < len(text)]
    apart = any(article[e] or not called[e] for e in beside)
    single = {n for n in page.named if n in readers or len(_WORD.findall(n)) == 1}
    lowered = [1.0] * len(parents)
    for names, share in ((single, PLAIN_NAME), (page.named.keys() - single, PART_NAME)):
        if not names:
            continue
        held = [0.0] * len(parents)
        for _, number, text, linked in page.blocks:
            held[number] += (len(text) - linked) * priors[number] * (lowered[number] == 1)
        for e in range(len(held) - 1, 0, -1):
            held[parents[e]] += held[e]
        own = [1.0] * len(parents)
        for name in names:
            if name in readers and apart or sum(held[e] for e in page.named[name]) < share * held[0]:
                for e in page.named[name]:
                    own[e] *= 0 if name in readers and apart else BY_READERS if name in readers else BY_NAME
        for e in range(1, len(own)):
            own[e] *= own[parents[e]]
            lowered[e] *= own[e]
    page.priors = [a * b for a, b in zip(priors, lowered)]


def _lowered(html: str) -> str:
    """Lower case of A-Z only, so that positions stay."""
    return html.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def main_blocks(html: str | None) -> list[str]:
    """Content blocks of a page in page order."""
    page = _Page(html or "")
    _name_priors(page)
    if not page.blocks:
        return []
    # ratios of each path
    totals: dict[int, list[float]] = {}
    marks = [len(_MARKS.findall(text)) for _, _, text, _ in page.blocks]
    for (path, _, text, linked), n in zip(page.blocks, marks):
        t = totals.setdefault(path, [0, 0, 0, 0])
        t[0] += 1
        t[1] += len(text)
        t[2] += n
        t[3] += linked
    fused = {p: sqrt(max(chars - linked, 0) / n * (1 + k / n)) * (1 - linked / chars) ** 2 for p, (n, chars, k, linked) in totals.items()}
    ratio = {p: f / (f + HALF) for p, f in fused.items()}
    prior = page.priors
    # the content root: enter the one child that holds most of the weight, while it is not itself a block
    weight = [0.0] * len(page.parents)
    for (path, number, text, linked), n in zip(page.blocks, marks):
        weight[number] += (len(text) - linked + 10 * n) * ratio[path] * prior[number]
    best = max(prior[number] for number in {b[1] for b in page.blocks})
    plain = [b for b in page.blocks if prior[b[1]] == best]  # blocks that no prior speaks against
    holds = {number for _, number, _, _ in plain}
    for e in range(len(weight) - 1, 0, -1):
        weight[page.parents[e]] += weight[e]
    heaviest: dict[int, int] = {}
    for e in range(1, len(weight)):
        up = page.parents[e]
        if up not in heaviest or weight[e] > weight[heaviest[up]]:
            heaviest[up] = e
    root = 0
    beside = {page.parents[number] for _, number, text, linked in plain if linked < len(text) and page.tags[number] in _TOGETHER}
    kinds = Counter((page.parents[e], page.paths_of[e]) for e in range(1, len(weight)) if weight[e] > 0 and prior[e] >= best)
    whole = 0  # the innermost article or main element
    while (child := heaviest.get(root)) is not None and root not in holds and child not in holds and weight[child] >= ROOT_SHARE * weight[root]:
        if page.tags[root] == "article" or root in beside or kinds[root, page.paths_of[child]] > 1:
            break
        root = child
        if page.tags[root] in ("article", "main"):
            whole = root
    root = whole or root
    inside = [False] * len(weight)
    inside[root] = True
    for e in range(root + 1, len(weight)):
        inside[e] = inside[page.parents[e]]
    own = [b for b in page.blocks if inside[b[1]]]
    # smoothed along the page, mean of each path, threshold
    sums: dict[int, list[float]] = {}
    for i, block in enumerate(own):
        total = norm = 0.0
        for j in range(max(0, i - REACH), min(len(own), i + REACH + 1)):
            w = _WINDOW[j - i + REACH]
            total += w * ratio[own[j][0]]
            norm += w
        smooth = sums.setdefault(block[0], [0.0, 0])
        smooth[0] += total / norm
        smooth[1] += 1
    score = {p: total / n * (1 - totals[p][3] / totals[p][1]) ** 2 for p, (total, n) in sums.items()}
    top = max((score[path] * prior[number] for path, number, _, _ in own), default=0.0)
    kept = [top >= FLOOR and score[path] * prior[number] >= LEAST_SHARE * top for path, number, _, _ in own]
    return [block[2] for block, stays in zip(own, _with_linked(page, own, kept, best, whole > 0)) if stays]


def _with_linked(page: _Page, own: list[tuple], kept: list[bool], best: float, whole: bool) -> list[bool]:
    """kept, and the linked headings and lists of links that belong to what is kept.

    The path of such blocks says nothing, as its text is all of links; their place does: they stand in the very element that
    holds content, a heading before some of it, a list after some of it, and before some more unless the root is an article or main element.
    """

    def home(e: int) -> int:
        while e and page.tags[e] in _WITHIN:
            e = page.parents[e]
        return e

    first: dict[int, int] = {}
    last: dict[int, int] = {}
    homes = [home(number) for _, number, _, _ in own]
    for i, stays in enumerate(kept):
        if stays:
            first.setdefault(homes[i], i)
            last[homes[i]] = i
    out = list(kept)
    for i, (_, number, text, linked) in enumerate(own):
        if not kept[i] and 2 * linked > len(text) and page.priors[number] == best and homes[i] in first:
            if page.tags[number] in _HEADINGS:
                out[i] = i < last[homes[i]]
            else:
                out[i] = first[homes[i]] < i and (whole or i < last[homes[i]])
    return out


def main_text(html: Column | str) -> Column:
    """Main text of an html column: white space within a block is one space, blocks are joined by a line feed.

    Null, empty and textless pages give an empty string.  Character references are
    decoded.  Unclosed and misplaced tags, comments and quotes are read as browsers do,
    as far as that decides which block a text is in; a page is read in linear time.
    """

    @arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array(["\n".join(main_blocks(x.as_py())) for x in pages], pa.string())

    return extracted.asNondeterministic()(html)  # so that it runs once, however often it is read


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """pages with the html column replaced by the main text; an existing column of the text's name is replaced.

    Every row stays, repeated ones too; other columns are passed on.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html, text)]
    return pages.select(*kept, main_text(F.col(f"`{html}`")).alias(text))
