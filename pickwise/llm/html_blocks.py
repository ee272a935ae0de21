"""Flat text blocks of a web page, with the features by which they are told apart.

A small forgiving scanner walks over tags, comments and raw elements once, whatever is unclosed.
Block elements end a block; inline elements, formulas, and what is dropped inside a line do not. Of the
open elements only those are counted that matter: containers of page furniture, articles, links,
paragraphs and headings. An element with a cue in its class, id or role is no verdict on what it holds:
a block gets the size of the innermost such element, its share of the page, and whether it holds the
place where the main text begins, and the tree weighs these with the other features.
"""

from __future__ import annotations

import html
import itertools
import re
from collections import Counter

# Element names and cues in class, id and role.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark "
    "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
    "annotation annotation-xml".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template xmp noembed noframes".split())
DROPPED = set(
    "head select option button svg object canvas audio video datalist map annotation annotation-xml".split()
)
#: Elements that may stand in a line of text, which goes on behind them.
WITHIN_LINES = INLINE | RAW | DROPPED - {"head"}
FURNITURE = set("nav header footer aside menu dialog".split())
PARAGRAPHS = set("p blockquote pre".split())
ARTICLES = set("article main".split())
CUES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion "
    "banner sidebar menu nav navbar navigation navigational breadcrumb breadcrumbs comment comments "
    "cookie cookies consent gdpr notice notices alert newsletter subscribe subscription share sharing "
    "social related recommended footer header masthead popup modal widget login signin signup search "
    "toolbar pagination pager complementary contentinfo dialog disqus respond reply replies copyright "
    "legal disclaimer skip hidden paywall".split()
)
#: Beginnings of class names that tell of a page's layout or topics, as in no-sidebar and tag-social.
LAYOUT = set("no not has have with without tag category type format status".split())
#: An element, and a cue, that is no furniture inside an article.
_ARTICLE_HEADER = "header"

_NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TOKEN = re.compile(r"[a-z]+")
_HEADING = re.compile(r"h[1-6]$")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

FEATURES = (
    "words", "link_density", "words_before", "density_before", "words_after", "density_after",
    "furniture", "cue_apart", "cue_at_main", "cue_words", "cue_share", "article", "heading", "paragraph", "titled",
)


class _Scanner:
    def __init__(self, text: str):
        self.text = text
        self.blocks: list[tuple] = []
        self.stack: list[tuple[str, tuple[str, ...], bool]] = []
        self.open: Counter = Counter()
        self.state: Counter = Counter()
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.places: dict[str, int] = {}
        #: First block and the block after the last one of each element with a cue, of each article.
        self.ranges: dict[str, list[list[int]]] = {"cue": [], "article": []}
        self.open_ranges: dict[str, list[int]] = {"cue": [], "article": []}
        #: Open elements by name that stand inside a dropped one.
        self.within_dropped: Counter = Counter()

    def upcoming(self, mark: str, at: int) -> int:
        """The next place of ``mark`` from ``at`` on, the page's length if there is none.

        Places asked for never go back, so all searches for a mark together read the page once.
        """
        if self.places.get(mark, -1) < at:
            found = self.text.find(mark, at)
            self.places[mark] = len(self.text) if found < 0 else found
        return self.places[mark]

    def tag_end(self, at: int) -> int:
        """Index of the ``>`` of the tag that begins at ``at``; quoted ones do not count; -1 if none."""
        size = len(self.text)
        while True:
            end = self.upcoming(">", at)
            quote, mark = min((self.upcoming(m, at), m) for m in ('="', "='"))
            if end == size:
                return -1
            if quote > end:
                return end
            closing = self.upcoming(mark[1], quote + 2)
            if closing == size:
                return end
            at = closing + 1

    def flush(self) -> None:
        if not self.parts:
            return
        block = " ".join(html.unescape("".join(self.parts)).split())
        if block:
            words = block.count(" ") + 1
            linked = len(html.unescape(" ".join(self.linked)).split()) if self.linked else 0
            state, cues = self.state, self.open_ranges["cue"]
            self.blocks.append(
                (
                    block, words, min(1.0, linked / words), state["furniture"] > 0, cues[-1] if cues else -1,
                    state["article"] > 0, state["heading"] > 0, state["paragraph"] > 0, state["title"] > 0,
                )
            )
        self.parts, self.linked = [], []

    def marks(self, name: str, attributes: str) -> tuple[str, ...]:
        """What an open element of this kind counts as."""
        out = []
        if name in FURNITURE and not (name == _ARTICLE_HEADER and self.state["article"]):
            out.append("furniture")
        elif name in ARTICLES:
            out.append("article")
        elif name in DROPPED:
            out.append("dropped")
        elif name == "a":
            out.append("link")
        elif _HEADING.match(name):
            out += ["heading", "title"] if name == "h1" else ["heading"]
        elif name in PARAGRAPHS:
            out.append("paragraph")
        cued = name == "form"
        if attributes and name not in ("body", "html"):
            for key, a, b, c in _ATTRIBUTE.findall(attributes):
                value = (a or b or c).lower()
                if key.lower() == "style":
                    if _INVISIBLE.search(value):
                        out.append("dropped")
                else:
                    cued = cued or self.is_cue(value)
            if _HIDDEN.search(attributes):
                out.append("dropped")
        if cued:
            out.append("cue")
        return tuple(out)

    def is_cue(self, value: str) -> bool:
        """Whether a class, id or role of an element to open has a cue that is not about layout or topics."""
        for label in value.split():
            tokens = _TOKEN.findall(label)
            if tokens and tokens[0] not in LAYOUT:
                found = CUES.intersection(tokens)
                if found and not (self.state["article"] and found == {_ARTICLE_HEADER}):
                    return True
        return False

    def push(self, name: str, marks: tuple[str, ...]) -> None:
        inside = self.state["dropped"] > 0
        self.stack.append((name, marks, inside))
        self.open[name] += 1
        self.within_dropped[name] += inside
        self.state.update(marks)
        for kind, open_ones in self.open_ranges.items():
            if kind in marks:
                open_ones.append(len(self.ranges[kind]))
                # An article that has a cue, as a reader's comment may, is not the page's article.
                main = kind == "cue" or "cue" not in marks and not self.state["furniture"]
                self.ranges[kind].append([len(self.blocks), len(self.blocks) if not main else -1])

    def pop_to(self, name: str) -> None:
        """Close the innermost element of this name and all inside it; nothing if none is open."""
        if not self.open[name]:
            return
        while True:
            last, marks, inside = self.stack.pop()
            self.open[last] -= 1
            self.within_dropped[last] -= inside
            self.state.subtract(marks)
            for kind, open_ones in self.open_ranges.items():
                if kind in marks:
                    found = self.ranges[kind][open_ones.pop()]
                    if found[1] < 0:
                        found[1] = len(self.blocks)
            if last == name:
                return

    def add(self, piece: str) -> None:
        if piece and not self.state["dropped"]:
            self.parts.append(piece)
            if self.state["link"] > 0:
                self.linked.append(piece)

    def run(self) -> list[tuple]:
        text, at, size = self.text, 0, len(self.text)
        while at < size:
            begin = text.find("<", at)
            if begin < 0:
                self.add(text[at:])
                break
            follower = text[begin + 1 : begin + 2]
            if not (follower.isascii() and follower.isalpha()) and follower not in ("/", "!", "?"):
                self.add(text[at : begin + 1])
                at = begin + 1
                continue
            self.add(text[at:begin])
            if text.startswith("<!--", begin):
                end = text.find("-->", begin + 4)
                at = size if end < 0 else end + 3
                continue
            found = _NAME.match(text, begin + 1)
            end = self.tag_end(begin + 1)
            if end < 0:
                break
            at = end + 1
            if not found:
                continue
            name = found[1].lower()
            if follower == "/":
                if name not in WITHIN_LINES and not self.within_dropped[name]:
                    self.flush()
                self.pop_to(name)
                continue
            if name == "br":
                self.add(" ")
                continue
            if name not in WITHIN_LINES and not self.state["dropped"]:
                self.flush()
                if self.open["p"]:
                    self.pop_to("p")
                if self.stack and self.stack[-1][0] == name and name in ("li", "td", "th", "tr", "dt", "dd", "option"):
                    self.pop_to(name)
            elif name == "a":
                self.pop_to("a")
            if name in RAW:
                close = _RAW_END[name].search(text, at)
                end = text.find(">", close.start()) if close else -1
                if end < 0:
                    break
                at = end + 1
                continue
            if name in VOID or text[end - 1] == "/" and name in INLINE:
                continue
            self.push(name, self.marks(name, text[found.end() : end]))
        self.flush()
        return self.blocks


def _main_place(found: list[tuple], ranges: dict[str, list], before: list[int]) -> tuple[int, bool]:
    """The block at which the main text begins, as far as markup tells, and whether that is a title.

    It is the first h1 in an article; else in the article with most words the first block without
    a cue inside the article; else the first h1, one without a cue around it first; else the block with most words outside links, which
    count half within a cue.
    """
    titles = [n for n, block in enumerate(found) if block[8] and not block[3]]
    for n in titles:
        if found[n][5] and found[n][4] < 0:
            return n, True
    for n in titles:
        if found[n][5]:
            return n, True
    sized = [(before[b] - before[a], -a, b) for a, b in ranges["article"] if b > a]
    if sized:
        _, a, b = max(sized)
        around = [c[0] <= -a and c[1] >= b for c in ranges["cue"]]
        return next((n for n in range(-a, b) if found[n][4] < 0 or around[found[n][4]]), -a), False
    for n in titles:
        if found[n][4] < 0:
            return n, True
    if titles:
        return titles[0], True
    plain = [
        (0 if furniture else (1 - density) * words / (1 if cue < 0 else 2), -n)
        for n, (_, words, density, furniture, cue, *_) in enumerate(found)
    ]
    return -max(plain)[1], False


def blocks(page: str) -> list[tuple[str, tuple[float, ...]]]:
    """The text blocks of a page in order, each with its ``FEATURES``.

    Features of neighbours are those of the blocks before and after; 0 words at either end.
    """
    scanner = _Scanner(page)
    found = scanner.run()
    if not found:
        return []
    size = len(found)
    before = [0, *itertools.accumulate(0 if furniture else words for _, words, _, furniture, *_ in found)]
    ranges = {
        kind: [(a, size if b < 0 else b) for a, b in some] for kind, some in scanner.ranges.items()
    }
    main, is_title = _main_place(found, ranges, before)
    out = []
    for n, (block, words, density, furniture, cue, article, heading, paragraph, _) in enumerate(found):
        previous = found[n - 1][1:3] if n else (0, 0.0)
        following = found[n + 1][1:3] if n + 1 < size else (0, 0.0)
        about = (False, False, 0, 0.0)
        if cue >= 0:
            a, b = ranges["cue"][cue]
            held = before[b] - before[a]
            about = (not a <= main < b, a <= main < b, held, held / max(1, before[-1]))
        out.append(
            (
                block,
                (
                    words, density, *previous, *following, furniture, *about, article, heading,
                    paragraph, is_title and n >= main,
                ),
            )
        )
    return out
