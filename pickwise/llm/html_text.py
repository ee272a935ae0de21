"""Main text of web pages: flat text blocks classified by a decision tree.

Every block has its word count and link density, those of its two neighbours, flags of what it stands
in, and the size of an element around it whose class, id or role hints at furniture. A small decision tree (Gini impurity) is trained on the labelled blocks of the example
pages below, which takes milliseconds on the driver and always gives the same tree. The kept blocks
are joined in page order.

Null and empty pages give an empty text. Rows are independent, so repeated rows give repeated
results; an empty table gives no rows; other columns are ignored. The scan of a page is linear in
its length, whatever is left unclosed.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.html_blocks import blocks
from pickwise.llm.tables import small_batches
from pickwise.llm.words import row_blocks

#: What joins the kept blocks.
BETWEEN = "\n\n"
MAX_DEPTH = 8
#: Fewest blocks on either side of a split.
LEAST_BLOCKS = 6
#: Times that each example page is used, each time with other numbers of words in its lines.
VARIATIONS = 8

_LONG = "this is a sentence of the main text that goes on for quite a while and has no link in it at all. "
_OTHER = "readers wrote that they had seen the same thing in another town and did not like it very much either. "
_MENU = "<ul><li><a href=/>Start</a></li><li><a href=/n>All news</a></li><li><a href=/s>Sport</a></li></ul>"
#: Labelled pages: blocks that begin with § are main text. Together some 1,000 blocks.
EXAMPLES = [
    f"<head><title>x</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
    f"<article><h1>§A title</h1><p>§{_LONG * 2}</p><p>§Short one.</p><p>§{_LONG}</p><p>§Yes.</p></article>"
    f"<footer>Copyright of the owner, all rights reserved. <a href=/i>Imprint</a></footer></body>",
    "<body><nav><a href=/>A</a> <a href=/b>B</a></nav><div class=ad>Buy this now.</div><article><h1>§One</h1><p>§Two"
    "<p>§Three words here</article><footer>All rights reserved and a rather long line of other legal words that nobody reads</footer>",
    f"<body><header><div>The site</div><p>A slogan that has some more words than usual in it</p></header><main><h2>§Heading</h2>"
    f"<p>§{_LONG}</p><ul><li>§a point of the list</li><li>§another point</li></ul><blockquote>§{_LONG}</blockquote></main>"
    f"<aside><h3>Read more</h3><p>{_LONG}</p></aside>",
    f"<body><div id=menu><a href=1>One</a><a href=2>Two</a></div><div><h1>§The headline of it</h1><p>§{_LONG * 3}</p><p>§{_LONG}</p>"
    f"<p>§And a short close.</p><p>§{_LONG * 2}</p></div><div class=comments><p>{_LONG}</p><p>First!</p></div>",
    f"<body><div>Sign in</div><div><a href=1>Start</a> | <a href=2>Shop</a> | <a href=3>Help</a></div><p>§{_LONG * 2}</p><p>§{_LONG}</p>"
    f"<div><a href=4>Next story</a></div><div>Page 1 of 9</div>",
    f"<body><article><p>§{_LONG}</p><ul><li><a href=1>Another story</a></li><li><a href=2>And one more story</a></li></ul>"
    f"<div class='related'><p>{_LONG}</p></div><p>§{_LONG}</p><p>§With <a href=3>one link</a> in a sentence of some length.</p>"
    f"<form><p>Your address please</p></form><div class='share'>Tell your friends</div></article>",
    f"<body><div class='cookie-banner'><p>{_LONG}</p></div><div><p>§{_LONG}</p><p>§{_LONG}</p></div><form><label>Name</label>{_LONG}</form>",
    f"<body><article><header><h1>§Title in a header</h1></header><p>§{_LONG}</p><p>§x</p></article><section id=comments><p>{_LONG * 2}</p>"
    f"<p>I agree</p></section>",
    "<body><div>Menu</div><div>Login</div><div>42</div><footer>x</footer>",
    "<body><nav>Menu of the page</nav><article><p>§Only this.</p></article><footer>y</footer>",
    f"<body><article><div class=sidebar>{_LONG}</div><div class='ad'>Buy</div><p>§{_LONG}</p><p>§ok then</p><aside>{_LONG}</aside></article>",
    f"<body><nav>{_LONG}</nav><article><h1>§{_LONG}</h1><p>§one two three</p></article><div class=notice>{_LONG}</div>",
    f"<body><aside><p>{_LONG * 2}</p></aside><div><h1>§Title</h1><p>§{_LONG * 3}</p><p>§Fish and so on</p><p>§{_LONG * 3}</p></div>"
    f"<form><p>{_LONG * 2}</p></form><footer>{_LONG}</footer>",
    f"<body><nav><a href=1>One</a><a href=2>Two</a></nav><div class=promo>{_LONG * 2}</div><div><h2>§A longer title of it</h2><p>§{_LONG}</p>"
    f"<p>§Tiny.</p><p>§{_LONG * 2}</p><h2>§Part two</h2><p>§{_LONG}</p><p>§Done.</p><p>§{_LONG}</p></div><div>Login</div><div>1 of 3</div>",
    f"<body><div>Start</div><div>Shop</div><div>Help</div><h1>§The title</h1><p>§{_LONG * 2}</p><p>§{_LONG}</p><div>Up</div><div>Top of page</div>"
    f"<div>Site map</div>",
    f"<body><div><a href=1>All stories</a></div><h1>§Headline</h1><p>§{_LONG}</p><p>§Short again</p><p>§{_LONG}</p><div><a href=1>Back</a></div>"
    f"<div>Log in</div>",
    f"<body><nav>Menu</nav><article><h1>§Title</h1><p>§{_LONG}</p><p>§One.</p><p>§Two.</p><p>§Three.</p><p>§A b c</p><p>§{_LONG}</p></article>",
    f"<body><main><p>§a</p><p>§b</p><p>§c</p><p>§d e</p><p>§{_LONG}</p><p>§f</p></main>",
    f"<body><article><p>§{_LONG}</p><p>§End.</p></article><footer>x</footer>",
    "<body><article><p>§Alone here</p></article>",
    "<body><article><h1>§Title</h1><p>§word</p><p>§word</p><p>§word</p></article><div class=ad>word</div>",
    f"<body><div>Start</div><div>Shop</div><p>§{_LONG}</p><p>§{_LONG}</p>",
    "<body><article><h1>§Word</h1><p>§Word.</p></article><div class=comment>Nice</div><aside>More</aside>",
    # Cues on an element around the whole article, with comments that are shorter or longer than it.
    f"<body><nav>{_MENU}</nav><div class='page sidebar'><article><h1>§Title</h1><p>§{_LONG}</p><p>§Short.</p></article></div>"
    f"<div class='comments'><p>{_OTHER}</p></div><footer>x</footer>",
    f"<body><div class=widget><article><h2>§The title</h2><div>§{_LONG}</div><div>§Short line</div></article></div><div class=ad>Buy</div>",
    f"<body><div id=search-results><article><h1>§Two words</h1><p>§{_LONG * 2}</p><p>§End</p></article></div><div class=social>Tell all</div>",
    f"<body><div class='social wrapper'><h1>§A headline</h1><p>§{_LONG}</p><p>§And so on</p></div><div class='comment-list'><p>{_OTHER * 3}</p>"
    f"<p>No.</p><p>{_OTHER}</p></div>",
    f"<body><form id=page><h1>§The head</h1><p>§{_LONG}</p><p>§{_LONG * 2}</p></form><form><p>Send us your thoughts about this</p></form>",
    f"<body><div class=widget><p>§{_LONG * 2}</p><p>§{_LONG}</p></div><div class=ad><p>Buy it</p></div>",
    f"<body><form><article><h1>§The head</h1><p>§{_LONG}</p></article><div class=newsletter><p>{_OTHER}</p></div></form>",
    # Titles in a header of the article, banners with a heading, comments inside and as articles.
    f"<body><article><div class=banner><h1>§The title of it</h1></div><p>§{_LONG}</p><div class=comments><p>{_OTHER}</p><p>Me too</p></div></article>",
    f"<body><article><div class=promo><h1>§Title</h1><p>§A line below the title</p></div><p>§{_LONG}</p><p>§{_LONG}</p></article>",
    f"<body><div class=banner><h1>The site</h1></div><article><h2>§Title</h2><p>§{_LONG}</p></article><section id=comments>"
    f"<article class=comment><p>{_OTHER * 2}</p></article><article class=comment><p>Good</p></article></section>",
    f"<body><div class=masthead><h1>Daily paper</h1></div><p>§{_LONG}</p><p>§{_LONG * 2}</p><p>§Short</p>",
    f"<body><main><article><h1>§Title</h1><p>§{_LONG}</p></article><section class=comments><p>{_OTHER * 3}</p><p>{_OTHER}</p></section></main>",
    # Paragraphs that are links, against lists of links, in and outside of articles.
    f"<body><article><h1>§Title</h1><p>§{_LONG}</p><p><a href=1>§The whole of this paragraph is a link to the report</a></p><p>§{_LONG}</p></article>",
    f"<body><article><p>§{_LONG}</p><p><a href=1>§Read the report of the board about it</a></p><p>§{_OTHER}</p><p>§Yes.</p></article>",
    f"<body><article><p>§{_LONG}</p><p>§{_OTHER}</p><p><a href=1>Story one</a></p><p><a href=2>Story two</a></p><p><a href=3>Story three</a></p></article>",
    f"<body><article><p>§{_LONG}</p><p><a href=1>A story of today</a></p><p><a href=2>A story of last week</a></p><p>§{_OTHER}</p></article>",
    f"<body><h1>§Title</h1><p>§{_LONG}</p><p><a href=1>§All of this paragraph is a link to it</a></p><p>§{_LONG}</p><div><a href=1>Back</a></div>",
    f"<body><div><p><a href=1>One</a></p><p><a href=1>Two</a></p><p><a href=1>Three</a></p></div><h1>§Title</h1><p>§{_LONG}</p>",
    # Short articles without an element of that name.
    f"<body><nav>{_MENU}</nav><h1>§Title</h1><p>§A short text.</p><footer>All rights reserved</footer>",
    f"<body><div id=nav>{_MENU}</div><div class=text><h1>§A title</h1><p>§Just one line of text here.</p><p>§Bye.</p></div><div>Contact</div>",
    f"<body><div><a href=1>Start</a></div><p>§A few words only.</p><div>Imprint</div><footer>x</footer>",
    f"<body>{_MENU}<h2>§Notice of the day</h2><p>§The office stays shut on Monday.</p><p>§Come on Tuesday.</p><div>Top</div>",
    "<body><div>Login</div><h1>§Title</h1><div>§The text stands in an element without a meaning.</div><div>§It has two such lines, of some words each.</div>"
    "<div>Help</div><div>Site map</div>",
    f"<body><div>Start</div><div>Shop</div><div>§{_LONG}</div><div>§A line that is short, in between.</div><div>§{_LONG}</div><div>Up</div>",
    "<body><p>§One line.</p>", "<body><p>§One line of a few more words.</p><p>§Two.</p>", "<body><div>Menu</div><div>Shop now</div>",
    # Plain lines of an article that are no paragraphs.
    f"<body><article><h1>§Title</h1><p>§{_LONG}</p><ul><li>§one</li><li>§two words</li><li>§three such words</li><li>§four of the words</li></ul>"
    f"<table><tr><td>§Year</td><td>§1999</td><td>§five words in a cell</td></tr></table><div>§A line of text</div><div>§{_LONG}</div><div>§so</div></article>",
    f"<body><main><div>§{_LONG}</div><ol><li>§first of them</li><li>§second</li></ol><div>§{_OTHER}</div><ul><li><a href=1>To another page</a></li>"
    f"<li><a href=2>{_OTHER}</a></li></ul></main><div>{_OTHER}</div>",
    f"<body><article><dl><dt>§A term</dt><dd>§what it means</dd><dt>§Term</dt><dd>§{_LONG}</dd></dl><div>§Three words here</div><div><a href=1>Next one</a></div></article>",
    f"<body><article><h1>§Title</h1><p>§{_LONG}</p><ul><li>§one</li><li>§two words</li></ul></article>",
    f"<body><nav>{_MENU}</nav><article><h1>§Title</h1><table><tr><td>§Cost</td><td>§40</td></tr></table><div>§{_LONG}</div></article>",
    f"<body><article><h1>§Title</h1><div>§A first line</div><div>§Rope, nails and two boards</div><div>§{_LONG}</div><div>§Bye</div></article>",
    # Links as paragraphs: one between texts is text, several in a row are a list.
    f"<body><article><p>§{_LONG}</p><p><a href=1>§See the report</a></p><p>§{_OTHER}</p></article>",
    f"<body><article><p>§{_LONG}</p><p>§{_OTHER}</p><p><a href=1>{_OTHER}</a></p><p><a href=2>A headline of another story of this day</a></p>"
    f"<p><a href=3>{_LONG}</a></p></article>",
    f"<body><article><p>§{_LONG}</p><p>§Yes.</p><p><a href=1>§Read the report of the board</a></p><p>§{_OTHER}</p><p>§No.</p><p><a href=1>§The map</a></p><p>§So</p></article>",
    f"<body><h1>§Head</h1><p>§{_LONG}</p><p>§Yes.</p><p><a href=1>§Read it all in the report of the board</a></p><p>§{_OTHER}</p><div><a href=1>Back to the list</a></div>",
    *(
        f"<body>{opening}<h1>§Head</h1><p>§{_LONG}</p><p>§{first}</p>{links}<p>§{last}</p><p>§{_OTHER}</p><p><a href=1>§{title}</a></p><p>§{last}</p>{closing}"
        for opening, closing in (("<article>", "</article>"), ("<div>", "</div>"))
        for first, last in (("No.", _LONG), (_OTHER, "So."), ("Yes.", "So."))
        for title in ("The map", "Read it all in the report of the board")
        for links in (f"<p><a href=1>{title}</a></p>" * 3, f"<p><a href=1>{_OTHER}</a></p><p><a href=1>{title}</a></p>", "")
    ),
    f"<body><h1>§Head</h1><p>§{_LONG}</p><p><a href=1>§See the map</a></p><p>§{_OTHER}</p><p><a href=1>{_OTHER}</a></p><p><a href=1>More of the same</a></p>",
    # Advertisements and notices without paragraphs, and boxes about the page.
    *(
        f"<body><nav>{_MENU}</nav><div class={label}>{text}</div>{opening}<h1>§Title of it</h1><p>§{_LONG}</p><div>§{_LONG}</div><p>§Short.</p>{closing}"
        f"<div class={label}>{text}</div><div class='{label} box'><div>{text}</div><p>{text}</p></div><footer>{text}</footer>"
        for label in ("ad", "notice", "sidebar", "newsletter")
        for text in (_OTHER, "Buy now", "Your data is safe with us")
        for opening, closing in (("<article>", "</article>"), ("<div>", "</div>"))
    ),
    # Small heads with a cue around the title.
    *(
        f"<body><article><div class='{label}'><h1>§{title}</h1></div><p>§{_LONG}</p><div class={label}><p>{_OTHER}</p></div><div class={label}>Ad</div></article>"
        for label in ("banner", "masthead box", "alert")
        for title in ("Title", "A few words more", "The whole of a rather long title of the text")
    ),
]


class Tree:
    """A decision tree on numeric features, grown by Gini impurity."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = MAX_DEPTH):
        self.share = float(labels.mean())
        self.split: tuple[int, float] | None = None
        if depth == 0 or self.share in (0.0, 1.0):
            return
        best = (self._impurity(labels) - 1e-9, -1, 0.0)
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for cut in (values[:-1] + values[1:]) / 2:
                left = rows[:, feature] <= cut
                if not LEAST_BLOCKS <= left.sum() <= len(left) - LEAST_BLOCKS:
                    continue
                score = left.mean() * self._impurity(labels[left])
                score += (1 - left.mean()) * self._impurity(labels[~left])
                if score < best[0] - 1e-12:
                    best = (score, feature, float(cut))
        if best[1] >= 0:
            left = rows[:, best[1]] <= best[2]
            self.split = best[1:]
            self.left = Tree(rows[left], labels[left], depth - 1)
            self.right = Tree(rows[~left], labels[~left], depth - 1)

    @staticmethod
    def _impurity(labels: np.ndarray) -> float:
        share = labels.mean()
        return float(2 * share * (1 - share))

    def is_main(self, features: tuple[float, ...]) -> bool:
        node = self
        while node.split:
            node = node.left if features[node.split[0]] <= node.split[1] else node.right
        return node.share > 0.5


def _varied(page: str, rng: random.Random) -> str:
    """The page with shorter and longer lines, so that no exact number of words tells anything."""

    def line(found: re.Match) -> str:
        words = found[2].split()
        size = max(1, round(len(words) * rng.uniform(0.4, 2.2) + rng.uniform(-0.5, 0.9)))
        return found[1] + " ".join((words * (size // len(words) + 1))[:size])

    return re.sub("(>\\s*\u00a7?)([^<>]*[^<>\\s][^<>]*)(?=<)", line, page)


def labelled_blocks(variations: int = VARIATIONS, seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(seed)
    pages = [_varied(page, rng) if n else page for page in EXAMPLES for n in range(variations)]
    found = [block for page in pages for block in blocks(page)]
    rows = np.array([features for _, features in found], float)
    return rows, np.array([text.startswith("§") for text, _ in found], float)


@functools.lru_cache(1)
def tree() -> Tree:
    return Tree(*labelled_blocks())


def main_text(page: str | None, classifier: Tree) -> str:
    kept = [text for text, features in blocks(page or "") if classifier.is_main(features)]
    return BETWEEN.join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text``, the main text of the whole ``html``."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    classifier = tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_blocks(batches, "html"):
            found = [main_text(page, classifier) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string())],
                ["page_id", "url", "text"],
            )

    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items()) + ", text string"
    return small_batches(pages).select("page_id", "url", "html").mapInArrow(run, schema)


def measured(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
