import html
import random
import re
import time

from pickwise.llm import html_text
from pickwise.llm.html_blocks import FEATURES, blocks
from pickwise.llm.queries import op6_html


def main(page):
    return html_text.main_text(page, html_text.tree())


def by_article(page):
    """The text of the article element, for the pages of the tables."""
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (re.sub("<[^>]*>", " ", x) for x in re.split("</?(?:p|h1)>", inside))
    parts = (" ".join(html.unescape(x).split()) for x in parts)
    return "\n\n".join(x for x in parts if x)


def test_blocks():
    found = blocks("<p>a <b>b</b><br>c&nbsp;&lt;d <a href='x>y'>e</a><p>f < g<!-- no --><div>h</div><script>if (a<b) '</p>'</script>i")
    assert [text for text, _ in found] == ["a b c <d e", "f < g", "h", "i"]
    assert found[0][1][:6] == (5, 0.2, 0, 0.0, 3, 0.0)


def test_furniture_is_left_out():
    text = "Words of the article that go on for a while without any link in them at all. " * 3
    page = f"""<!DOCTYPE html><head><title>T</title><style>p{{}}</style></head><body>
    <header><h2>Site name</h2></header><nav><a href=a>One</a><a href=b>Two</a></nav>
    <div class="cookie-notice"><p>{text}</p></div><aside><p>{text}</p></aside>
    <div id="main"><h1>Title</h1><p>{text}<p>Fish &amp; chips&#33;</p><p>{text}</p></div>
    <form><p>{text}</p><textarea>{text}</textarea></form><div class="ad top">{text}</div>
    <section id="comments"><p>{text}</p></section><p style="display: none">{text}</p>
    <footer><p>{text}</p></footer><script>var x = "<p>{text}</p>"</script>"""
    one = " ".join(text.split())
    assert main(page) == "\n\n".join(["Title", one, "Fish & chips!", one])


SENTENCES = [
    "The council met on Thursday to talk about the bridge that nobody has crossed since spring.",
    "Builders found water below it.", "It will cost more than the town has, said its treasurer after the meeting.", "No.",
]
BODY = "".join(f"<p>{x}</p>" for x in SENTENCES)
TEXT = "\n\n".join(["Bridge stays shut", *SENTENCES])
REMARK = "<p>My grandfather built that bridge and would be ashamed of all of you, that is for sure, and of your council as well.</p>"


def test_a_class_around_the_article_does_not_drop_it():
    for label in ("content no-sidebar", "post has-comments", "tag-social", "sponsored story", "page widget"):
        for article in (f"<article><h1>Bridge stays shut</h1>{BODY}</article>", f"<h1>Bridge stays shut</h1>{BODY}"):
            for comments in ("", f"<div class=comments>{REMARK * 2}</div>", f"<section id=comments>{REMARK * 9}</section>"):
                page = f'<nav><a href=/>Home</a></nav><div class="{label}">{article}</div>{comments}<footer>x</footer>'
                assert main(page) == TEXT, page
    lines = "".join(f"<div>{x}</div>" for x in SENTENCES)
    assert main(f"<div class=widget><article><h2>Bridge stays shut</h2>{lines}</article></div><div class=ad>{REMARK}</div>") == TEXT
    page = f'<article class="post has-comments"><h1>Bridge stays shut</h1>{BODY}</article><div class=related>{REMARK}</div>'
    assert main(page) == TEXT
    assert main(f"<form id=f><article><h1>Bridge stays shut</h1>{BODY}</article></form><form>{REMARK}</form>") == TEXT


def test_title_in_a_header_of_the_article():
    for label in ("article-header", "entry-header", "header banner"):
        page = f"<article><div class='{label}'><h1>Bridge stays shut</h1></div>{BODY}<div class=share><p>Tell a friend</p></div></article>"
        assert main(page) == TEXT, label
    assert main(f"<article><div class=article-header><h2>Bridge stays shut</h2></div>{BODY}</article>") == TEXT


def test_formulas_and_what_is_dropped_within_a_line():
    page = (
        "<article><p>Here <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds, <svg><g><text>no</text></g>"
        "</svg>as <button>Copy</button>was <script>var a</script>said.</p><div>Next</div></article>"
    )
    assert [text for text, _ in blocks(page)] == ["Here x=1 holds, as was said.", "Next"]
    assert [text for text, _ in blocks("<p>a<svg><p>b<div>c</svg><p>d<math><p>e")] == ["a", "d", "e"]


def test_a_paragraph_that_is_a_link():
    link = "<p><a href=x>Read the full report of the council on the bridge</a></p>"
    inside = f"<article><h1>Bridge stays shut</h1>{BODY}{link}<p>{SENTENCES[0]}</p></article>"
    report = "Read the full report of the council on the bridge"
    assert main(inside) == "\n\n".join([TEXT, report, SENTENCES[0]])
    stories = "".join(f"<p><a href=x>Story {n}</a></p>" for n in range(4))
    assert main(f"<article><h1>Bridge stays shut</h1>{BODY}{stories}</article>") == TEXT


def test_short_articles_without_the_element():
    around = "<nav><ul><li><a href=/>Home</a></li></ul></nav>{}<footer>All rights reserved.</footer>"
    assert main(around.format("<h1>Closed</h1><p>We are away until May.</p>")) == "Closed\n\nWe are away until May."
    assert main(around.format("<div><h2>Closed</h2><p>Until May.</p></div>")) == "Closed\n\nUntil May."
    assert main(around.format("<p>We are away.</p>")) == "We are away."
    assert main(around.format("<div class=notice><p>We use cookies.</p></div><p>We are away.</p>")) == "We are away."


def test_lines_of_an_article_that_are_no_paragraphs():
    lines = "<ul><li>rope</li><li>two boards</li><li>nails of brass</li></ul><table><tr><td>Cost</td><td>40</td></tr></table>"
    page = f"<article><h1>Bridge stays shut</h1>{BODY}{lines}<div>{SENTENCES[2]}</div></article>"
    assert main(page) == "\n\n".join([TEXT, "rope", "two boards", "nails of brass", "Cost", "40", SENTENCES[2]])


def test_tree_decides_by_neighbours_in_and_outside_of_articles():
    """Blocks that differ in nothing but their neighbours."""
    names = {name for name in FEATURES if name.endswith(("_before", "_after"))}

    def used(node):
        return {FEATURES[node.split[0]]} | used(node.left) | used(node.right) if node.split else set()

    assert names & used(html_text.tree())
    link, long = "<p><a href=x>See the plan</a></p>", f"<p>{SENTENCES[0]}</p>"
    for opening, closing in (("<article>", "</article>"), ("<div>", "</div>")):
        between = f"{opening}<h1>Bridge</h1>{long}{link}{long}{closing}"
        in_a_row = f"{opening}<h1>Bridge</h1>{long}{long}{link * 3}{closing}"
        assert "See the plan" in main(between) and "See the plan" not in main(in_a_row), opening
    rows, labels = html_text.labelled_blocks()
    right = [html_text.tree().is_main(tuple(row)) == label for row, label in zip(rows, labels)]
    assert sum(right) / len(right) > 0.98


def test_tree_on_held_out_pages():
    """Accuracy on generated pages that are not among the examples."""
    rng = random.Random(9)
    words = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split()) for _ in range(n))
    right = total = 0
    for _ in range(200):
        paragraphs = [words(rng.choice([1, 5, 30, 80])) for _ in range(rng.randint(1, 8))]
        links = "".join(f"<li><a href=x>{words(2)}</a></li>" for _ in range(rng.randint(2, 9)))
        opening, closing = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div><article>", "</article></div>")])
        page = (
            f"<nav><ul>{links}</ul></nav><div class={rng.choice(['ad', 'sidebar', 'promo'])}>{words(20)}</div>"
            f"{opening}{''.join(f'<p>{p}</p>' for p in paragraphs)}{closing}<footer>{words(30)}</footer>"
        )
        right += main(page) == "\n\n".join(paragraphs)
        total += 1
    assert right / total >= 0.95


def test_broken_pages_are_linear():
    start = time.time()
    for page in (
        "<" * 300_000, "<a " * 200_000, '<a b="' * 100_000, "<!--" * 100_000, "<script>" * 100_000,
        "</p>" * 100_000, "<div>" * 100_000 + "</p>" * 100_000, "<x='" * 100_000 + '">' * 1000, "&" * 200_000,
        "<a href='x'>" * 50_000, "<x=\"" * 100_000 + ">" * 100_000,
    ):
        main(page)
    assert time.time() - start < 60


def test_edge_rows(spark):
    rows = [
        (1, "u", None, "x"), (2, None, "", "x"), (None, "v", "<p>only text", "x"), (3, "w", "<article><p>a</p></article>", "x"),
        (3, "w", "<article><p>a</p></article>", "x"), (4, "l", "<article>" + "<p>é text</p>" * 50_000, "x"),
    ]
    schema = "page_id long, url string, html string, text string"
    got = html_text.measured(html_text.extract(spark.createDataFrame(rows, schema))).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(
        repr((n, url, main(page or ""), len(main(page or "")))) for n, url, page, _ in rows
    )
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def test_query_by_articles(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    expected = sorted((p.page_id, p.url, by_article(p.html), len(by_article(p.html))) for p in pages)
    assert sorted(tuple(r) for r in op6_html(spark, sf_dir).collect()) == expected
