"""Operator 12: the linear scan against all runs, templates, odd markup."""

import itertools
import random
from html.parser import HTMLParser

import pytest

from strata.llm import htmltext
from strata.llm.common import table

LABELLED = [
    f"<html><body><nav><a href=/>Home</a></nav><div>Old site {i}</div><article><h1>Title {i}</h1><p>Some words <b>of</b> text.</p><ul><li>one</li></ul></article><footer>Imprint</footer></body></html>"
    for i in range(30)
]


@pytest.fixture(scope="module")
def weights():
    total = {}
    for page in LABELLED:
        for key, (inside, outside) in htmltext.count_labelled(htmltext.read_page(page)).items():
            a, b = total.get(key, (0, 0))
            total[key] = a + inside, b + outside
    return htmltext.Weights(total)


def test_best_run_is_the_best_of_all():
    r = random.Random(4)
    for _ in range(400):
        values = [r.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(r.randint(0, 12))]
        first, last = htmltext.best_run(values)
        runs = [(sum(values[a:b]), -a) for a, b in itertools.combinations(range(len(values) + 1), 2)]
        best = max([s for s, _ in runs], default=0)
        assert sum(values[first:last]) == max(best, 0)
        assert (first, last) != (0, 0) or best <= 0


BODY = "<h1>A title</h1><p>First words &amp; more.</p><p>Second one<br>goes <i>o</i>n.</p>"
TEXT = "A title\n\nFirst words & more.\n\nSecond one goes on."
CASES = {
    "plain": (f"<body><article>{BODY}</article></body>", TEXT),
    "capitals": (f"<BODY><NAV>Menu</NAV><ARTICLE>{BODY}</ARTICLE></BODY>", TEXT),
    "main": (f"<header>Site name here</header><main class=x>{BODY}</main><aside>See these other pages too</aside>", TEXT),
    "named content": (f'<div id="header">The site of sites</div><div id="content">{BODY}</div><div class="side-bar sidebar">Links to all of the things</div>', TEXT),
    "wrapped": (f'<div class="page has-sidebar"><article>{BODY}</article><div class="sidebar">Words aside, many of them</div></div>', TEXT),
    "comments": (f'<article>{BODY}<section id="comments"><article class="comment">I like it very much, thanks!</article></section></article>', TEXT),
    "reader replies": (f'<article>{BODY}</article><div class="commentList"><p>{"What I think of it. " * 40}</p></div>', TEXT),
    "cookies": (f'<div class="cookie-notice"><p>{"We use cookies. " * 30}</p></div><article>{BODY}</article>', TEXT),
    "advert inside": (f'<article><h1>A title</h1><div class="ad-box"><p>Buy this now</p></div><p>First words &amp; more.</p><form><input value=x><label>Your name</label></form><p>Second one<br>goes <i>o</i>n.</p></article>', TEXT),
    "script inside": (f'<article>{BODY}<script>var p = "<p>no</p></article>";</script><style>p > b {{}}</style><!-- <p>no</p> --></article>', TEXT),
    "article header": (f"<article><header><h1>A title</h1></header>{BODY[16:]}<footer>Tags: a, b</footer></article>", TEXT),
    "unclosed": ("<article><h1>A title<p>First <b>words &amp; more.<p>Second one<br>goes <i>o</i>n.</article><footer>No, not this one", TEXT),
    "unclosed advert": ("<article><h1>A title</h1><p class=advert>Buy this<p>First words &amp; more.<p>Second one goes on.</article>", TEXT),
    "attributes": (f"""<article data-x="a>b" title='<p>' hidden-x=1>{BODY}</article>""", TEXT),
    "bad quote": (f"""<article><p title="a>Text of it all</p></article>""", "Text of it all"),
    "hidden": (f'<article>{BODY}<p style="display: none">No</p><p hidden>No</p><p aria-hidden="true">No</p></article>', TEXT),
    "free": (f"<body><div><ul><li><a href=a>A</a></li><li><a href=b>B</a></li></ul></div><div>{BODY}</div><div><a href=c>C</a></div></body>", TEXT),
    "table": ("<article><table><tr><th>a<td>b<tr><td>1</td><td>2</td></tr></table></article>", "a b\n\n1 2"),
    "list": ("<article><p>All:</p><ul><li>one<li>two</ul></article>", "All:\n\none\n\ntwo"),
    "references": ("<article><p>&lt;p&gt; &eacute;&#233;&#xe9; a&nbsp;&nbsp;b &notanentity; &amp;amp;</p></article>", "<p> ééé a b ¬anentity; &amp;"),
    "angle": ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    "no words": ("<article><p> </p></article><div>Something else altogether</div>", ""),
    "nothing": ("", ""),
    "text alone": ("just words", "just words"),
    "open comment": ("<article><p>Yes</p><!-- no <p>no</p>", "Yes"),
    "two articles": ("<main><article><p>One</p></article><article><p>Two</p></article></main>", "One\n\nTwo"),
    "short ends": (f"<article><p>Hi.</p>{'<div><div><div></div></div></div>' * 9}<p>{'word ' * 30}</p><div><div><div>Bye.</div></div></div></article>", "Hi.\n\n" + ("word " * 30).strip() + "\n\nBye."),
}


@pytest.mark.parametrize("name", CASES)
def test_templates(weights, name):
    page, want = CASES[name]
    assert htmltext.main_text(page, weights) == want


class PlainArticle(HTMLParser):
    """Blocks of the one article, the plain way."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_all_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = {r.page_id: r for r in htmltext.op12_html_text(spark, "/root/testdata/sf0.001").collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        plain = PlainArticle()
        plain.feed(r.html)
        want = "\n\n".join(b for b in (" ".join(b.split()) for b in plain.blocks) if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>{i} &lt; word</p>" for i in range(60_000)) + "</article>"
    rows = [(1, "u", None, 7, "x"), (None, None, "<article>a</article>", 7, "x"), (2, "v", "", 7, "x"), (2, "v", "<article>a</article>", 7, "x"), (2, "v", "<article>a</article>", 7, "x"), (3, "w", long, 7, "x"), (4, "x", "<" * 200_000, 7, "x"), (5, "x", "<div>" * 50_000 + "deep" + "</p>" * 50_000, 7, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_chars string")
    got = htmltext.extract(pages, htmltext.fit(pages)).collect()
    found = sorted(((str(r.page_id), r.text[:4], r.n_chars) for r in got))
    body = "\n\n".join(f"{i} < word" for i in range(60_000))
    assert found == sorted([("1", "", 0), ("None", "a", 1), ("2", "", 0), ("2", "a", 1), ("2", "a", 1), ("3", body[:4], len(body)), ("4", "<<<<", 200_000), ("5", "deep", 4)])
    none = pages.limit(0)
    assert htmltext.extract(none, htmltext.fit(none)).collect() == []
