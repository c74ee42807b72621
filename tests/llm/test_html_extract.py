import re
import time
from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from residua.llm.html_extract import extract, extract_pages
from residua.session import table

PROSE = "This is a long sentence, with commas, that an article would have, and it goes on for a while, as they do."


def page(body):
    return f"<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_article_without_the_rest():
    html = page(
        '<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></ul></nav>'
        '<div class="cookie-notice">We use cookies, many of them, all the time.</div>'
        f'<div class="wrap has-sidebar"><div class="post"><h1>Head &amp; tail</h1><p>{PROSE}</p>'
        f'<div class="ad">Buy this, now.</div><p>{PROSE} <a href="x">link</a></p>'
        '<script>var x = "</p><p>no</p>";</script><form><p>Sign up</p><input></form></div>'
        '<aside><p>Aside, aside, aside.</p></aside>'
        f'<section id="comments"><p>{PROSE}</p><p>{PROSE}</p></section></div>'
        "<footer>&copy; us</footer>"
    )
    assert extract(html) == f"Head & tail\n{PROSE}\n{PROSE} link"


def test_unclosed_and_truncated():
    assert extract(f"<article><p><b>{PROSE}<br>more<p>{PROSE} &am").split("\n") == [f"{PROSE} more", f"{PROSE} &am"]
    assert extract(f'<article><p>{PROSE}</p><p class="x').split("\n") == [PROSE]
    assert extract(f'<article><p>a < b, "quoted" &lt;i&gt; {PROSE}</p>').startswith('a < b, "quoted" <i>')


def test_white_space_and_references():
    assert extract(f"<article><p> &eacute;\n\t x&nbsp; y &#233; {PROSE}</p></article>") == f"é x y é {PROSE}"


def test_siblings_are_kept():
    long = f"<p>{PROSE}</p>" * 3
    body = f"<div><div>{long}</div><p>{PROSE}</p><div><a href='x'>one</a> <a href='y'>two</a></div></div>"
    assert extract(page(body)) == "\n".join([PROSE] * 4)


def test_an_article_is_kept_whole():
    paragraph = "<p>" + "abcdefghi, " * 4 + "x" * 256 + "</p>"
    for n in (3, 6, 12):
        text = extract(page(f"<article><h1>Title</h1><div>{paragraph * n}</div><ul><li>one</li><li>two</li></ul></article>"))
        assert text.split("\n")[0] == "Title" and text.endswith("\none\ntwo") and len(text.split("\n")) == n + 3
    short = "A short closing section of some sixty characters, no more."
    text = extract(page(f"<article><section>{paragraph * 8}</section><section><p>{short}</p></section></article>"))
    assert text.endswith(short) and len(text.split("\n")) == 9
    body = f"<div><h1>Title</h1><div>{paragraph * 8}</div><table><tr><td>cell</td></tr></table><ul><li><a href='x'>link</a></li></ul></div>"
    text = extract(page(body))
    assert text.startswith("Title\n") and text.endswith("\ncell")


def test_odd_pages():
    assert extract(None) == extract("") == extract("<") == extract("<p") == ""
    assert extract("plain words") == "plain words"
    deep = "<div>" * 20_000 + f"<p>{PROSE}</p>"
    assert extract(deep) == PROSE
    nested = "<div>some text, of a nested kind" * 20_000
    assert extract(nested).count("nested") == 20_000
    assert extract("<b>" * 20_000 + "</i></p>" * 20_000 + PROSE) == PROSE
    assert len(extract(f"<article><p>{PROSE * 20_000}</p></article>")) == len(PROSE) * 20_000


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/!-'\"= abpdivscript&;#x1\n", max_size=200))
def test_never_fails(html):
    text = extract(html)
    assert "\n\n" not in text and text == text.strip()


def test_pages_table(spark):
    html = page(f"<article><p>{PROSE}</p></article>")
    rows = [(1, "u", html, "x"), (1, "u", html, "x"), (None, None, None, None), (2, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, "u", PROSE, len(PROSE))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract_pages(pages.limit(0)).count() == 0


def test_quotes_in_attributes():
    first, second, third = (f"{x} paragraph, it's one. {PROSE}" for x in ("First", "Second", "Third"))
    html = f"""<article><p title="it's fine">{first}</p><p data-x='say "hi' alt = "don't">{second}</p><p>{third}</p></article>"""
    assert extract(html).split("\n") == [first, second, third]
    leak = "x" * 9000 + "<p>LEAKED TEXT"
    html = f"""<article><p>{first}</p><img alt="{leak}"><p>{second} <img alt='a > b' src=x>after</p><p a="unclosed>{third}</p></article>"""
    assert extract(html) == f"{first}\n{second} after\n{third}"
    html = f"""<article><p title="the id of hidden things" alt=hidden>{first}</p><p hidden>{second}</p><p data-class="ad" class=x>{third}</p></article>"""
    assert extract(html) == f"{first}\n{third}"


def test_breaks_within_words():
    assert extract(f"<article><p>super<wbr>cali<wbr/>fragil {PROSE}<br>next</p></article>") == f"supercalifragil {PROSE} next"
    assert extract(f"<!-->a<!-- b > c --><article><p>{PROSE}<!-- <p>no</p> --></p></article>").endswith(PROSE)


def test_odd_tags_in_linear_time():
    began = time.perf_counter()
    for piece in ('<a b=">" ', "<a b='", '<a b="', "<a  ", "<p class=\"x", "<a =\" <b =' ", "</a b='>"):
        extract(piece * 60_000)
    assert time.perf_counter() - began < 60


class _Article(HTMLParser):
    """All blocks of the article element, told by their tags alone."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.edge(tag)

    def handle_endtag(self, tag):
        self.edge(tag)
        self.inside -= tag == "article"

    def edge(self, tag):
        if self.inside:
            self.blocks[-1] += " " if tag == "br" else ""
            if tag in ("article", "p", "h1", "h2", "h3", "ul", "ol", "li", "pre", "blockquote", "div", "section"):
                self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_whole_table(spark, sf_dir):
    """Pages that name their article: its blocks, whatever stands around it."""
    pages = table(spark, sf_dir, "pages")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    seen = 0
    for r in pages.collect():
        html = re.sub(r"(?s)<!--.*?-->", "", r.html or "")
        if not re.search(r"<article\b", html):
            continue
        seen += 1
        reader = _Article()
        reader.feed(html)
        reader.close()
        text = "\n".join(x for x in (" ".join(b.split()) for b in reader.blocks) if x)
        assert (got[r.page_id].text, got[r.page_id].url, got[r.page_id].n_chars) == (text, r.url, len(text)), r.page_id
    assert seen > 20 and len(got) == pages.count()


def prose(word):
    return f"<p>{word} begins a paragraph, with commas, and more words, so that it counts as prose. It goes on.</p>"


def words_of(html):
    return [line.split()[0] for line in extract(html).split("\n") if line]


def test_a_form_around_the_page_is_layout():
    page = f"<body><form id='aspnetForm'><nav>Menu</nav><div>{prose('A')}{prose('B')}</div></form></body>"
    assert words_of(page) == ["A", "B"]
    assert words_of(f"<body><form><main>{prose('A')}</main></form></body>") == ["A"]
    assert words_of(f"<body><div>{prose('A')}{prose('B')}</div><form><label>Mail</label><p>Sign up, now.</p><button>Go</button></form></body>") == ["A", "B"]


def test_names_are_judged_whole():
    kept = ["side-by-side", "share-price", "ad-hoc", "x hiddenite"]
    gone = ["ad", "ad-box", "share-buttons", "comment-17", "site-footer x", "related_posts", "cookie-notice"]
    page = "".join(f"<div class='{c}'>{prose(f'w{k}')}</div>" for k, c in enumerate(kept + gone))
    page = f"<article>{prose('A')}{page}<section id='related-work'><h2 id='social'>Social</h2>{prose('Z')}</section></article>"
    assert words_of(page) == ["A", *[f"w{k}" for k in range(len(kept))], "Social", "Z"]


def test_ties_and_page_order():
    column = "<div>{}</div>"
    page = f"<body>{column.format(prose('A') + prose('B'))}{column.format(prose('C') + prose('D'))}</body>"
    assert words_of(page) == ["A", "B", "C", "D"]
    assert words_of(f"<body><main><b>A</b></main><main><b>B</b></main></body>") == ["A"]  # without a paragraph the first is taken


def test_labels_within_a_sentence_stay():
    page = f"<article>{prose('A')}<p>Fill in <label>your name</label> now.</p><p>Text. <button>Share</button></p></article>"
    assert extract(page).split("\n")[1:] == ["Fill in your name now.", "Text."]
    many = "<p>a " + "<label>x</label> " * 20_000 + "b</p>"  # in time that follows the length
    assert extract(f"<article>{many}</article>").count("x") == 20_000
