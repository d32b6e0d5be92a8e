import json
import random
from html.parser import HTMLParser

import pytest

from tallybrook.llm import markup, wrappers
from tallybrook.llm.queries import op12_html_text


class Article(HTMLParser):
    """A plain reading of the given pages: the blocks inside the article element."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.blocks += [""] if tag in ("p", "h1", "article") else []
        self.blocks[-1] += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.blocks += [""] if tag in ("p", "h1", "article") else []

    def handle_data(self, data):
        self.blocks[-1] += data if self.inside else ""

    def text(self):
        return "\n\n".join(b for b in (" ".join(b.split()) for b in self.blocks) if b)


def extract(html, *others):
    page = wrappers.of_page(markup.read(html))
    for other in others:
        page = wrappers._joined(page, wrappers.of_page(markup.read(other)))
    return wrappers.extracted_text(html, json.dumps(page.packed()))


def test_query_equals_plain_reading(spark, sf_dir, duck):
    pages = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    expected = {(i, u, t := Article(h).text(), len(t)) for i, u, h in pages}
    rows = op12_html_text(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    assert {tuple(r) for r in rows} == expected


FRAME = (
    '<html><head><title>T</title><script>if (a<b) document.write("<p>no</p>")</script></head><body class="with-sidebar">'
    '<header class="site"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>'
    '<div id="cookieNotice"><p>We use cookies.</p></div>{}'
    '<aside><p>Aside</p></aside><form action=x><p>Form</p></form><section class="comments"><article><p>First!</p></article></section>'
    "<footer>&copy; us</footer>"
)


@pytest.mark.parametrize(
    ("inner", "expected"),
    [
        ("<article><h1>A &amp; B</h1><p>one<br>two<p>three <b>four</article>", "A & B\n\none two\n\nthree four"),
        ("<main><p>one &lt;p&gt;</p> two &#x41;&eacute; &amp</main>", "one <p>\n\ntwo Aé &"),
        ('<div role="main"><div><p>one</p></div></div>', "one"),
        ("<main><nav><p>n</p></nav><article><header><h1>t</h1></header><p>x</p><footer>f</footer></article></main>", "t\n\nx"),
        ('<article class="post has-comments"><p>x <span class="ad">buy</span>y</p><div class="ad">z</div><p>w</p></article>', "x y\n\nw"),
        ("<article><p>a</p><!-- <p>no</p> --><ul><li>i<li>j</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\n\ni\n\nj\n\n1\n\n2\n\n3"),
        ('<article><p>a</p><noscript><p>no</p></noscript><button>b</button><p hidden>c</p><p style="display: none">d</p></article>', "a"),
        ("<article><p>a  \n\tb</p><pre>x  y\n <span class=comment># z</span></pre></article>", "a b\n\nx y # z"),
        ('<article><p title="a>b">x</p><p title=don\'t>y</p><p>İ</p></article>', "x\n\ny\n\nİ"),
        ("<nav><p>unclosed<article><p>in</p></article>", "in"),
        ("<article></article>", ""),
        ("<article><section><h2>h</h2><p>p</p><h2>g</h2><blockquote>q</blockquote></section><figure><figcaption>c</figcaption></figure></article>", "h\n\np\n\ng\n\nq\n\nc"),
        ('<article><p>a</p><div class="comment-list"><p>no</p></div><ol id="comments"><li>no</ol></article>', "a"),
    ],
)
def test_parts_of_a_page(inner, expected):
    page = FRAME.format(inner)
    other = FRAME.format("<article><h1>Other</h1><p>text</p></article>")
    assert extract(page, other, other.replace("text", "texts")) == expected
    assert extract(page) == expected


def test_region_of_pages_without_article_comes_from_the_host():
    def page(i, n):
        body = "".join(f"<p>text {i} {k} of a page</p>" for k in range(n))
        menu = "".join(f"<li><a href=/{i}{k}>item {i} {k}</a>" for k in range(3))
        return f'<body><div class=top><p>Welcome</p></div><div class=page><div class=lead>Always here</div><div class=body>{body}<ul>{menu}</ul></div></div><div class=more>More {i}</div>'

    pages = [page(i, n) for i, n in enumerate([4, 3, 0, 5, 1])]
    for i, n in enumerate([4, 3, 0, 5, 1]):
        others = pages[:i] + pages[i + 1 :]
        assert extract(pages[i], *others) == "\n\n".join(f"text {i} {k} of a page" for k in range(n))


def test_copies_of_one_page_keep_their_text():
    page = "<body><nav>menu</nav><div><p>one</p><p>two</p></div><footer>f</footer>"
    assert extract(page, page, page, page) == "one\n\ntwo"
    assert extract("<div><p>Ha</p><p>Ha</p><p>Ha</p></div>") == "Ha\n\nHa\n\nHa"


def test_mismatches_become_slots_optionals_and_groups():
    def expression(*pages):
        node = wrappers.of_page(markup.read(pages[0]))
        for p in pages[1:]:
            node = wrappers._joined(node, wrappers.of_page(markup.read(p)))
        return wrappers.expression(json.dumps(node.packed()))

    assert expression("<div><p>a</p></div>", "<div><p>a</p></div>") == '<div><p>"a"</></>'
    assert expression("<div><p>a</p></div>", "<div><p>b</p></div>") == "<div><p>#</></>"
    assert expression("<div><h2>a</h2><p>a</p></div>", "<div><p>b</p></div>") == '<div>(<h2>"a"</>)? <p>#</></>'
    assert expression("<ul><li>a<li>b<li>c</ul>", "<ul><li>a</ul>") == "<ul>(<li>#</>)+</>"
    assert expression("<div><h2>a</h2><p>a</p><h2>b</h2><p>b</p></div>") == "<div>(<h2>#</> <p>#</>)+</>"
    assert expression("<div><h2>a</h2><p>a</p></div>", "<div><p>b</p><h2>b</h2></div>").startswith("<div>((")


def test_order_of_merging_does_not_change_the_texts():
    random.seed(5)
    tags = ["p", "h2", "ul", "div class=a", "div class=b", "section", "pre"]

    def block(depth):
        tag = random.choice(tags)
        inner = f"t{random.randint(0, 9)}" if depth > 2 or random.random() < 0.4 else "".join(block(depth + 1) for _ in range(random.randint(1, 4)))
        return f"<{tag}>{inner}</{tag.split()[0]}>"

    pages = ["<body>" + "".join(block(0) for _ in range(random.randint(0, 5))) for _ in range(25)]

    def texts():
        node = None
        for p in pages:
            one = wrappers.of_page(markup.read(p))
            node = wrappers._joined(node, one) if node else one
        packed = json.dumps(node.packed())
        assert json.dumps(wrappers.unpacked(json.loads(packed)).packed()) == packed
        return {p: wrappers.extracted_text(p, packed) for p in pages}

    first = texts()
    for _ in range(3):
        random.shuffle(pages)
        assert texts() == first


def test_edges(spark):
    deep = "<article>" + "<div>" * 3_000 + "down" + "</div>" * 3_000 + "</article>"
    long = "<article>" + "".join(f"<p>word{i}</p>" for i in range(20_000)) + "</article>"
    many = "".join(f"<div class=c{'x' * (i % 90)}><p>v{i}</p></div>" for i in range(300))
    rows = [(1, "http://a/x", deep, 1), (2, "http://a/y", long, 2), (3, None, None, None), (4, "x", "", 3), (5, "http://A?q", "<<>&<", 4)]
    rows += [(None, "http://b/", "plain &amp; text", 5)] * 2 + [(6, "ftp://c#f", many, 6), (7, "http://a/z", "<article>" + many, 7)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int").repartition(3)
    got = wrappers.main_texts(pages)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    found = {(r["page_id"], r["text"], r["n_chars"]) for r in got.collect()}
    values = "\n\n".join(f"v{i}" for i in range(300))
    words = "\n\n".join(f"word{i}" for i in range(20_000))
    expected = {1: "down", 2: words, 3: "", 4: "", 5: "<<>&<", None: "plain & text", 6: values, 7: values}
    assert found == {(i, t, len(t)) for i, t in expected.items()}
    assert got.count() == len(rows)
    hosts = {r["host"] for r in wrappers.inferred(pages).collect()}
    assert hosts == {"a", "", "b", "c"}
    assert wrappers.main_texts(pages.where("false")).collect() == []


def test_same_texts_for_any_split_into_tasks(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    whole = {tuple(r) for r in wrappers.main_texts(pages.coalesce(1)).select("page_id", "text").collect()}
    split = {tuple(r) for r in wrappers.main_texts(pages.repartition(23)).select("page_id", "text").collect()}
    assert whole == split


def test_unknown_host_is_its_own_wrapper(spark):
    pages = spark.createDataFrame([("http://new/", "<article><p>a</p></article><footer>f</footer>")], "url string, html string")
    none = spark.createDataFrame([], "host string, wrapper string")
    assert [r["text"] for r in wrappers.extracted(pages, none).collect()] == ["a"]


def test_quotes_without_an_end_end_with_the_tag():
    assert extract('<article><p title="open>y</p><p>z</p></article>') == "y\n\nz"
