"""HTML fields on pages written out by hand, and character references against the standard library."""
import html as stdlib_html
from html.parser import HTMLParser

from corpusforge.functions.html import extract_html_fields, unescape
from corpusforge.plans import standins

REFERENCES = [
    "plain", "&amp;", "&eacute;&#233;&#xE9;&#Xe9;", "&#x2019;s &rsquo;s", "&amp;lt;", "&notanentity; &", "&#0; &#55296; &#1114112;",
    "&#128; &#150; &#153; &#129;", "&copy 2020 &ampx &nbsp", "&NotEqualTilde; &nvlt;", "a && b &;", "&#x1F600;&#128512;",
    "&#00000000000065;&#999999999999999999999; &#xFFFFFFFFFFFFFFFFFFF;x", "&AMP;&amp;&Amp;", "&lt;b&gt;", "&#00065;", "&#;&#x;", "&frac12;&thinsp;x", "",
]


def test_character_references(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(REFERENCES)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", unescape("t").alias("u")).collect()}
    assert got == {i: stdlib_html.unescape(t) for i, t in enumerate(REFERENCES)}


# page -> fields of the body, title and head that a parser finds in it
PAGES = [
    ("<p>Text", dict(has_body=True, full_text="Text", title="")),
    ("<!doctype html><title>T &amp; U</title><p>Body", dict(has_body=True, full_text="Body", title="T & U")),
    ("<head><title>T</title></head>Body <b>b</b>old", dict(has_body=True, full_text="Body bold", title="T")),
    ("<frameset><frame src=a></frameset>", dict(has_body=False)),
    ("<head><meta name='description' content='single'></head><body>x</body>", dict(meta_desc="single")),
    ("<head><meta name=description content=bare></head><body>x</body>", dict(meta_desc="bare")),
    ('<head><meta content="first &quot;q&quot;" name="Description"></head><body>x</body>', dict(meta_desc='first "q"')),
    ("<head><meta data-name='description' name='x' content='no'></head><body>x</body>", dict(meta_desc="")),
    ("<head><meta name=keywords content='A, b,a'></head><body>x</body>", dict(meta_keywords=["a", "b"])),
    ("<body><img src=a alt='one two'><img alt=three src=b><img alt=\"four\"></body>", dict(full_text="one two three four")),
    ("<body><h1>One<h2>Two</h2><h3>Three", dict(headings=["One", "Two", "Three"], title="One")),
    ("<body><h1>One</h2><h4>no</h4><h3 id=x>A<br>B</h3></body>", dict(headings=["One", "AB"])),
    ("<body><header>no heading</header><h2>Yes</h2></body>", dict(headings=["Yes"], title="Yes")),
    ("<body><div class='a title b'><b>First</b> part</div> rest</body>", dict(title="First part")),
    ("<body><p class=title>Bare</p> rest</body>", dict(title="Bare")),
    ("<body><p class=subtitle>No</p></body>", dict(title="")),
    ("<body><svg><title>Icon</title></svg><h1>Page</h1></body>", dict(title="Page")),
    ("<body>seen<script>var a = '<p>';", dict(full_text="seen")),
    ("<body>seen<!-- open <p>hidden", dict(full_text="seen")),
    ("<body>a<style>p{}</style>b<br/>c</body>", dict(full_text="a b c")),
    ("<html lang='de-AT'><body>x", dict(html_lang="de-AT", has_body=True)),
    ("", dict(has_body=True, full_text="", title="", headings=[], meta_desc="", meta_keywords=[])),
    (None, dict(has_body=False)),
    ('<head><meta name="description" data-x="a>b" content="D"></head><body>x', dict(meta_desc="D", full_text="x")),
    ('<head><meta data-x=\'name="description" content="no"\' name=description content="yes"></head><body>x', dict(meta_desc="yes")),
    ('<body><p title="1 > 0">Hi</p>', dict(full_text="Hi")),
    ("<body><p title='a > b' data-y=\"<b>\">Hi</p> <a href= >x</a> <i it's>y</i>", dict(full_text="Hi x y")),
    ('<body><div class="title"><div>in</div> tail</div> rest', dict(title="in tail")),
    ("<body><div class=title>a<div>b<div>c</div></div>d</div>e<div>f</div>", dict(title="abcd")),
    ("<body><p class=title>One<p>Two", dict(title="One")),
    ("<body><section class='x title'>open <section>in", dict(title="open in")),
    ('<body><div data-class="title">no</div><b title="class=title">no</b><i class="title">yes</i>', dict(title="yes")),
    ("<body>wor<wbr>d a<b>b</b>c", dict(full_text="word abc")),
    ('<body><img data-x="x alt=no" alt="c > d"><img src="a=b>c" alt=bare/>', dict(full_text="c > d bare/")),
    ("<body>x <script>if (a > b) '</style>'</script>y<style>a>b{}</style>z", dict(full_text="x y z")),
    ("<body data-x='<body>'>in<h1 id='>'>H</h1>", dict(full_text="in H", headings=["H"])),
    ("<body>a < b and 3 > 2", dict(full_text="a < b and 3 > 2")),
    ("<body>seen <p title='never closed", dict(full_text="seen")),
    ('<body><article data-x="</article>">A <b title=">">x</b></article>B', dict(main_text="A x")),
]


class Reader(HTMLParser):
    """Text of a page's body as the standard library's parser finds it, without formatting."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.skip, self.title = [], 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript", "template", "head"):
            self.skip += 1
        elif tag == "img":
            self.parts.append(" " + (dict(attrs).get("alt") or "") + " ")
        elif tag not in INLINE:
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "template", "head"):
            self.skip -= 1
        elif tag not in INLINE:
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


INLINE = set("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strong sub sup time u var wbr".split())


def test_agrees_with_the_standard_parser_on_all_pages(spark):
    pages = standins.inject_page_features(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    rows = extract_html_fields(pages, "html").select("page_id", "html", "full_text").collect()
    wrong = []
    for r in rows:
        reader = Reader()
        reader.feed(r.html)
        reader.close()
        if " ".join("".join(reader.parts).split()) != r.full_text:
            wrong.append((r.page_id, " ".join("".join(reader.parts).split())[:200], r.full_text[:200]))
    assert wrong == [] and len(rows) >= 250


def test_long_tags_and_many_attributes(spark):
    page = "<body><p " + " ".join(f'a{i}="{"v>" * 50}"' for i in range(3000)) + ">text</p><img src='data:" + "x" * 200_000 + "' alt='pic'>" + "<div>" * 5000 + "in"
    df = spark.createDataFrame([(page,), ("<p title=\"" + "a='b' " * 20_000,)], "html string")
    assert [r.full_text for r in extract_html_fields(df, "html").collect()] == ["text pic in", ""]


def test_hard_pages(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(PAGES)], "i int, html string")
    rows = {r.i: r for r in extract_html_fields(df, "html").collect()}
    wrong = [(page, field, rows[i][field], want) for i, (page, fields) in enumerate(PAGES)
             for field, want in fields.items() if rows[i][field] != want]
    assert wrong == []


def test_limits_are_parameters(spark):
    df = spark.createDataFrame([("<head><meta name=keywords content='abcdef, b, c'></head><body><h1>1</h1><h3>3</h3><h4>4</h4>",)],
                               "html string")
    r = extract_html_fields(df, "html", max_keyword_length=3, max_keywords=2, max_heading_level=4).first()
    assert r.meta_keywords == ["abc", "b"] and r.headings == ["1", "3", "4"]
