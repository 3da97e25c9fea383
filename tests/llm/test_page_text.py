import random
import time

from pyspark.sql import functions as F

from layerflow.llm import page_text as m

SCHEMA = "page_id bigint, url string, html string"
ARTICLE = "<html><head><title>x</title></head><body><nav><a href=/>Home</a></nav><article><h1>{0}</h1><p>One {0}<p>Two &amp; <b>three</article>" \
          "<div class='ad'>Buy</div><footer>&copy; host</footer></body></html>"
PLAIN = "<body><div>Site name</div><div>Top stories</div><p>{0} first</p><p>{0} second</p><div>All rights reserved</div><ul class=menu><li>Go</ul></body>"


def test_longest_common_subsequence_is_exact():
    def length(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    r = random.Random(1)
    for _ in range(600):
        a, b = ([r.randrange(4) for _ in range(r.randrange(14))] for _ in range(2))
        for most in (1 << 22, 4):  # whole, and by halves
            found = m.shared_lines(a, b, most)
            assert len(found) == length(a, b)
            rest = iter(b)
            assert found == sorted(set(found)) and all(any(x == a[i] for x in rest) for i in found)


def test_lines_of_broken_markup():
    lines, main, has = m.lines_of("<p>a &lt; b<li>x<script>var t='</p>';</script>y<!-- <p>no --><article><p>q  r\n s<br>t<p class=ad>z")
    assert has and list(zip(lines, main)) == [("a < b", False), ("xy", False), ("q r s t", True), ("z", False)]
    assert m.lines_of("") == ([], [], False) and m.lines_of("1 < 2 &am")[0] == ["1 < 2 &am"]


def test_chrome_inside_the_article_goes():
    page = "<header>H</header><article><header><h1>T</h1></header><p>a<section id='comments'><p>no</section><form>f</form>" \
           "<aside>s</aside><div class='cookie-notice'>c</div><p>b</article><p>after"
    assert m.main_text(page, ()) == "T\n\na\n\nb"


def rows(spark, pages):
    return {(r["page_id"], r["url"]): r["text"] for r in m.extract(spark.createDataFrame(pages, SCHEMA)).collect()}


def test_template_is_deleted_where_no_article_is_marked(spark):
    pages = [(i, f"http://A.example/{i // 3}/{i}?x=1#y", PLAIN.format(f"w{i}")) for i in range(9)]
    pages += [(50, "http://alone.example/a", PLAIN.format("solo"))]
    got = rows(spark, pages)
    for i in range(9):
        assert got[i, pages[i][1]] == f"w{i} first\n\nw{i} second"
    assert got[50, "http://alone.example/a"] == "Site name\n\nTop stories\n\nsolo first\n\nsolo second\n\nAll rights reserved"


def test_layout_does_not_matter(spark):
    pages = [(i, f"http://h{i % 2}.example/p/{i * 7 % 40}", PLAIN.format(f"w{i % 11}")) for i in range(60)]
    df = spark.createDataFrame(pages, SCHEMA)
    one = {r["page_id"]: r["text"] for r in m.extract(df.coalesce(1)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert {r["page_id"]: r["text"] for r in m.extract(df.repartition(9)).collect()} == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_articles_nulls_copies_and_empty(spark):
    long = ARTICLE.format("x" * 200_000)
    pages = [(1, "http://a/x", ARTICLE.format("t")), (2, "http://a/y", ARTICLE.format("t")), (3, None, None), (4, "http://a/z", ""),
             (5, "nonsense", "<p>plain"), (5, "nonsense", "<p>plain"), (6, "http://a/w", long), (None, "http://a/v", ARTICLE.format("n"))]
    df = spark.createDataFrame(pages, SCHEMA).withColumn("text", F.lit("clash")).withColumn("mark", F.lit(1))
    got = m.extract(df)
    assert got.columns == ["page_id", "url", "text"] and got.count() == len(pages)
    text = {r["page_id"]: r["text"] for r in got.collect()}
    assert text[1] == text[2] == "t\n\nOne t\n\nTwo & three" and text[3] == text[4] == "" and text[5] == "plain"
    assert len(text[6]) > 400_000 and text[None].startswith("n\n\n")
    assert rows(spark, []) == {}


def test_query(spark, sf_dir):
    import __spark_entry__ as E

    got = E.queries()["op4_page_text"](spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == m.main_text(pages[r["page_id"]], ()) and r["n_chars"] == len(r["text"])


def test_copies_without_an_article_keep_their_text(spark):
    pages = [(i, f"http://a.example/{i // 2}?utm={i}", PLAIN.format(f"w{i // 2}")) for i in range(8)]  # each page twice
    pages += [(20 + i, "http://a.example/many/" + str(i), PLAIN.format("same").replace("Go", f"Go {i}")) for i in range(40)]  # a large group, menus differ
    pages += [(70 + i, "http://b.example/x", PLAIN.format("only")) for i in range(3)]  # nothing but copies
    got = rows(spark, pages)
    for i, url, _ in pages[:8]:
        assert got[i, url] == f"w{i // 2} first\n\nw{i // 2} second"
    for i, url, _ in pages[8:48]:
        assert got[i, url] == "same first\n\nsame second"
    for i, url, _ in pages[48:]:
        assert got[i, url] == "Site name\n\nTop stories\n\nonly first\n\nonly second\n\nAll rights reserved"


def test_only_whole_names_and_real_attributes_are_chrome():
    for attributes in ('style="overflow:hidden"', 'title="The hidden valley"', 'data-hidden="false"', 'class="layout with-sidebar"',
                       'data-id="widget-3"', "data-role=navigation", "title='a class=ad b'", 'aria-hidden="false"', 'class="has-menu no-footer"'):
        assert m.main_text(f"<div {attributes}><article {attributes}><p>Text</article></div>", ()) == "Text", attributes
        assert m.main_text(f"<article><div {attributes}>Text</div></article>", ()) == "Text", attributes
    for attributes in ("hidden", 'class="x ad"', "class=cookie-notice", 'id="site-footer"', "aria-hidden=true", "ROLE='navigation'", "id=comments", "class=widget-3"):
        assert m.main_text(f"<article>a<div {attributes}>Text</div></article>", ()) == "a", attributes


def test_elements_around_the_article_stay():
    for wrapper in ('div class="widget"', "div hidden", "form", 'div id="related"', 'section role="search"'):
        for tag in ("article", "main"):
            assert m.main_text(f"<{wrapper}>menu<{tag}><p>Text<div class=ad>no</div></{tag}>after</{wrapper.split()[0]}>", ()) == "Text"
    page = "<article>Text<section id=comments><article>reader</article></section></article><aside><article>teaser</article></aside>"
    assert m.main_text(page, ()) == "Text"


def test_broken_markup_takes_linear_time():
    pages = ["<a" * 100_000, "<p " * 60_000, "<div>" * 40_000 + "</p>" * 40_000, '<a ">" ' * 30_000 + "'", "<!--" * 50_000, "<script>" * 30_000,
             "<main><nav>" * 20_000, "<nav><article>" * 20_000, "<li><ul>" + "<section>" * 20_000 + "<li></li>" * 20_000, "<a " + "= " * 100_000 + ">",
             "<p " + "a " * 100_000 + ">", "<title></titl" * 20_000, "<b x='" * 30_000 + ">"]
    for page in pages:
        start = time.process_time()
        m.main_text(page, ())
        m.outside_chrome(page)
        assert time.process_time() - start < 5, page[:20]


def test_ends_that_are_missing():
    for page, lines in {"a<p b": ["a<p b"], "a<!-- b <p>c": ["a"], "a<script>b<p>c": ["a"], "a <3 b": ["a <3 b"], "a<p x=\"1>b": ["a", "b"],
                        "<a title=it's>a</a> don't": ["a don't"], "a<!-->b": ["ab"], "a</ x>b<?y>c": ["abc"], "<p x='>'>a": ["a"],
                        "a<script>1</scripts></script >b": ["ab"], "a<b>c > d <e": ["ac > d <e"]}.items():
        assert m.lines_of(page)[0] == lines, page


def test_shapes_of_chrome_and_lists_of_articles():
    for name in ("comment-list", "comments-area", "post-comments", "ad-slot", "cookie-bar", "nav-wrapper", "social-links", "advertisement-box", "related-posts"):
        assert m.main_text(f"<article>a<div class={name}>no</div>b</article>", ()) == "a\n\nb", name
    for name in ("post", "section", "list-box", "with-comments", "postscript"):
        assert m.main_text(f"<article>a<div class={name}>yes</div></article>", ()) == "a\n\nyes", name
    story = "<div id=content>Story</div>"
    assert m.main_text(story + '<ol class="comment-list"><li><article>reader wrote much more</article></ol>', ()) == "Story"
    assert m.main_text(story + "<ul><li><article>an entry</article></ul>", ()) == "Story\n\nan entry"
    assert m.main_text(story + '<div class="widget"><article>the whole article</article></div>', ()) == "the whole article"
    assert m.main_text(story + '<div class="related-posts"><article>a longer teaser</article></div>', ()) == "Story"


def test_whole_pages_of_known_parts():
    """Pages put together from parts whose share of the text is known."""
    r = random.Random(5)

    def words():
        return [r.choice(["one", "two", "&amp;", "caf&eacute;", "<b>bold</b>", "x<br>y", "&lt;p&gt;", "5 > 4", "<a href='/?a>b'>link</a>", "\n z"])
                for _ in range(r.randrange(1, 9))]

    def shown(parts):
        told = {"&amp;": "&", "caf&eacute;": "café", "<b>bold</b>": "bold", "x<br>y": "x y", "&lt;p&gt;": "<p>", "<a href='/?a>b'>link</a>": "link", "\n z": "z"}
        return " ".join(told.get(w, w) for w in parts)

    def block():
        parts = words()
        return r.choice(["<p>{}</p>", "<p>{}", "<h2 class=title>{}</h2>", "<div><div>{}</div></div>", "<ul><li>{}</ul>", "<blockquote><p>{}</blockquote>",
                         "<table><tr><td>{}</table>", "<section data-id='ad'>{}</section>"]).format(" ".join(parts)), [shown(parts)]

    def chrome():
        inner = " ".join(words())
        return r.choice(["<nav>{}</nav>", "<footer><p>{}</p></footer>", "<aside><div>{}</div></aside>", "<div class='ad slot'>{}</div>", "<form><p>{}</form>",
                         "<div class=comment-list><ol><li><p>{}</ol></div>", "<!-- {} -->", "<script>if (a < b) '</p>' {}</script>", "<style>{}</style>",
                         "<div hidden>{}</div>", "<ul role=navigation><li>{}</ul>", "<section id=related-posts><h3>{}</h3></section>"]).format(inner), []

    for _ in range(400):
        inside = [block() if r.random() < .7 else chrome() for _ in range(r.randrange(1, 9))]
        around = [[r.choice([chrome, block])()[0] for _ in range(r.randrange(4))] for _ in range(2)]
        tag = r.choice(["article", "main", "article class=post"])
        page = "<!doctype html><html><head><title>t</title></head><body>" + "".join(around[0]) + f"<{tag}>" + "".join(x for x, _ in inside) \
            + f"</{tag.split()[0]}>" + "".join(around[1]) + "</body></html>"
        assert m.main_text(page, ()) == "\n\n".join(x for _, xs in inside for x in xs), page


def test_small_ranges_pair_the_same_pages(spark, monkeypatch):
    pages = [(i, f"http://h{i % 2}.example/p/{i * 7 % 90}", PLAIN.format(f"w{i % 31}")) for i in range(120)]
    whole = rows(spark, pages)
    monkeypatch.setattr(m, "PART_BYTES", 200)
    assert rows(spark, pages) == whole
