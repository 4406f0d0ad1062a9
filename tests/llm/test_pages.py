import random

from lexharbor.llm import pages


def text(html):
    blocks = pages.blocks_of(html)
    article = pages.is_article(html)
    return "\n".join(t for z, t in blocks if z == pages.MAIN or (z == pages.OPEN and not article))


def test_article_without_its_surroundings():
    html = """<!DOCTYPE html><html class="no-ads"><head><title>T</title><style>p{}</style>
    <script>var t="</p><article>";</script></head><body class="menu"><nav><a>Menu</a></nav>
    <div class="cookie-notice">Cookies <b>yes</b></div><!-- <p>no</p> --><aside>Side</aside>
    <article><h1>Head  line</h1><p><b>One &amp; two&nbsp;&lt;x&gt;<br>three<p>Four<div class='ad'>Buy
    </div><form><p>Mail</p></form><ul><li>a<li>b</ul> 3 < 4 <section id="comments"><article><p>I say
    </article></section></article><p>after</p><footer>&copy;</footer></body></html>"""
    assert text(html) == "Head line\nOne & two <x> three\nFour\na\nb\n3 < 4"


def test_cut_off_and_odd_pages():
    assert text("<article><p>Some text &am") == "Some text &am"
    assert text("<article><p>Some text</p><p class=") == "Some text"
    assert text("<article><p title=\"a>b\">x</p>") == "x"
    assert text("<article><script>never ends") == ""
    assert text("<article><p>a<unknown>b</unknown>c") == "abc"
    assert text("") == "" and text("plain") == "plain"
    assert text("<main><div><p>one</div>two</main>three") == "one\ntwo"
    assert len(text("<article>" + "<p>x &lt;" * 50000)) == 4 * 50000 - 1


def test_longest_common_lines():
    rng = random.Random(1)
    for cells in (pages.CELLS, 6):
        pages.CELLS, kept = cells, pages.CELLS
        for _ in range(1500):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
            size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1],
                                                                          size[i + 1][j])
            places = sorted(pages.common_lines(a, b))
            assert len(places) == size[-1][-1]
            rest = iter(b)
            assert all(any(a[k] == y for y in rest) for k in places)
        pages.CELLS = kept


def test_differences_from_the_nearest_url(spark):
    def page(*lines):
        return "<body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body>"

    rows = [(1, "http://h.org/a/1", page("Home", "One", "Imprint"), 9, "c"),
            (2, "http://h.org/a/2?x=1", page("Home", "Two", "Imprint"), 9, "c"),
            (3, "http://h.org/b/1", page("Welcome", "Three", "Imprint"), 9, "c"),
            (4, "http://other.org/a/1", page("Home", "Alone"), 9, "c"),
            (5, None, page("Home", "No url"), 9, "c"), (6, "http://h.org/a/1", None, 9, "c"),
            (7, "http://copy.org/1", page("Same", "Same"), 9, "c"),
            (8, "http://copy.org/2", page("Same", "Same"), 9, "c"),
            (9, "http://art.org/1", "<article><p>Line</p></article>", 9, "c"),
            (10, "http://art.org/2", "<article><p>Line</p></article><p>tail</p>", 9, "c"),
            (None, "bad:[url", "<p>x</p>", 9, "c"), (4, "http://other.org/a/1", page("Home", "Alone"), 9, "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, part int, cut string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in pages.extract(df).collect())
    want = [(1, "One"), (2, "Two"), (3, "Welcome\nThree"), (4, "Home\nAlone"), (4, "Home\nAlone"),
            (5, "Home\nNo url"), (6, ""), (7, "Same\nSame"), (8, "Same\nSame"), (9, "Line"),
            (10, "Line"), (0, "x")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert pages.extract(df.limit(0)).collect() == []


def test_only_an_article_that_gives_text_counts(spark):
    body = "<div>Home</div><div>{}</div><div>Imprint</div>"
    bare = ["<script>var a='<article>'</script>" + body, "<!-- <main> -->" + body,
            body + "<aside><article>teaser</article></aside>",
            body + "<footer><main>x</main></footer>",
            body + '<div class="comments"><article>I say</article></div>',
            "<article> </article>" + body]
    for page in bare:
        assert text(page.format("Own")) == "Home\nOwn\nImprint"
    assert text("<!-- <article> --><main>one</main><div>two</div>") == "one"
    assert text("<aside><article>a</article></aside><main><header>h</header>b</main>c") == "h\nb"
    rows = [(i, f"http://h.org/{i}", page.format(f"Own {i}")) for i, page in enumerate(bare)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.page_id, r.text) for r in pages.extract(df).collect()) == [
        (i, f"Own {i}") for i in range(len(bare))]


def test_copies_find_the_nearest_different_page(spark):
    def page(*lines):
        return "".join(f"<p>{x}</p>" for x in lines)

    rows = [(i, f"http://h.org/a/{i}", page("Home", "Copied", "Imprint")) for i in range(1, 8)]
    rows += [(8, "http://h.org/a/8", page("Home", "Other", "Imprint")),
             (9, "http://h.org/b", page("Home", "First")), (9, "http://h.org/b", page("Own", "Home")),
             (10, "http://h.org/c", page("Own", "Last"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in pages.extract(df.repartition(3)).collect())
    assert got[:8] == [(i, "Copied") for i in range(1, 8)] + [(8, "Other")]
    assert got[8:10] == [(9, "First"), (9, "Own")] and got[10] == (10, "Last")


def test_lines_beside_an_article_are_compared(spark):
    def page(text, *lines, article="Teaser"):
        return (f"<article><p>{article}</p></article><p>Home</p><p>{text}</p>"
                + "".join(f"<p>{x}</p>" for x in lines))

    rows = [(1, "http://h.org/a/1", page("One")), (2, "http://h.org/a/2", page("Two", "More")),
            (2, "http://h.org/a/2", page("Two", "More")),
            (3, "http://h.org/b/1", page("Imprint")), (4, "http://h.org/b/2", page("Imprint", article="B")),
            (5, "http://alone.org/1", page("One")), (6, None, page("One")),
            (7, "http://h.org/a/3", "<p>Home</p><p>Three</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.text) for r in pages.extract(df).collect())
    assert got == [(1, "Teaser\nOne"), (2, "Teaser\nTwo\nMore"), (2, "Teaser\nTwo\nMore"),
                   (3, "Teaser"), (4, "B"), (5, "Teaser"), (6, "Teaser"), (7, "Three")]
