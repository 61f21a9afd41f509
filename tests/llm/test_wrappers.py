import random

from starweave.llm import wrappers
from starweave.llm.html_tree import parse

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<div class="cookie-notice">We use cookies</div><header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
{main}<aside>Popular now</aside><form action=s><input name=q><button>Go</button></form>
<section id="comments"><p>First! {n}</p></section><footer>&copy; Site</footer></body></html>"""
ARTICLE = "<article><h1>Title {n} &amp; more</h1><p><b>Lead {n}.<br>second&nbsp;line<p>Body   <a href=z>link</a> text{n}.</p>{extra}</article>"
DIVS = '<div id=wrap><div class="c1"><h3>Title {n}</h3><p>{long}</p><p>End {n}</p></div></div>'


def test_parse_repairs_markup():
    root = parse("a<p>b<b>c</b>d<ul><li>e<li>f</ul><!-- x --><script>no</script>g &lt;h&gt; &am")
    flat = []

    def walk(block):
        for k in block.kids:
            if hasattr(k, "kids"):
                walk(k)
            else:
                flat.append(k.value)

    walk(root)
    assert flat == ["a", "bcd", "e", "f", "g <h> &am"]
    for broken in ("", "<", "<p", "<p class='", "</", "<!--", "<script>", "<a <b>", "&#x110000;", "<p>" * 300):
        parse(broken)


def test_folding_and_merging():
    one = wrappers.of_page(parse("<ul><li>a<li>b<li>c</ul>"))
    ul = one["k"][0]
    assert len(ul["k"]) == 1 and ul["k"][0]["r"] and ul["k"][0]["k"][0]["v"]
    pairs = wrappers.of_page(parse("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))["k"][0]
    assert [(p["t"], p["r"]) for p in pairs["k"]] == [("dt", 1), ("dd", 1)]
    both = wrappers.merge(wrappers.of_page(parse("<div><h1>a</h1><p>b</div>")), wrappers.of_page(parse("<div><p>c</div>")))
    assert [(p["t"], p["o"]) for p in both["k"][0]["k"]] == [("h1", 1), ("p", 0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, wrapper string")


def test_main_text(spark):
    rows, want = [], {}
    for n in range(30):
        extra = f"<ul><li>one {n}<li>two</ul>" if n % 3 == 0 else ""
        rows.append((n, f"https://A.example.com:80/{n}", PAGE.format(main=ARTICLE.format(n=n, extra=extra), n=n), "w"))
        want[n] = f"Title {n} & more Lead {n}. second line Body link text{n}." + (f" one {n} two" if extra else "")
        long = " ".join(random.Random(n).choices("some words of a longer paragraph".split(), k=60))
        rows.append((100 + n, f"http://b.example.org/{n}", PAGE.format(main=DIVS.format(n=n, long=long), n=n), "w"))
        want[100 + n] = f"Title {n} {long} End {n}"
    got = wrappers.extract(frame(spark, rows).repartition(6))
    assert got.columns == ["page_id", "url", "html", "wrapper", "text"]
    assert {r["page_id"]: r["text"] for r in got.collect()} == want


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "http://x.example/", "", None), (3, None, "plain text", None), (3, None, "plain text", None)]
    rows.append((4, "http://y.example/", f"<article><p>{'long ' * 50000}</p></article>", None))
    got = sorted((r["page_id"], len(r["text"])) for r in wrappers.extract(frame(spark, rows)).collect())
    assert got == [(1, 0), (2, 0), (3, 10), (3, 10), (4, 249_999)]
    assert wrappers.extract(frame(spark, rows).limit(0)).count() == 0


def test_two_templates(spark):
    rows, want = [], {}
    for n in range(20):
        long = " ".join(random.Random(n).choices("some words of a longer paragraph".split(), k=60))
        main = f"<article><p>{long} {n}</p></article>" if n % 5 < 3 else f"<div id=main><p>{long} {n}</p></div>"
        for at, url in ((0, f"http://two.example/{n}"), (100, None)):
            rows.append((at + n, url, PAGE.format(main=main, n=n), "w"))
            want[at + n] = f"{long} {n}"
    got = wrappers.extract(frame(spark, rows).repartition(3))
    assert {r["page_id"]: r["text"] for r in got.collect()} == want


def extracted(pages: list[str]) -> list[str]:
    """The main text of pages of one host."""
    trees = [parse(p) for p in pages]
    whole = wrappers.of_page(trees[0])
    for tree in trees[1:]:
        whole = wrappers.merge(whole, wrappers.of_page(tree))
    labelled = wrappers.label(whole)
    return [wrappers.main_text(t, labelled) for t in trees]


def test_nothing_inside_an_article_goes_by_pages_links_or_single_words():
    inside = (
        "<h2>Summary</h2><h2 id='discussion'>D {n}</h2><h2 id='related-work'>R {n}</h2><section id='search-results'><p>S {n}</p></section>"
        "<p class='notice'>N {n}</p><p class='share-price'>P {n}</p><ul><li><a href=x>one {n}</a><li><a href=y>two</a></ul>"
    )
    want = "T {n} Summary D {n} R {n} S {n} N {n} P {n} one {n} two"
    for count in (1, 2, 7, 8, 30):
        pages = [PAGE.format(main=f"<article><h1>T {n}</h1>{inside.format(n=n)}</article>", n=n) for n in range(count)]
        assert extracted(pages) == [want.format(n=n) for n in range(count)]


def test_groups_that_say_what_they_are_go():
    inside = (
        "<div class='share-buttons'>Share</div><div class='social-share'>Share</div><div id='comments'>C {n}</div>"
        "<div class='ad-slot x1'>Buy {n}</div><section class='related-articles'>More</section><div class='post-footer'>F</div>"
    )
    pages = [PAGE.format(main=f"<article><p>Text {n}</p>{inside.format(n=n)}<p>End</p></article>", n=n) for n in range(3)]
    assert extracted(pages) == [f"Text {n} Share End" for n in range(3)]  # "buttons" is a word of no known purpose


def test_deeply_nested_pages(spark):
    deep = "<div>" * 5000 + "<p>deep {n}</p>" + "</div>" * 5000
    rows = [(n, "http://d.example/", f"<article><p>Start {n}</p>{deep.format(n=n)}<p>End</p></article>tail", None) for n in range(3)]
    rows.append((3, "http://d.example/", "<div>" * 3000 + "<span>x</div>" * 2000, None))
    got = {r["page_id"]: r["text"] for r in wrappers.extract(frame(spark, rows)).collect()}
    assert {n: got[n] for n in range(3)} == {n: f"Start {n} deep {n} End" for n in range(3)}


def size(part: wrappers.Part) -> int:
    return 1 + sum(size(k) for k in part.get("k", ()))


def test_wrappers_are_bounded_by_the_layout():
    import time

    def page(n: int) -> str:
        rnd = random.Random(n)
        slugs = "".join(f"<section id='{rnd.choice('abc')}-word-{n}' class='s{n}'><h2 id='t{n}-{i}-slug'>H {n}</h2></section>" for i in range(8))
        mixed = "".join(f"<{t}>{t} {n}</{t}>" for t in rnd.choices(["h2", "p", "blockquote", "pre", "h3", "table", "ul"], k=40))
        letters = "abcdefghijklmnopqrst"
        classes = "".join(f"<div class='{''.join(rnd.choices(letters, k=6))}'>x {n}</div>" for _ in range(10))
        return PAGE.format(main=f"<article><h1>T {n}</h1>{slugs}{mixed}{classes}</article>", n=n)

    sizes, seconds = {}, {}
    whole, start = None, time.time()
    for n in range(2000):
        own = wrappers.of_page(parse(page(n)))
        whole = own if whole is None else wrappers.merge(whole, own)
        if n + 1 in (500, 1000, 2000):
            sizes[n + 1], seconds[n + 1] = size(whole), time.time() - start
    assert sizes[2000] <= 1.1 * sizes[500] and sizes[2000] < 500
    assert seconds[2000] - seconds[1000] < 3 * (seconds[1000] - seconds[500]) + 2
    labelled = wrappers.label(whole)
    text = wrappers.main_text(parse(page(7)), labelled)
    assert text.count("H 7") == 8 and text.count("x 7") == 10 and text.startswith("T 7")
