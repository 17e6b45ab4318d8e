import random
from itertools import combinations

import pytest

from skyledger.llm import page_difference as p
from tests.conftest import rows

SCHEMA = "page_id bigint, url string, html string, host string, text string"


def frame(spark, pages):
    return spark.createDataFrame([(*q, "x", "y") for q in pages], SCHEMA).repartition(3)


def texts(spark, pages):
    return {r[0]: r[2] for r in rows(p.main_text(frame(spark, pages)))}


def article(*paragraphs):
    return "<article>" + "".join(f"<p>{q}</p>" for q in paragraphs) + "</article>"


PAGE = """<!DOCTYPE html><html class="no-sidebar"><head><title>T</title><style>p{margin:0}</style>
<script>var t="</p>";</script></head><body class="has-menu"><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad 1 --><div class="ad">Buy <b>now</b></div>
<div id="cookie-notice">We use cookies <div>really</div></div><form><input>Search</form>%s
<section class="comments"><article class="comment"><p>First!</p></article></section>
<aside>More</aside><p hidden>secret</p><footer>&copy; host &middot; x</footer></body></html>"""


@pytest.mark.parametrize(
    "inner, text",
    [
        ("<h1>A &amp; B</h1><p><b>One\n  two&nbsp;three<br>four<p>Five", "A & B\nOne two three four\nFive"),
        ("<header><h1>In</h1></header><p>x<div class='share-buttons'>Tweet</div>y</p>", "In\nx\ny"),
        ("a<span>b</span>c <span class='ad'>n<span>o</span></span>d", "abc d"),
        ("<p>1 &lt; 2 &#233; &copy</p><ul><li>i<li>j</ul>", "1 < 2 é ©\ni\nj"),
        ("", ""),
    ],
)
def test_markup(spark, inner, text):
    html = PAGE % f"<article>{inner}</article>"
    assert texts(spark, [(1, "http://h/a", html)]) == {1: text}


def test_article_around_a_form_and_main(spark):
    found = texts(
        spark,
        [(1, "http://h/a", "<form><div>menu</div><article>text</article></form>"),
         (2, "http://i/a", "<div>x</div><main><p>m</p><nav>n</nav></main>"),
         (3, "http://j/a", "<main><p>side</p><article>text</article></main>")],
    )
    assert found == {1: "text", 2: "m", 3: "text"}


def plain(*lines):
    return "<body>" + "".join(f"<div>{q}</div>" for q in lines) + "</body>"


def test_shared_lines_of_the_nearest_page_go(spark):
    own = {i: [f"{w} number {i} has words of its own" for w in ("first", "second")] for i in range(6)}
    pages = [
        (0, "http://h/news/a1", plain("Menu", "About", *own[0], "Contact")),
        (1, "http://h/news/a2?x=1", plain("Menu", "About", *own[1], "Contact")),
        (2, "http://h/shop/b1", plain("Menu", "Basket", *own[2], "Contact")),
        (3, "http://h/shop/b2", plain("Menu", "Basket", *own[3], "Contact")),
        (4, "http://h/shop/b2", plain("Menu", "Basket", *own[3], "Contact")),  # a copy
        (5, "http://alone/x", plain("Menu", *own[4])),
        (6, None, None), (7, None, plain(*own[5])), (7, None, plain(*own[5])), (None, "http://[", ""),
    ]
    joined = {i: "\n".join(q) for i, q in own.items()}
    assert texts(spark, pages) == {
        0: joined[0], 1: joined[1], 2: joined[2], 3: joined[3], 4: joined[3],
        5: "Menu\n" + joined[4], 6: "", 7: joined[5], None: "",
    }
    assert len(rows(p.main_text(frame(spark, pages)))) == len(pages)


def test_copies_do_not_delete_each_other(spark):
    long = [f"line {i} of a story that two pages tell" for i in range(8)]
    pages = [(1, "http://h/a", plain(*long)), (2, "http://h/b", plain(*long[:-1], "changed"))]
    pages += [(3, "http://h/c", article(*long)), (4, "http://h/d", article(*long, "more"))]
    found = texts(spark, pages)
    assert found[1] == "\n".join(long) and found[2] == "\n".join([*long[:-1], "changed"])
    assert found[3] == "\n".join(long) and found[4] == "\n".join([*long, "more"])


def test_pages_with_an_article_are_differenced(spark):
    """An article that the neighbour has too goes, a line that two articles share stays."""
    teaser = article("Read our offers", "Order now")
    pages = [
        (1, "http://h/a", PAGE % (teaser + article("Introduction", "What the first page tells at length, in many words of its own"))),
        (2, "http://h/b", PAGE % (teaser + article("Introduction", "The second one is about other things and shares none of them"))),
        (3, "http://h/c", PAGE % (article("The third page has no teaser", "Introduction") + article("and goes on"))),
        (4, "http://h/d", PAGE % article("Introduction")),
    ]
    assert texts(spark, pages) == {
        1: "Introduction\nWhat the first page tells at length, in many words of its own",
        2: "Introduction\nThe second one is about other things and shares none of them",
        3: "The third page has no teaser\nIntroduction\nand goes on",
        4: "Introduction",
    }
    gone = [r["gone"] for r in p.deleted_lines(frame(spark, pages)).collect()]
    assert gone == [[True, True, False, False]] * 2


def test_lines_of_menus_are_aligned_but_are_not_lines_of_the_text(spark):
    found = p.blocks("<nav><a>Menu</a></nav><form>Find</form><script>x</script><div>Menu</div>")
    assert [t for region, t in found if region <= p.FORM] == ["Menu", "Find"]
    pages = [
        (1, "http://h/a", "<nav>Menu</nav>" + plain("one line of its own", "About")),
        (2, "http://h/b", "<nav>About</nav>" + plain("Menu", "another line of its own")),
    ]
    assert texts(spark, pages) == {1: "one line of its own\nAbout", 2: "Menu\nanother line of its own"}


def test_text_before_an_advert_within_a_line_stays(spark):
    html = article("Hello <span class=ad><div>Buy</div></span>world")
    assert texts(spark, [(1, "http://h/a", html)]) == {1: "Hello\nworld"}


def test_slices_equal_a_plain_loop(spark):
    """Many pages of one host, some of others; partners as a sort of all pages gives them."""
    rnd = random.Random(7)
    pages = []
    for i in range(120):
        host = rnd.choice(["h", "h", "h", "i", f"j{i}"])
        lines = [rnd.choice(["Menu", "About", "Shop"]), f"text {rnd.randrange(60)} of some page", f"another line {i}", "Foot"]
        pages.append((i, f"http://{host}/{rnd.choice('ab')}/{rnd.randrange(50)}", plain(*lines)))
    measured = {}
    for _, url, html in pages:
        host, path = p.address(url)
        lines = p.main_lines(html)[2]
        key = host, p._signature(lines)
        measured[key] = min(measured.get(key, (path, lines)), (path, lines))
    expected = {}
    for i, url, html in pages:
        host, _ = p.address(url)
        lines = p.main_lines(html)[2]
        same = sorted((path, sign) for (h, sign), (path, _) in measured.items() if h == host)
        sign = p._signature(lines)
        path = measured[host, sign][0]
        at = same.index((path, sign))
        near = [measured[host, same[j][1]] for j in (at - 1, at + 1) if 0 <= j < len(same)]
        near.sort(key=lambda q: -p._likeness(path, q[0]))
        gone = set()
        for _, others in near:
            shared = longest(lines, others)
            if sum(len(lines[k]) for k in shared) < 0.5 * sum(map(len, lines)):
                gone = set(shared)
                break
        expected[i] = "\n".join(t for k, t in enumerate(lines) if k not in gone)
    assert texts(spark, pages) == expected


def longest(a, b):
    """Places in a of the one longest common subsequence of lines that occur once each."""
    return p.common_subsequence([hash(x) for x in a], [hash(x) for x in b])


def test_common_subsequence_by_brute_force():
    rnd = random.Random(8)
    for _ in range(400):
        a = [rnd.randrange(4) for _ in range(rnd.randrange(9))]
        b = [rnd.randrange(4) for _ in range(rnd.randrange(9))]

        def inside(c):
            rest = iter(b)
            return all(x in rest for x in c)

        most = max(n for n in range(len(a) + 1) if any(inside([a[i] for i in c]) for c in combinations(range(len(a)), n)))
        found = p.common_subsequence(a, b)
        assert len(found) == most and found == sorted(set(found)) and inside([a[i] for i in found])


def test_any_markup_is_read():
    rnd = random.Random(9)
    pieces = ["<p>", "</p>", "<div class=ad>", "</div>", "<", ">", "<!--", "-->", "&amp", "&#x;", "<script>", "</script>",
              "<![CDATA[", "]]>", "<?x", "<!", "text ", "<article>", "</article>", "<li", '"', "<a b='", "\0", "<!DOCTYPE [", "</"]
    for _ in range(3000):
        p.blocks("".join(rnd.choice(pieces) for _ in range(rnd.randrange(14))))
    assert p.blocks(None) == p.blocks("") == []


def test_very_long_page():
    line = "<p>" + "word " * 20
    assert len(p.blocks("<article>" + line * 20_000)) == 20_000
    a = [i % 701 for i in range(6000)]
    assert len(p.common_subsequence(a, a[::-1])) > 0
    assert p.common_subsequence(a, a) == list(range(6000))


def test_empty_table(spark):
    assert rows(p.main_text(frame(spark, []))) == []
