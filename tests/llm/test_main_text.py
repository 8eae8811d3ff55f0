import time

from helixframe.llm import main_text

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a>Menu {n}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy {n}</div><article><h1>Title&nbsp;{n} &lt;b&gt;</h1><p>First   <b>bold</b>word<br>next<p>Open {n} &amp;amp; more<aside>Side</aside>
<form><label>Mail</label><input></form><div id="comments"><p>Reader says hi</p></div></article><aside>Related</aside><footer>&copy; {n}</footer></body></html>"""
WANT = "Title {n} <b> First boldword next Open {n} &amp; more"

PLAIN = """<html><body><div id=nav>Menu</div><div class=content><p>Story {n} begins.</p><p>It ends at {n}.</p></div><div class=tag>Same on all pages</div></body></html>"""


def test_article(spark):
    rows = [(n, f"http://a.example.com/{n}", PAGE.format(n=n), "x") for n in range(6)]
    rows += [(100 + n, f"http://b.example.com/{n}", PLAIN.format(n=n), "x") for n in range(10)]
    rows += [(200, None, None, "x"), (201, "bad", "", "x"), (None, "http://c.example.com/", "just text &amp; more", "x"), (202, "http://c.example.com/", "<p>cut <b>here", "x"),
             (203, "http://d.example.com/", "<article>" + "word " * 50_000 + "</article>", "x"), (0, "http://a.example.com/0", PAGE.format(n=0), "x")]
    got = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    for n in range(6):
        assert by[n] == WANT.format(n=n)
    for n in range(10):
        assert by[100 + n] == f"Story {n} begins. It ends at {n}."
    assert by[200] == by[201] == "" and by[None] == "just text & more" and by[202] == "cut here"
    assert by[203] == ("word " * 50_000).strip()


def test_classes_nest(spark):
    rows = [(n, f"http://a.example.com/{n}", PAGE.format(n=n), "x") for n in range(6)]
    found = {r["host"]: r["places"] for r in main_text.templates(spark.createDataFrame(rows, "page_id long, url string, html string, x string")).collect()}
    assert set(found["a.example.com"]) == set(found["*"]) == template_by_brute_force([PAGE.format(n=n) for n in range(6)])
    known = {place: (parent, label) for place, parent, label in (x.split("\t") for x in found["*"])}
    paths = set()
    for place in known:
        path = ""
        while place:
            place, label = known[place]
            path = f"/{label}{path}"
        paths.add(path)
    assert "/html/body/article/h1" in paths


def template_by_brute_force(pages):
    """Occurrence vectors written out page by page, classes of equal vectors, those that are valid and nest."""
    vectors, around = {}, {}
    for i, page in enumerate(pages):
        for node in main_text.read(page)[0][1:]:
            vectors.setdefault(node.place, [0] * len(pages))[i] += 1
            around[node.place] = (node.parent.place, node.label)
    classes = {}
    for place, vector in vectors.items():
        classes.setdefault(tuple(vector), []).append(place)
    valid = [c for v, c in classes.items() if sum(map(bool, v)) >= max(2, len(pages) * main_text.MIN_SHARE)]
    held = {""} | {place for c in valid for place in c}
    return {"\t".join([place, *around[place]]) for c in valid if all(around[p][0] in held for p in c) for place in c}


def test_template_equals_brute_force(spark):
    """Pages of one host whose blocks come and go, repeat and nest."""
    pages = ["<html><body>" + "<div class=a><p>x</p></div>" * (1 + n % 3) + "<div class=b><ul><li>y</ul></div>" * (n % 2) + "<section><div class=a>z</div></section>" * (n == 3)
             + "<h1>t</h1></body></html>" for n in range(9)]
    rows = [(n, "http://a.example.com/", page) for n, page in enumerate(pages)]
    found = {r["host"]: r["places"] for r in main_text.templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(found["a.example.com"]) == template_by_brute_force(pages) and len(found["a.example.com"]) == len(set(found["a.example.com"]))


def article(page):
    return main_text.article(page, frozenset(), frozenset())


def test_titles_and_hidden_elements_stay():
    for head in ("<header class='entry-header'><h1>Title</h1></header>", "<div class='entry-header'><h1>Title</h1></div>", "<header><hgroup class=x><h2>Title</h2></hgroup></header>",
                 "<h1 class=page-header>Title</h1>", "<p class=notice>Title</p>", "<div hidden>Title</div>", "<div style='display:none'>Title</div>"):
        assert article(f"<body><header><h1>Site</h1></header><article>{head}<p>One.</p></article></body>") == "Title One.", head
    for gone in ("<header class=toolbar>Tools</header>", "<nav>Menu</nav>", "<div class='cookie-notice'>Cookies</div>", "<p class='ad'>Buy</p>", "<ol class=comment-list><li>Hi</ol>",
                 "<footer>End</footer>", "<ul class=breadcrumbs><li>Home</ul>", "<article class=comment><p>Hi</p></article>"):
        assert article(f"<article>{gone}<p>One.</p></article>") == "One.", gone


def test_broken_markup():
    assert article('<p title="a>One.') == "One."
    assert article('<article><p title="a>One.</p><p id=b>Two</p></article>') == "One. Two"
    assert article("<article><p title='a > b' class=x>One.</p><p data-x=\"'>\">It's \"two\"</p></article>") == "One. It's \"two\""
    assert article("<p>1 < 2 and 3 <4 <p>five <b") == "1 < 2 and 3 <4 five <b"
    assert article("<p>a<!-- b <p>c") == "a" and article("<p>a<!-- b --><!doctype x><?y?>c") == "ac"
    assert article("<div><p>a</q></section></p></div>b") == "a b"


def test_hard_pages_take_linear_time():
    for page, want in (("<a " * 350_000, None), ('<a =">"' * 150_000, None), ("<div>" * 200_000 + "deep", "deep"), ("<div>" * 50_000 + "</section>" * 50_000 + "x", "x"),
                       ("<article>" * 50_000 + "x", "x"), ("<p><div>" + "<x>" * 50_000 + "</q>" * 50_000 + "x", "x"), ("<div>y" * 50_000, " ".join("y" * 50_000)),
                       ("<p " + "a" * 1_000_000 + ">x", "x"), ("<p class" + " " * 1_000_000 + ">x", "x"), ("<!--" * 250_000, "")):
        begin = time.process_time()
        got = article(page)
        assert want is None or got == want
        assert time.process_time() - begin < 20, page[:20]


def test_empty(spark):
    assert main_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_classes_do_not_hide_the_article():
    story = "<h1>Title</h1><p>First.</p><p>Second.</p>"
    for page in ("<body class='has-sidebar'><article>{}</article></body>", "<body><div class='layout sidebar-right'><article>{}</article></div></body>",
                 "<body><main class='content share-enabled'>{}</main></body>", "<div class='elementor-widget'><article>{}</article></div>", "<body class=search><main>{}</main>",
                 "<main><div class=sidebar-right><article>{}</article></div></main><div class=related-posts><article>Teaser</article></div>",
                 "<div class='sidebar-right'><article>{}</article></div><div class=related-posts><article>Teaser</article></div>",
                 "<article>{}</article><div class=sidebar><article>Teaser</article></div><aside><article>" + "Teaser " * 50 + "</article></aside>"):
        assert main_text.article(page.format(story), frozenset(), frozenset()) == "Title First. Second.", page
    for word in ("related", "tags", "alert", "legal"):
        page = f"<article><p>First.</p><div class='{word}'><p>Second.</p></div><div class='share-bar'>Share</div></article>"
        assert main_text.article(page, frozenset(), frozenset()) == "First. Second."


NEUTRAL = """<html><body><div class=a><div class=b>Home Contact Imprint</div><div class=c><h2>Story {n}</h2><div>{text}</div><p>It ends.{n}</p></div>
<div class=d>Seen {n} times</div><div class=e>All rights reserved</div></div></body></html>"""


def test_template_decides_on_hosts_of_few_pages(spark):
    text = {n: " ".join(f"word{n}x{i}" for i in range(40)) for n in range(7)}
    rows = [(10 * k + n, f"http://h{k}.example.com/{n}", NEUTRAL.format(n=n, text=text[n])) for k in range(2, 8) for n in range(k)]
    # Copies of one page, and pages with the article in common, tell nothing: no text is lost.
    rows += [(90 + n, "http://same.example.com/", NEUTRAL.format(n=1, text=text[1])) for n in range(2)]
    rows += [(95 + n, f"http://near.example.com/{n}", NEUTRAL.format(n=n, text=text[1])) for n in range(2)]
    # A page with an article element that the host's template does not have.
    rows += [(77, "http://h7.example.com/7", NEUTRAL.format(n=7, text=text[3] + "<article>Teaser</article>"))]
    by = {r["page_id"]: r["text"] for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(2, 8):
        for n in range(k):
            assert by[10 * k + n] == f"Story {n} {text[n]} It ends.{n}"
    for i in (90, 91, 95, 96):
        assert text[1] in by[i]
    assert by[77] == f"Story 7 {text[3]} Teaser It ends.7"
