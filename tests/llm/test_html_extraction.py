"""Main text of pages: against a plain reading of well-known pages, and hand-made ones."""

import html
import re

import pytest

from loomspark.llm import html_extraction as H

PAGE = "page_id bigint, url string, html string, text string"


def plain(page):
    """Blocks of an article of headings and paragraphs, whose tags needn't close."""
    m = re.search(r"<article>(.*)</article>", page, re.S) or re.search(r"<article>(.*)", page, re.S)
    parts = re.split(r"</?(?:h1|p)>", m[1])
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in x else "", x)).split()) for x in parts)
    return "\n\n".join(t for t in texts if t)


def test_real_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in H.extract(pages).collect()}
    assert got.keys() == want.keys()
    for i, t in want.items():
        assert got[i].text.replace("\n\n", " ").split() == t.split(), i
        assert got[i].text == t and got[i].n_chars == len(t)


def test_boilerplate_by_tag_role_and_class():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav>menu</nav>
    <div class="cookie-banner">cookies?</div><main><article><header><h1>Head &amp; tail</h1></header><p>One&nbsp; two<br>three <b>bo</b>ld</p>
    <aside>see also</aside><form><p>mail</p></form><div class="ad slot">buy</div><ul><li>a<li>b</ul><script>x("</p>")</script><p hidden>no</p>
    <table><tr><td>c<td>d</table><!-- <p>gone</p> --></article><section id="comments"><article class="comment"><p>first!</p></article></section></main>
    <div role="contentinfo">c</div><footer>f</footer></body></html>"""
    assert H.main_text(page) == "Head & tail\n\nOne two three bold\n\na\n\nb\n\nc\n\nd"


def test_pages_without_article(spark):
    shell = "<body><div id=x><p>Welcome to our site, {0}</p></div><p>{1}</p><p>We are open daily.</p>"
    rows = [(i, "http://h.example/" + str(i), shell.format("friend", f"Story number {i} goes here"), "clash") for i in range(12)]
    rows += [(100, "http://other.example/", shell.format("friend", "Only page"), None), (101, None, None, None), (102, "u", "", None), (103, "http://h.example", "plain <b text", None)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[3] == "Story number 3 goes here"
    assert got[100] == "Welcome to our site, friend\n\nOnly page\n\nWe are open daily."
    assert got[101] == got[102] == "" and got[103].startswith("plain")


def test_shared_passages_of_articles_stay(spark):
    page = "<body><div>nav</div><article><h1>H {0}</h1><p>A passage that many articles share.</p><div><p>Share this story</p></div><p>End {0}</p></article>"
    rows = [(i, "http://h.example/a", page.format(i), None) for i in range(10)] + [(50 + i, "http://h.example/b", "<article><p>Copied whole.</p><div>boxed</div></article>", None) for i in range(30)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[4] == "H 4\n\nA passage that many articles share.\n\nEnd 4"
    assert got[60] == "Copied whole.\n\nboxed"


def test_template_of_a_section_on_a_large_host(spark, monkeypatch):
    page = "<article><h1>H {0}</h1>{1}<p>End {0}</p></article>"
    rows = [(i, "http://big.example/", page.format(i, "<div><p>Section notice</p></div>" if i < 10 else ""), None) for i in range(100)]
    shared = "<div><p>Quoted on many hosts</p></div>"
    rows += [(1000 + i, f"http://{'ab'[i % 2]}.example/", page.format(i, shared if i < 20 else ""), None) for i in range(120)]
    d = spark.createDataFrame(rows, PAGE)
    for limit in (H.BROADCAST_HASHES, 0):
        monkeypatch.setattr(H, "BROADCAST_HASHES", limit)
        got = {r.page_id: r.text for r in H.extract(d).collect()}
        assert len(got) == 220 and got[3] == "H 3\n\nEnd 3" and got[50] == "H 50\n\nEnd 50"
        assert got[1004] == "H 4\n\nQuoted on many hosts\n\nEnd 4"


def test_unmarked_template_around_a_marked_article(spark):
    teaser = "<article><h2>Teaser of the site</h2></article>"
    page = "<body><div>{2}</div>" + teaser + "<article><p>Read us daily.</p><h1>H {0}</h1><p>Shared within.</p><p>End {0}</p><p>{1}</p><p>Write to the desk.</p></article></body>"
    rows = [(i, "http://one.example/", page.format(i, "A passage of many hosts.", "menu"), None) for i in range(40)]
    rows = [(i, u, h if i < 8 else h.replace("<p>A passage of many hosts.</p>", ""), t) for i, u, h, t in rows]
    rows += [(100, "http://two.example/", "<article><p>A passage of many hosts.</p></article>", None)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[30] == "H 30\n\nShared within.\n\nEnd 30"
    assert got[5] == "H 5\n\nShared within.\n\nEnd 5\n\nA passage of many hosts."
    assert got[100] == "A passage of many hosts."
    _, hashes = H.subtrees("<body><header><i>a</i></header><nav>b</nav><article><p>c</p></article><footer>d</footer></body>")
    assert len(hashes) == 6
    short = "<article>" + teaser[9:-10] + "</article><article>Own</article>"
    template = set(H.subtrees(teaser)[1])
    assert H.main_text(short, template) == "Own"


def test_broken_markup_and_depth():
    assert H.main_text("<p>a<p>b<i>c") == "a\n\nbc"
    assert H.main_text("x < y & z &lt;b&gt; &#233; &unknown;") == "x < y & z <b> é &unknown;"
    assert H.main_text("<article>" + "<div>" * 300 + "deep") == "deep"
    assert H.main_text("<article>" + "<b>" * 3000 + "deeper") == "deeper"
    assert H.main_text("<script>never closed <p>x") == ""
    assert H.main_text("</p></div>stray") == "stray"


def test_empty_table(spark):
    assert H.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_broken_markup_takes_linear_time():
    import time

    for page in ("<a " * 350_000, "<a<" * 350_000, '<a "' * 250_001 + ">", "<a " * 330_000 + '">', "<" * 1_000_000, "<!--" * 250_000, "<script>" + "</script " * 110_000, "<p \"'" * 160_000 + ">", "<li>" * 200_000):
        began = time.process_time()
        H.main_text(page)
        assert time.process_time() - began < 4, page[:9]


def test_tags_and_quotes():
    assert H.main_text("<p title='a > b' x=\"1 > 0\">kept</p>") == "kept"
    assert H.main_text('<p>a</p><b "never closed <i>c</i>') == 'a\n\n<b "never closed c'
    assert H.main_text("a < b <c") == "a < b <c"
    assert H.main_text("<IMG/><P/>x<br/>y") == "x y"
    assert H.main_text("<p>a<!-- <p>b</p> -->c<!DOCTYPE x><?php y ?></p>") == "ac"


def signatures(page):
    """Main content of a page and its subtrees with text, as nested tuples, read apart from the hashes."""
    root = H.parse(page)

    def sign(x):
        return (x.tag, *(" ".join(c.split()) if isinstance(c, str) else sign(c) for c in x.children))

    def words(x):
        return any(c.strip() if isinstance(c, str) else words(c) for c in x.children)

    H.measure(root)
    main, found = H.article(root) or H.body(root), {}

    def walk(x, inside):
        for c in x.children:
            if not isinstance(c, str) and words(c):
                if not (inside and c.tag in ("li", "td", "th", "dd", "dt", "tr", "tbody", "thead", "tfoot", "b", "i", "em", "strong", "a", "span", "code", "br")):
                    prose = inside and c.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption")
                    found[(sign(c), prose)] = c.hash | prose
                walk(c, inside or c is main or c.tag in ("article", "main"))

    walk(H.body(root), False)
    return sign(main), found


def test_templates_match_counts_by_brute_force(spark):
    import random
    from collections import defaultdict

    rng = random.Random(6)
    shared = [f"<div><p>Everywhere {k}</p><ul><li>x{k}</ul></div>" for k in range(6)]
    rows = []
    for i in range(420):
        host = f"h{min(rng.randrange(9), rng.randrange(9))}"
        own = "".join(f"<section><h2>{host} box {k}</h2><p>text {k}</p></section>" for k in range(8) if rng.random() < k / 10)
        some = "".join(x for k, x in enumerate(shared) if rng.random() < 0.05 + k * 0.06)
        inner = "".join(f"<p>{host} line {k}</p>" for k in range(4) if rng.random() < 0.2)
        rows.append((i, f"https://u@{host.upper()}.example:80/x", f"<body><nav>{host}</nav>{own}<article><p>{i % 390}</p>{inner}{some}</article><footer>f</footer>", None))
    pages, counts, hosts, of_hash = defaultdict(set), defaultdict(set), defaultdict(set), {}
    for _, url, page, _ in rows:
        host = url.split("@")[1].split(":")[0].lower()
        main, found = signatures(page)
        pages[host].add(main)
        for key, h in found.items():
            assert of_hash.setdefault(h, key) == key
            counts[host, key].add(main)
            hosts[key].add(host)
    want = {(h, k) for (h, k), mains in counts.items() if len(mains) >= 5 and (len(hosts[k]) == 1 or not k[1] and len(mains) >= 0.2 * len(pages[h]))}
    got = {(r.host, of_hash[r.hash]) for r in H.templates(H.subtree_hashes(spark.createDataFrame(rows, PAGE))).collect()}
    assert got == want and 20 < len(want) < len(counts)


WORDS = "ad ads adv advert sponsor promo banner nav navbar navigation menu breadcrumb pagination pager footer sidebar side widget cookie consent gdpr notice popup modal overlay newsletter subscribe signup login share sharing social related recommend comment comments commentlist disqus respond replies reply toolbar skip outbrain taboola".split()


@pytest.mark.parametrize("form", ["{}", "post {}-story", "entry the-{}", "{}_of_the_day"])
@pytest.mark.parametrize("tag", ["article", "main", "div role=main"])
def test_a_marked_article_isnt_lost_by_its_names(form, tag):
    prose = "A long walk through the old town begins at the river. " * 6
    for word in WORDS:
        for attribute in ("class", "id"):
            page = f"<body><nav><a href=/>Home</a></nav><{tag} {attribute}='{form.format(word)}'><h1>Old town</h1><p>{prose}</p><p>{prose}</p></{tag.split()[0]}><footer>Imprint</footer></body>"
            assert H.main_text(page) == f"Old town\n\n{prose.strip()}\n\n{prose.strip()}", (word, form)


def test_most_of_an_article_isnt_lost_by_part_of_a_name():
    prose = "A long walk through the old town begins at the river. " * 6
    page = f"<article><div class='text side-by-side'><p>{prose}</p></div><div class='social-links'><a href=/>Send</a></div><div class='comment-list'><p>{prose[:60]}</p></div></article>"
    assert H.main_text(page) == prose.strip()


def test_comments_marked_as_articles_stay_out():
    prose = "A long walk through the old town begins at the river. " * 6
    comment = "<article class='comment'><p>Well said, and well written too.</p></article>"
    assert H.main_text(f"<body><article class=post><p>{prose}</p></article>{comment * 9}</body>") == prose.strip()
    assert H.main_text(f"<body><div class=text><p>{prose}</p></div>{comment}</body>").startswith(prose.strip())
