"""Main text on hand-made pages; the region against all ranges."""

import random

from cumulus.llm import html_main as M

ARTICLE = ("<html><head><title>T words here</title></head><body><nav><ul><li><a href='/'>Home page</a></li></ul></nav>"
           "<div class='ad'>Buy this now</div><article><h1>A title &amp; more</h1><p><b>First&nbsp;one\n with  text"
           " of some words.<br><p>Second &#233;t&eacute; paragraph goes on and on.</p></article>"
           "<footer>&copy; site of someone</footer></body></html>")
OTHER = ("<body><header><h1>Site name</h1></header><div id=wrap><div class='content'><h2>Title of it</h2>"
         "<p>One paragraph with a <a href=x>linked word</a> in it.</p><form><p>Your mail</p></form>"
         "<ul><li>first item<li>second item</ul><script>var t='<p>no</p>';</script>"
         "<p>Last words of the article are here.</p></div><div class='comments'><p>I like it a lot, thank you.</p></div>"
         "</div><aside>More links for you</aside>")


def weights():
    total = M.counts(ARTICLE)
    for _ in range(20):
        total.update(M.counts(ARTICLE))
    return M.weights(total)


def test_region_is_the_best_of_all_ranges():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = M.region(s)
        best = max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])
        assert sum(s[a:b]) == best


def test_article_page():
    assert M.extract(ARTICLE, weights()) == ("A title & more\n\nFirst one with text of some words.\n\n"
                                             "Second été paragraph goes on and on.")


def test_unmarked_page():
    want = ("Title of it\n\nOne paragraph with a linked word in it.\n\nfirst item\n\nsecond item\n\n"
            "Last words of the article are here.")
    assert M.extract(OTHER, weights()) == want
    assert M.extract(OTHER, {}) == want  # without labelled pages


def test_names_do_not_hide_the_content():
    w = weights()
    text = "<h1>A title here</h1><p>First words of the text go on.</p><p>Second words of it go on.</p>"
    want = "A title here\n\nFirst words of the text go on.\n\nSecond words of it go on."
    side = "<div class='sidebar'><p>Buy these things</p></div><div class='comments'><p>" + "nice one " * 40 + "</p></div>"
    nav = "<nav><a href=x>Home page</a></nav>"
    for page in (f"<div class='layout has-sidebar'><article>{text}</article>{side}</div>",
                 f"<div id='menu-page'>{nav}<main>{text}</main>{side}</div>",
                 f"<div class='side-by-side'>{text}{side}</div>",
                 f"<section class='legal'>{text}</section>{side}",
                 f"<div class='has-sidebar'><div class='page tags'><article>{text}</article></div>{side}</div>",
                 "<div class='has-menu'><div class='share-page'><article class='menu'>" + text + "</article></div></div>"):
        for known in (w, {}):
            assert M.extract(f"<body>{page}<footer>someone</footer>", known) == want, page
    both = "<section class='legal'><p>One part of it.</p></section><section class='legal'><p>Other part of the text.</p></section>"
    assert M.extract(both, w) == "One part of it.\n\nOther part of the text."
    teasers = f"<div class='content'>{text}</div><div class='related'><article><p>More to read</p></article></div>"
    assert M.extract(teasers, w) == want
    assert M.extract(f"<article>{text}</article>{side}", w) == want


HEAD = "<h1>A title here</h1><p>First words of the text go on.</p>"
TABLE = "<table>" + "".join(f"<tr><td>a{i}</td><td>b{i}</td></tr>" for i in range(40)) + "</table>"
CELLS = "".join(f"a{i}\n\nb{i}\n\n" for i in range(40))
TITLE = "A title here\n\nFirst words of the text go on."


def test_a_marked_article_is_whole_and_ends_the_text():
    w = weights()
    for body, want in [
            (f"<article>{HEAD}<p class='related'>Related words.</p><p class='legal'>Legal words.</p></article>",
             TITLE + "\n\nRelated words.\n\nLegal words."),
            (f"<article>{HEAD}<blockquote><p>Quoted.</p><footer>Someone said</footer></blockquote></article>",
             TITLE + "\n\nQuoted.\n\nSomeone said"),
            ("<article><p>Let <math>x</math> be one.</p></article>", "Let x be one."),
            ("<article><p>Let <object>x</object> <svg><g>v</g></svg>be one.</p></article>", "Let x be one."),
            (f"<article>{HEAD}{TABLE}<p>After it.</p></article>", f"{TITLE}\n\n{CELLS}After it."),
            (f"<article>{HEAD}<div class='ad'><p>Buy it</p></div><form>Mail</form><p>After it.</p></article>",
             TITLE + "\n\nAfter it."),
            (f"<article>{HEAD}</article><section><p>" + "I like it a lot. " * 40 + "</p></section>", TITLE),
            (f"<main><article>{HEAD}</article><section><p>I like it a lot.</p></section></main>", TITLE),
            (f"<main>{HEAD * 3}<article><p>A teaser.</p></article></main>", "\n\n".join([TITLE] * 3 + ["A teaser."]))]:
        assert M.extract(f"<body><nav><a href=x>Home page</a></nav>{body}<footer>someone</footer>", w) == want, body


def test_unmarked_pages_keep_formulas_tables_and_titles():
    w = weights()
    for body, want in [
            ("<div><p>Let <math><mi>x</mi></math> be one and go on.</p></div>", "Let x be one and go on."),
            ("<div><p>Let <svg><g>v</g></svg>be one and go on.</p></div>", "Let be one and go on."),
            (f"<div>{HEAD}{TABLE}<p>After it.</p></div>", f"{TITLE}\n\n{CELLS}After it."),
            ("<div class='post-header'><h1>The title</h1></div><div><p>Some words that go on.</p></div>",
             "The title\n\nSome words that go on.")]:
        assert M.extract(f"<body><nav><a href=x>Home page</a></nav>{body}<footer>someone</footer>", w) == want, body


def brute_region(scores):
    """The best of all ranges, the first and shortest of equal ones."""
    best, at = 0.0, (0, 0)
    for j in range(len(scores) + 1):
        for i in range(j):
            total = 0.0
            for x in scores[i:j]:
                total += x
            if total > best + 1e-9:
                best, at = total, (i, j)
    return at


def test_pages_against_all_ranges(monkeypatch):
    rng = random.Random(3)
    parts = [HEAD, "<div>", "</div>", "<p>Some words go on.</p>", "<nav>Menu of it</nav>", "<ul><li>one item<li>two</ul>",
             "<article>", "</article>", "<table><tr><td>cell</table>", "<div class='related'>More of it</div>", "<br>"]
    pages = ["<body>" + "".join(rng.choices(parts, k=rng.randint(1, 7))) for _ in range(150)]
    known = {k: v + rng.uniform(-0.01, 0.01) for k, v in weights().items()}
    found = [M.extract(p, known) for p in pages]
    monkeypatch.setattr(M, "region", brute_region)
    assert found == [M.extract(p, known) for p in pages] and len(set(found)) > 30


def test_odd_pages():
    w = weights()
    for html in (None, "", "<", "<p", "<p>", "</p></div>", "<!-- x", "<script>a", "<article></article>", "<a b='>c"):
        assert M.extract(html, w) == "" or html in ("<", "<p", "<a b='>c")
    assert M.extract("only words, no tags", w) == "only words, no tags"
    assert M.extract("<p>" + "long " * 50_000 + "</p>", w) == "long " * 49_999 + "long"
    deep = "<div>" * 20_000 + "<p>deep words in here " * 2000
    assert M.extract(deep, w).count("deep") >= 1


def test_operator(spark):
    from pyspark.sql import functions as F
    rows = [(i, f"u{i}", ARTICLE) for i in range(30)] + [(40, None, None), (41, "u", ""), (None, "u", OTHER), (1, "u1", ARTICLE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    w = M.learn(pages)
    assert w["w:p"] > 0 > w["t:x"]
    out = M.main_text(pages, w).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["text"] for r in out if r["page_id"] in (40, 41)} == {""}
    assert M.learn(pages.limit(0)) == {"w:x": M.WORD_FLOOR} and M.main_text(pages.limit(0), w).count() == 0
