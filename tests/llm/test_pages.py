"""Url verdicts and main texts."""

from __future__ import annotations

from collections import Counter
import random

import pytest
from pyspark.sql import functions as F

from tillwright.llm import link_trust as lt
from tillwright.llm import page_template as pt
from tillwright.llm.common import prepare_workers

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    prepare_workers(spark)
    return lambda *rows: spark.createDataFrame(list(rows), PAGES)


def test_hosts_paths_and_longest_rules(spark, pages):
    cases = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "https://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
        "x://w.example.com/de/1?a://b": ("w.example.com", "/de/1", "example.com/de/", "block"),
        "http://org/fr/": ("org", "/fr/", "org/fr/", "allow"),
        "http://Ä.ÖRG/x": ("Ä.ÖRG".replace("R", "r").replace("G", "g"), "/x", None, "allow"),
        "http://a.net?x/en/": ("a.net", "", None, "block"),
        "no scheme/net/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    }
    rows = lt.judge(spark, pages(*[(i, url, None) for i, url in enumerate(cases)])).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert got == {i: want[:3] for i, want in enumerate(cases.values())}
    verdicts = {r.page_id: r.verdict for r in rows if r.rule}
    assert all(verdicts[i] == want[3] for i, want in enumerate(cases.values()) if want[2])


def by_hand(edges, seeds, rounds):
    out, into = Counter(s for s, _ in edges), Counter(d for _, d in edges)
    first = {h: [v // 100 * (100 - lt.PASSED) for v in seed] for h, seed in seeds.items()}
    ranks = {h: list(v) for h, v in first.items()}
    for _ in range(rounds):
        new = {h: list(v) for h, v in first.items()}
        for s, d in edges:
            if ranks.get(s, (0, 0))[0] > 0:
                new.setdefault(d, [0, 0])[0] += ranks[s][0] // out[s] // 100 * lt.PASSED
            if ranks.get(d, (0, 0))[1] > 0:
                new.setdefault(s, [0, 0])[1] += ranks[d][1] // into[d] // 100 * lt.PASSED
        ranks = new
    return {h: tuple(v) for h, v in ranks.items()}


def test_ranks_are_those_by_hand(spark):
    rng = random.Random(2)
    hosts = [f"h{i}" for i in range(12)]
    edges = sorted({(a, b) for a, b in ((rng.choice(hosts), rng.choice(hosts)) for _ in range(40)) if a != b})
    seeds = {"h0": (lt.MASS // 2, 0), "h1": (lt.MASS // 2, 0), "h2": (0, lt.MASS)}
    made = lt.propagate(
        spark, spark.createDataFrame(edges, "src string, dst string"),
        spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust long, distrust long"), 4,
    )
    assert {r.host: (r.trust, r.distrust) for r in made.collect()} == by_hand(edges, seeds, 4)


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark, pages):
    bad = '<a href="http://spam.net/x">s</a>'
    good = "<a href='//fr.org/fr/1'>ok</a><a href=https://good.com/>g</a>"
    rows = [(i, f"http://farm{i}.com/p", bad) for i in range(3)]
    rows += [(10, "http://spam.net/x", ""), (11, "http://fr.org/fr/1", good), (12, "http://good.com/a", good), (13, "http://lone.com/", None)]
    found = {r.page_id: (r.rule, r.verdict) for r in lt.judge(spark, pages(*rows)).collect()}
    assert [found[i][1] for i in range(3)] == ["block"] * 3
    assert found[10] == ("net/", "block") and found[11] == ("org/fr/", "allow")
    assert found[12] == (None, "allow") and found[13] == (None, "allow")


def page(article, extra="", menu="one two"):
    return (
        f"<html><head><title>T</title><style>p{{}}</style><script>x='</p>'</script></head><body><nav>{menu}</nav>"
        f"<div class='ad'>buy now</div>{article}{extra}<footer>&copy; all</footer></body></html>"
    )


def texts(spark, pages, *htmls, host="http://a.com/"):
    rows = pt.extract_pages(spark, pages(*[(i, f"{host}{i}", h) for i, h in enumerate(htmls)])).collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return [r.text for r in sorted(rows, key=lambda r: r.page_id)]


def test_article_without_what_stands_around_it(spark, pages):
    html = page(
        "<article><h1>Head &amp; line</h1><p><b>First\n  para<br>graph &#233;<p>Second <a href='/x'>link</a> text</p>"
        "<aside>side</aside><form>name<input></form><!-- no -->tail</article>",
        "<section class='user-comments'><article><p>I disagree with all of this very much indeed.</p></article></section>",
    )
    assert texts(spark, pages, html) == ["Head & line\n\nFirst para graph é\n\nSecond link text\n\ntail"]


def test_template_texts_are_dropped_where_most_pages_share_them(spark, pages):
    htmls = [
        page(f"<div class='box'><p>Subscribe for more like this</p><p>Story {i} has words of its own {'z' * i}</p></div>")
        for i in range(12)
    ]
    assert texts(spark, pages, *htmls) == [f"Story {i} has words of its own {'z' * i}".strip() for i in range(12)]


def test_copies_of_an_article_are_no_template(spark, pages):
    copy = [page("<article><p>The same story again and again.</p></article>", menu=f"menu {i}") for i in range(20)]
    own = [page(f"<article><p>Own story number {i}.</p></article>") for i in range(12)]
    found = texts(spark, pages, *copy, *own)
    assert found[:20] == ["The same story again and again."] * 20 and found[20] == "Own story number 0."


def test_near_copies_of_an_article_are_no_template(spark, pages):
    story = [f"<p>Sentence {k} of a story that many pages tell.</p>" for k in range(6)]
    line = "<p>Read more of us</p>"
    copies = [page(f"<div class='box'>{line}<p>Day {i}</p>{''.join(story)}</div>") for i in range(20)]
    own = [page(f"<div class='box'>{line}<p>Own story {i} is told once {'and at length ' * 5}</p></div>") for i in range(8)]
    found = texts(spark, pages, *copies, *own)
    plain = "\n\n".join(s[3:-4] for s in story)
    assert found[:20] == [f"Day {i}\n\n{plain}" for i in range(20)]
    assert found[20] == f"Own story 0 is told once {'and at length ' * 5}".strip()


@pytest.mark.parametrize("start", [
    "<main class='content has-sidebar'>", "<div id='content' class='no-sidebar'>", "<article class='post comments-open'>",
    "<main class='search'>", "<div class='wrap with-sidebar'>", "<div class='sidebar-layout'><main>",
    "<article class='post tag-social'>", "<div class='post-content widget-area'>",
])
def test_words_of_modifiers_make_no_aside(start):
    found = pt.parse(page(f"{start}<p>The article itself.</p>"))
    assert pt.extract(found, None, set()) == "The article itself."


@pytest.mark.parametrize("start", [
    "<div class='post-comments'>", "<div class='main-menu'>", "<div class='content sidebar'>", "<article class='comment'>",
    "<main hidden>", "<div id='content-sidebar'>", "<nav class='main-nav'>", "<section class='user-comments'><article>",
])
def test_names_of_asides_make_them(start):
    assert pt.extract(pt.parse(f"{start}<p>no article"), None, set()) == ""


@pytest.mark.parametrize(("inner", "want"), [
    ("<section class='search-algorithms'>", "a\n\nb"), ("<div class='form-factor'>", "a\n\nb"), ("<div id='cookie-recipes'>", "a\n\nb"),
    ("<div class='user-comments'>", "a"), ("<ul class='comment-list'>", "a"), ("<div class='share-buttons'>", "a"),
    ("<div class='related-posts'>", "a"), ("<div class='ad-slot'>", "a"), ("<p class='notice'>", "a"), ("<div role=search>", "a"),
])
def test_names_inside_articles_say_what_their_head_is(inner, want):
    assert pt.extract(pt.parse(f"<article><p>a</p>{inner}b"), None, set()) == want


@pytest.mark.parametrize(("html", "want"), [
    ('<p>x <a href="y" title="foo><b>link</b> z', "x link z"), ("<p title='a>x</p>", "x"), ('<p title="a>b">x</p>', "x"),
    ("<p>x</p><a href='y", "x"), ("<p>x</p></div", "x"), ("<p>1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("<p>x <!-- y > z", "x"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds", "so x=1 holds"),
])
def test_no_markup_stays_and_formulas_do(html, want):
    assert pt.extract(pt.parse(html), None, set()) == want


def test_a_long_run_of_open_tags_ends():
    assert pt.extract(pt.parse("<p>x</p>" + "<a " * 300_000), None, set()) == "x"


def unnamed(i, words):
    links = "".join(f"<li><a href='/{k}'>place {k}</a></li>" for k in range(5))
    legal = " ".join(f"clause {k} of the terms that everyone has to read" for k in range(10))
    return (
        f"<html><body><div class='x1'><ul>{links}</ul></div><div class='x2'><div class='x3'><p>Greetings to all.</p>"
        f"<p>{words}</p><p>It was day {i}.</p></div></div><div class='x4'><div class='x5'><p>{legal}</p></div></div></body></html>"
    )


def test_slots_decide_on_hosts_without_names(spark, pages):
    own = [f"Page {i} says {'so ' * 20 * (i + 1)}much." for i in range(12)]
    htmls = [unnamed(i, words) for i, words in enumerate(own)]
    want = [f"{words}\n\nIt was day {i}." for i, words in enumerate(own)]
    assert texts(spark, pages, *htmls) == want
    alone = [pt.extract(pt.parse(html), None, set()) for html in htmls]
    assert all("clause 3" in text for text in alone)


def test_a_name_with_little_of_the_slots_wins_nothing(spark, pages):
    htmls = [
        page(f"<div class='x'><p>{' '.join(f'word{i}x{k}' for k in range(40))}</p></div>", f"<article><p>teaser {i}</p></article>")
        for i in range(10)
    ]
    found = texts(spark, pages, *htmls)
    assert all(text.startswith(f"word{i}x0 ") and "teaser" not in text for i, text in enumerate(found))


def explicit(pages_of_host, least_pages):
    """Template elements with their slots and template texts, from whole occurrence vectors."""
    seen = {}
    for html in pages_of_host:
        parsed = pt.parse(html)
        seen[tuple(b.text for b in parsed.blocks if not b.aside)] = parsed
    seen = list(seen.values())
    vectors, plain = {}, Counter()
    for at, parsed in enumerate(seen):
        vectors.setdefault(("page",), [0] * len(seen))[at] = 1
        for path, n in parsed.elements.items():
            vectors.setdefault(("element", path), [0] * len(seen))[at] = n
            plain["element", path] += sum(
                max(0, len(b.text) - 2 * b.linked) for b in parsed.blocks if not b.aside and f"{b.path}/".startswith(f"{path}/")
            )
        for b in parsed.blocks:
            vectors.setdefault(("text", b.path, b.text), [0] * len(seen))[at] += 1
            plain["text", b.path, b.text] += 0 if b.aside else max(0, len(b.text) - 2 * b.linked)
    classes = {}
    for token, vector in vectors.items():
        classes.setdefault(tuple(vector), []).append(token)
    elements, fixed = {}, {}
    for vector, tokens in classes.items():
        on = sum(n > 0 for n in vector)
        if len(tokens) < pt.LEAST_TOKENS or on < max(least_pages, pt.LEAST_SHARE * len(seen)):
            continue
        for token in tokens:
            if token[0] == "element" and sum(vector) == on:
                elements[token[1]] = plain[token]
            elif token[0] == "text":
                fixed[token[1:]] = plain[token]
    slots = {
        path: mass - sum(m for (at, _), m in fixed.items() if f"{at}/".startswith(f"{path}/")) for path, mass in elements.items()
    }
    return elements, fixed, slots


def test_classes_and_slots_are_those_of_explicit_vectors(spark, pages):
    rng = random.Random(5)
    hosts = {}
    for h in range(4):
        parts = [f"<div class='{rng.choice('abcd')}{rng.choice('xyz')}'>" for _ in range(5)]
        fixed = [f"fixed text {k} of host {h}" for k in range(5)]
        hosts[f"h{h}.com"] = [
            "".join(
                f"{part}<p>{text}</p>" * (rng.random() < 0.9) + f"<p>{' '.join(rng.choices('uvwxyz', k=rng.randint(1, 60)))}</p>" * rng.randint(0, 2)
                + "</div>" * rng.randint(0, 1)
                for part, text in zip(parts, fixed, strict=True)
            )
            for _ in range(rng.randint(4, 14))
        ]
    rows = spark.createDataFrame([(h, html) for h, htmls in hosts.items() for html in htmls], "host string, html string")
    made = {r.host: r for r in pt.templates(pt.occurrences(rows, 4), 4).collect()}
    decided = 0
    for host, htmls in hosts.items():
        elements, fixed, slots = explicit(htmls, 4)
        row = made.get(host)
        assert {e.path: e.plain for e in (row.elements if row else ())} == elements
        assert Counter((t.path, t.plain) for t in (row.texts if row else ())) == Counter((p, m) for (p, _), m in fixed.items())
        main = pt.main_slot(elements, [(p, m) for (p, _), m in fixed.items()])
        if max(slots.values(), default=0) > 0:
            decided += 1
            assert slots[main] >= pt.MAIN_SHARE * max(slots.values())
    assert decided >= 2


def test_broken_markup_and_pages_without_text(spark, pages):
    found = texts(
        spark, pages, None, "", "just text", "<article><p>cut off <a href='x", "<p title=\"a>b\">in</p></div></article>",
        "<article>" + "<div>" * 2000 + "deep", "<nav>menu only</nav>", "<article><p>a&nbsp;b &lt;c&gt; \t d</p>",
    )
    assert found[:3] == ["", "", "just text"] and found[4:8] == ["in", "deep", "", "a b <c> d"]
    assert found[3].startswith("cut off")


def test_repeats_clashing_names_empty_tables_and_many_hosts(spark, pages, monkeypatch):
    html = page("<article><p>text of the page</p></article>")
    rows = pages((1, "http://a.com/", html), (1, "http://a.com/", html), (None, None, html)).withColumns(
        {"host": F.lit(3), "text": F.lit("x"), "elements": F.lit(1), "rule": F.lit(1)}
    )
    made = pt.extract_pages(spark, rows)
    assert Counter((r.page_id, r.text) for r in made.collect()) == {(1, "text of the page"): 2, (None, "text of the page"): 1}
    monkeypatch.setattr(pt, "BROADCAST_BYTES", 0)
    assert pt.extract_pages(spark, rows).count() == 3
    assert lt.judge(spark, rows).count() == 3
    assert pt.extract_pages(spark, pages()).collect() == [] and lt.judge(spark, pages()).collect() == []
