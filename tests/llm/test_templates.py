"""Template deduction: order, nesting and slots against plain checks, and what the word lists may not do."""

import random

import pytest

from featurekit.llm import html


def test_attributes_are_read_by_name():
    for attr in ('style="overflow:hidden"', 'title="hidden gem"', 'data-hidden="false"', "data-role='navigation'", 'class="overflow-hidden prose"',
                 'class="elementor-widget-container"', 'class="social-science"', 'id="notice-of-award"', 'class="comments"'):
        assert html.main_text(f"<body><main><div {attr}><p>Main body text.</p></div></main>") == "Main body text."
    for attr in ("hidden", 'role="navigation"', "aria-hidden=true", 'hidden="hidden"'):
        assert html.main_text(f"<body><div {attr}><p>Away.</p></div><p>Here.</p>") == "Here."
    more = "<p>Much more text than beside it.</p>"
    for attr in ('class="ad"', 'class="sidebar-left x"', 'id="cookieNotice"', 'class="site-header"', 'class="related-posts"'):
        assert html.main_text(f"<body><div {attr}><p>Away.</p></div>{more}") == "Much more text than beside it."


def plain_valid(pages, class_of):
    """Classes whose tokens repeat one sequence on every page, by looking at all of them."""
    kinds = {}
    for tokens in pages:
        for c in set(class_of.values()):
            own = [t for t in tokens if class_of.get(t) == c]
            if own:
                cycle = list(dict.fromkeys(own))
                kinds.setdefault(c, set()).add(tuple(cycle) if len(own) % len(cycle) == 0 and own == cycle * (len(own) // len(cycle)) else None)
    return {c for c, k in kinds.items() if len(k) == 1 and None not in k}


def test_order_and_nesting():
    rng = random.Random(7)
    for _ in range(200):
        class_of = {t: t // 3 for t in range(12)}
        def page(level=0, left=(1, 2, 3)):
            out = []
            for t in range(3):
                out.append(t)
                if t == 1:
                    for _ in range(rng.randint(0, 3)):
                        out += [3, 4, *([9, 10, 11] * rng.randint(0, 2)), 5]
                if t == 2:
                    out += [6, 7, 8]
            return out
        pages = [page() for _ in range(4)]
        if rng.random() < 0.5:
            at = rng.randrange(len(pages[0]))
            pages[0].insert(at, rng.randrange(12))
        said = [html.follow(p, class_of)[0] for p in pages]
        agree = {c for c in range(4) if any(c in s for s in said) and len({s[c] for s in said if c in s}) == 1 and all(s[c] for s in said if c in s)}
        assert agree <= plain_valid(pages, class_of)             # nesting asks for more than order
    clean = [0, 1, 3, 4, 9, 10, 11, 5, 3, 4, 5, 2]
    said, slots = html.follow(clean, class_of)
    assert all(said.values()) and slots[clean.index(9)] == (3, 0) and slots[clean.index(5)] == (1, 2)
    assert said[3].endswith("(1, 1)") and said[1].endswith("(0, 1)") and said[0].endswith("None")
    crossed = html.follow([0, 1, 3, 4, 2, 5], class_of)[0]       # 5 comes after the repetition around it ended
    assert crossed[1] is None
    two_places = html.follow([0, 9, 10, 11, 1, 9, 10, 11, 2], class_of)[0]
    assert two_places[3] is None                                 # not always in the same slot


@pytest.fixture(scope="module")
def site():
    rng = random.Random(1)
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(n))
    rows, want = [], {}
    for i in range(9):
        body = [words(30) for _ in range(rng.randint(1, 4))]
        menu = "".join(f'<div><a href="/{k}">{words(2)}</a></div>' for k in range(5))
        rows.append((i, f"http://site/{i}", f'<html><body><div class="qx"><div>{menu}</div><div>Site slogan</div></div><div class="zz">' + "".join(f"<p>{b}</p>" for b in body)
                     + '</div><div class="yy">Printed by the site</div></body></html>'))
        want[i] = "\n".join(body)
    return rows, want


def test_template_without_word_lists(spark, site, monkeypatch):
    """Menus of links and repeated texts go by the template alone; the page's own paragraphs stay."""
    monkeypatch.setattr(html, "MARKS", frozenset())
    rows, want = site
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in html.extract_text(pages).collect()} == want
    found = html.templates(pages).collect()
    assert [r.host for r in found] == ["site"] and found[0].menus
    few = html.extract_text(pages.where("page_id < 3")).collect()      # too few pages for a template: nothing is lost
    assert all(want[r.page_id] in r.text for r in few)


def test_given_pages_have_templates(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.host: r for r in html.templates(pages).collect()}
    assert len(found) >= 5 and all(len(r.tokens) >= html.MIN_TOKENS for r in found.values())
