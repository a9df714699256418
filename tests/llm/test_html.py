"""HTML extraction: densities against a plain recursion, pages where density alone decides, broken and deep pages, the operator's edge cases."""

import math
import random
import time

import pytest
from chainlake.llm import html

PARAGRAPHS = [f"Paragraph {i} of the article says a good deal about its matter, with commas, and at some length." for i in range(5)]
INNER = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
LINKS = "".join(f"<div><a href={i}>topic number {i}</a></div>" for i in range(9))

#: Pages whose other parts have no name, role or tag that tells them.
UNNAMED = [
    f"<body><div>{LINKS}</div><div><div>{INNER}</div></div><div><a>Imprint</a> <a>All rights reserved</a></div></body>",
    f"<body><table><tr><td>{LINKS}</td><td>{INNER}</td><td><div><a>x</a> <a>y</a></div></td></tr></table></body>",
    f"<body><div><div>{LINKS}</div><section>{INNER}</section></div></body>",
]


@pytest.mark.parametrize("page", UNNAMED)
def test_density_alone_decides(page, monkeypatch):
    assert html.main_text(page) == "\n".join(PARAGRAPHS)
    whole = html.main_nodes

    def body_only(root):
        whole(root)
        return {next(n for n in html._under(root) if n.tag == "body")}

    monkeypatch.setattr(html, "main_nodes", body_only)
    assert html.main_text(page) != "\n".join(PARAGRAPHS)


def test_densities_equal_a_plain_recursion():
    rng = random.Random(1)

    def page(depth):
        if depth == 0 or rng.random() < 0.2:
            return " ".join(rng.choices(["word", "longer words here", "x"], k=rng.randint(1, 9)))
        tag = rng.choice(["div", "p", "a", "b", "section"])
        return f"<{tag}>{''.join(page(depth - 1) for _ in range(rng.randint(1, 4)))}</{tag}>"

    def counts(node):
        c = t = lc = lt = 0
        for x in node.children:
            if isinstance(x, str):
                c += len(" ".join(x.split()))
            else:
                c2, t2, lc2, lt2 = counts(x)
                c, t, lc, lt = c + c2, t + t2 + 1, lc + lc2, lt + lt2 + (x.tag == "a")
        return c, t, c if node.tag == "a" else lc, lt

    def density(node, body):
        c, t, lc, lt = counts(node)
        if not c:
            return 0.0
        t, lt = t or 1, lt or 1
        first = c / t * math.log(max(c / (lc or 1) * t / lt, 1.0))
        base = math.log(c / (c - lc or 1) * lc + counts(body)[2] / (counts(body)[0] or 1) * c + math.e)
        return first / math.log(base) if base > 1.0 + 1e-12 else first

    for _ in range(60):
        root = html.parse(f"<body>{''.join(page(5) for _ in range(4))}</body>")
        html._judge_names(root, True)
        chosen = html.main_nodes(root)
        body = next(n for n in html._under(root) if n.tag == "body")
        nodes = html._under(body)
        sums = {n: sum(density(c, body) for c in n.children if not isinstance(c, str) and c.tag not in html._INLINE) for n in nodes}
        assert all(n.density == pytest.approx(density(n, body)) and n.sum == pytest.approx(sums[n]) for n in nodes)
        assert max(sums[n] for n in chosen) == pytest.approx(max(sums.values()))


def test_words_in_attribute_values_and_page_wide_forms():
    for wrapper in ('div title="a hidden gem"', 'div data-x="not hidden"', 'div data-role="search"', "form action=x", 'div class="content has-sidebar"', 'div id="page" class="no-comments"', 'section id="related-work"', 'div class="side-by-side"'):
        page = f"<body><{wrapper}><div>{INNER}</div></{wrapper.split()[0]}></body>"
        assert html.main_text(page) == "\n".join(PARAGRAPHS)
    assert html.main_text(f"<body><article>{INNER}</article><form><p>Your name and address, please</p><input></form></body>") == "\n".join(PARAGRAPHS)


def test_quotes_and_ends_of_tags():
    assert html.main_text('<body><p title="a > b">x <i>y</i></p><p>it\'s "so" 1 < 2</p>') == "x y\nit's \"so\" 1 < 2"
    assert html.main_text('<body><p title="never closed>text</p><p>more</p>') == "text\nmore"
    assert html.main_text("<p>a<!-- b > --><p>c<!-- d") == "a\nc"
    assert html.main_text("<p>a</span></b></p>b") == "a\nb"


@pytest.mark.parametrize("piece", ["<a ", "<!", "<p><i>", "<b><div><i></b>", '<a x=">"', "<div class=ad>", "<div>x</span>", "<td><table>x", "<p title=\"a"])
def test_broken_and_deep_pages_take_linear_time(piece):
    began = time.perf_counter()
    html.main_text(piece * 40_000)
    assert time.perf_counter() - began < 30


def test_extract_edge_cases(spark):
    schema = "page_id long, url string, html string, text string, n_chars long, _html string"
    long = "<article>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS * 3000) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", UNNAMED[0]), (3, "u", UNNAMED[0]), (None, "u", "<p>x</p>"), (5, "u", long), (6, "u", "<script>x</script>")]
    got = html.extract(spark.createDataFrame([(*r, "t", 7, "h") for r in rows], schema)).collect()
    want = [(1, "u", ""), (2, None, ""), (3, "u", "\n".join(PARAGRAPHS)), (3, "u", "\n".join(PARAGRAPHS)), (None, "u", "x"), (5, "u", "\n".join(PARAGRAPHS * 3000)), (6, "u", "")]
    key = lambda r: (r[0] or 0, r[2])
    assert sorted(((r["page_id"], r["url"], r["text"]) for r in got), key=key) == sorted(want, key=key) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract(spark.createDataFrame([], schema)).count() == 0
