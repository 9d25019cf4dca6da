"""Extraction from pages of several templates, broken ones included, and wrappers of hosts."""

from __future__ import annotations

import random

import pytest

from tabwright.llm import html_extract as h
from tabwright.llm.html_tree import parse

WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore".split()


def para(seed: str, n: int = 30) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choices(WORDS, k=n))


def marked(i: int) -> tuple[str, str]:
    a, b = para(f"a{i}"), para(f"b{i}")
    html = f"""<!DOCTYPE html><html><head><title>T {i}</title><style>p{{}}</style><script>var t="</p><article>";</script></head>
    <body><header>Site <a href=/>home</a></header><nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <div class=ad>Buy</div><article id="post-{i}"><h1>Title {i}</h1><p><b>{a}<br>line &amp; two&nbsp;x<p>{b}<!-- no --><div class="share-buttons">Share</div>
    <form><label>Mail</label><input value=x></form><ul><li>first<li>second</ul><section class="comments"><article class="comment"><p>Nice {a} {a}</p></article></section></article>
    <aside>More</aside><footer>&copy; us</footer></body>"""
    return html, f"Title {i} {a} line & two x {b} first second"


def soup(i: int) -> tuple[str, str]:
    body = [para(f"s{i}{k}") for k in range(1 + i % 4)]
    quote = f"<blockquote>{para(f'q{i}')}</blockquote>" if i % 2 else ""
    html = f"""<html><body><div class="top"><a href=1>Home</a> <a href=2>Archive of everything</a></div><div class="box">This text stands on each page of the
    site and is of no interest to readers</div><div class="story">{''.join(f'<p>{p}</p>' for p in body)}{quote}</div><div class="end">Written by us, all rights
    reserved, since the year dot</div></body></html>"""
    return html, " ".join(body + ([para(f"q{i}")] if i % 2 else []))


def page_rows():
    rows, want = [], {}
    for i in range(24):
        for k, (host, make) in enumerate((("a.example", marked), ("b.example", soup))):
            html, text = make(i)
            rows.append((i * 2 + k, f"https://user@{host}:80/x/{i}?q=1", html, "t"))
            want[i * 2 + k] = text
    return rows, want


def test_templates(spark):
    rows, want = page_rows()
    odd = {900: None, 901: "", 902: "plain words < 3 & more", 903: "<div><p>unclosed <i>words", 904: "<p>a</p>" * 50_000, 905: "<div>" * 5000 + "deep",
           906: "<article>one\n two<script>x", 907: "<a href=\"x>broken quote</a> end", 908: "<>< ></p></b>&#x41;&bogus;"}
    rows += [(k, None if k % 2 else "no url", v, "t") for k, v in odd.items()] + [rows[0]]
    found = {r["page_id"]: r for r in h.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)).collect()}
    assert {k: found[k]["text"] for k in want} == want
    assert found[900]["text"] == "" and found[900]["n_chars"] == 0 and found[901]["text"] == ""
    assert found[902]["text"] == "plain words < 3 & more" and found[903]["text"] == "unclosed words"
    assert found[904]["n_chars"] == 99_999 and found[905]["text"] == "deep" and found[906]["text"] == "one two"
    assert found[907]["text"].endswith("end") and found[908]["text"].endswith("A&bogus;")
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_wrappers_are_whole_and_independent_of_order(spark):
    rows, _ = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r["host"]: r for r in h.wrappers(df.repartition(5)).collect()}
    assert found["a.example"]["pages"] == found["b.example"]["pages"] == 24
    import json

    wrapper = json.loads(found["b.example"]["wrapper"])
    assert "(<blockquote> #text </>)?" in h.expression(wrapper) and "(<p> #text </>)+" in h.expression(wrapper)
    assert h.told(wrapper)["place"].endswith("div.story") and any(p.endswith("div.box") for p in h.told(wrapper)["template"])


@pytest.mark.parametrize("html,want", [
    ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "(<dt> #"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "(<tr>"),
])
def test_repeats(html, want):
    assert want in h.expression(h.shape(parse(html), {})).replace("#same", "#")


def test_empty_table(spark):
    assert h.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def told_of(pages):
    total = None
    for page in map(parse, pages):
        total = h.merged(total, h.shape(page, h.scores(page)))
    return h.told(total)


def test_copies_are_no_template():
    story = f"<div class=story><p>{para('copy', 80)}</p></div>"
    pages = [f"<body>{story}<div class=box><p>{para(f'v{i}', 12)}</p></div></body>" for i in range(7)]
    known = told_of(pages)
    assert known["place"].endswith("div.story") and all(para("copy", 80) in h.extract(p, known) for p in pages)


def test_a_passage_on_few_pages_is_no_template():
    passage = f"<div class=special><p>{para('few', 20)}</p></div>"
    pages = [f"<body><div class=story><p>{para(f'f{i}', 50)}</p>{passage if i < 6 else ''}</div></body>" for i in range(60)]
    known = told_of(pages)
    assert all(para("few", 20) in h.extract(p, known) for p in pages[:6]) and not known["template"]


def test_all_marked_parts_are_kept():
    html = """<body><nav>Menu</nav><main><h1>Head</h1><p>Lead</p><article><p>One</p><section id="discussion">Talk</section><h2 id="legal-status">Law</h2>
    <p class="notice">Mind</p><section id="related-work">Others</section><div class="comments"><p>Nice</p></div><p class="hidden">gone</p></article>
    <div class="sidebar">Side</div><article><p>Two and more text</p></article><p>Close</p></main><footer>End</footer></body>"""
    assert h.extract(html) == "Head Lead One Talk Law Mind Others Two and more text Close"
    assert h.extract("<article><p>First</p></article><p>x</p><article><p>The second one</p></article>") == "First The second one"


def test_names_count_where_the_wrapper_shows_template():
    def page(i):
        return (f"<body><article><h1>Title {i}</h1><p>{para(f'w{i}')}</p><p class=notice>The editors thank all readers.</p>"
                f"<p class=legal>{para(f'l{i}')}</p></article></body>"), f"Title {i} {para(f'w{i}')} {para(f'l{i}')}"

    known = told_of([page(i)[0] for i in range(8)])
    assert [h.extract(page(i)[0], known) for i in range(8)] == [page(i)[1] for i in range(8)]


def test_the_wrapper_finds_the_text_outside_a_mark():
    def page(i):
        return f"<body><article><p>Read more on this today</p></article><div class=story><p>{para(f'o{i}', 60)}</p></div></body>"

    known = told_of([page(i) for i in range(8)])
    assert all(para(f"o{i}", 60) in h.extract(page(i), known) for i in range(8))


def test_a_marked_card_of_all_pages_is_template():
    pages = [f"<body><article><p>{para(f'c{i}')}</p></article><article class=card>The same card on all pages</article></body>" for i in range(8)]
    known = told_of(pages)
    assert [h.extract(p, known) for p in pages] == [para(f"c{i}") for i in range(8)]
