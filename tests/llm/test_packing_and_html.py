"""Packing and page texts against plain versions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from silverlode.llm import html_text, packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_plan_places_every_item_once_without_overlap():
    rng = random.Random(0)
    for capacity in (1, 7, 30, 100):
        for _ in range(60):
            counts = {rng.randint(1, capacity): rng.randint(0, 50) for _ in range(rng.randint(0, 20))}
            bins: dict[int, list[tuple[int, int]]] = {}
            ranks: dict[int, list[int]] = {}
            for run in packing.plan_bins(counts, capacity):
                for i in range(run.items):
                    ranks.setdefault(run.length, []).append(run.first_rank + i)
                    bins.setdefault(run.first_bin + i // run.per_bin, []).append((run.offset + i % run.per_bin * run.length, run.length))
            assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items() if n}
            for items in bins.values():
                at = 0
                for offset, length in sorted(items):
                    assert offset == at
                    at += length
                assert at <= capacity and sum(3 * length > capacity for _, length in items) <= 2
            total = sum(k * n for k, n in counts.items())
            assert len(bins) <= 2 * -(-total // capacity) + 1


def test_few_remembered_words_give_the_ids_of_the_tokenizer(monkeypatch):
    for name, bound in (("CACHED_WORDS", 5), ("CACHED_PARTS", 40), ("TEXT_AT_ONCE", 300), ("PARTS_AT_ONCE", 7)):
        monkeypatch.setattr(packing, name, bound)
    rng = random.Random(4)
    signs = "abcxyzABCÄöéßñÇ'’—-.,!?0189½²ªµ\u0080\u0085\u00a0\u00ad\u0130ȺǅʼnéΣДяאไ日\u0301\u200b\x00\x1c\x7f<|>" + " \t\n\r\x0b\x0c" * 3
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(300)]
    texts = [rng.choice(texts) for _ in range(400)] + [None, "", " x", "the <|endoftext|> end", "x" * 700]
    plain = Tokenizer.from_file(VOCABULARY)
    words = packing.WordIds(VOCABULARY)
    for kind in (pa.string(), pa.large_string()):
        got = list(words.ids_of(pa.array(texts, kind)))
        assert len(got) == len(texts)
        for text, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)
    # What is kept is bounded, so that it leaves room for the next step in the same worker.
    assert len(words._parts._names) <= 40


def test_pieces_are_those_of_the_tokenizer(spark):
    texts = [
        None, "", "  ", "Hello, world's END!! 12½ x²", "İstanbul ΣΑΣ e\u0301té é <|endoftext|> a<|startoftext|>b", "\u00a0x\u2003y\x1cz", "日本語 テキスト 123",
        "word " * 5000, "a" * 30000, "same text", "same text", "don't I'LL ''t 's",
    ]
    rows = [(i if i else None, t, 5, 6) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, _bucket int")
    got = packing.pack_documents(docs, VOCABULARY, keep_ids=True).collect()
    plain = Tokenizer.from_file(VOCABULARY)
    for i, text in enumerate(texts):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for r in got if r.doc_id == (i or None)), key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids), packing.CAPACITY))
        for r in own:
            part = ids[r.start : r.start + packing.CAPACITY].tobytes()
            assert (r.length, r.ids_crc32, bytes(r.ids)) == (len(part) // 4, zlib.crc32(part), part)
    places: dict[int, list[tuple[int, int]]] = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in places.values():
        assert [o for o, _ in sorted(items)] == list(np.cumsum([0, *[n for _, n in sorted(items)]])[:-1])
    assert packing.pack_documents(docs.filter("false"), VOCABULARY).count() == 0


def page(body, nav="<nav><a>Home</a></nav>"):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var x='</p>';</script></head><body>{nav}{body}<footer>&copy; me</footer></body></html>"


def test_main_text_of_articles():
    cases = {
        "": "",
        "<p>just text": "just text",
        page("<article><h1>A &amp; B</h1><p><b>one<br>two</b><p>three\n  four<ul><li>x<li>y</ul></article>"): "A & B\none two\nthree four\nx\ny",
        page("<main><div class='ad'>buy</div><p>real</p><form><input></form><aside>side</aside><!-- <p>no</p> --></main>"): "real",
        page("<article><p>in</p><section id='comments'><p>reader</p></section></article><div class='sidebar'>s</div>"): "in",
        page("<div id=content><p>body</p></div><div role=navigation>menu</div>"): "body",
        page("<article><header><h1>Title</h1><p>by me</p></header><p>&lt;tag&gt; &eacute;&#233;</p></article>"): "Title\n<tag> éé",
        page("<article><p>an adequate header about ads</p></article>"): "an adequate header about ads",
        "<": "<",
        "<p>a</b></p>c": "a\nc",
    }
    for source, text in cases.items():
        assert "\n".join(html_text.blocks(html_text.parse(source), frozenset())) == text, source


def test_templates_of_a_site_are_removed(spark):
    menu = "<div><div>Shop</div><div>News of the house</div></div>"
    rows = [(i, "http://a.com/%d" % i, page(f"<div><div>story number {i} &euro;</div></div>", menu), "x", "y") for i in range(30)]
    rows += [(100 + i, "http://b.com/%d" % i, page("<div><div>the same copy</div></div>", menu), "x", "y") for i in range(30)]
    rows += [(200, None, None, "x", "y"), (201, "x", "", "x", "y"), (202, "http://c.com/", page("<article><p>" + "long " * 50000), "x", "y")]
    rows += [(300 + i, "http://d.com/", page(f"<article><p>Every day the same line.</p><p>{i}</p></article>"), "x", "y") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, templates string")
    found = html_text.main_text(pages, html_text.site_templates(pages)).collect()
    got = {r.page_id: r.text for r in found}
    assert all(got[i] == f"story number {i} €" for i in range(30))
    # Copies of one page are one page, so nothing is known to be a template there.
    assert all(got[100 + i].endswith("the same copy") for i in range(30))
    assert (got[200], got[201], len(got[202])) == ("", "", 5 * 50000 - 1)
    assert all(got[300 + i] == f"Every day the same line.\n{i}" for i in range(20))
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_text.main_text(pages.filter("false"), html_text.site_templates(pages.filter("false"))).count() == 0


def test_templates_inside_articles_are_removed(spark):
    box = "<div class=x7><span>Read this with our partner</span></div>"
    long = "<p>" + "The same long paragraph under every story of the house. " * 3 + "</p>"
    copy = "<article><h1>Copy</h1><section>one body under many menus</section></article>"
    rows = [(i, f"http://a.com/{i}", page(f"<article><p>story {i}</p>{box}<p>Short line.</p>{long}</article>")) for i in range(20)]
    rows += [(100 + i, f"http://b.com/{i}", page(f"<main><p>story {i}</p>{box}</main>")) for i in range(20)]
    rows += [(200 + i, f"http://c.com/{i}", page(copy, f"<nav>{i}</nav>")) for i in range(20)]
    rows += [(300 + i, f"http://d.com/{i}", page(f"<article><p>{i}</p>{box if i < 4 else ''}{long if i < 6 else ''}</article>")) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(pages, html_text.site_templates(pages)).collect()}
    assert all(got[i] == f"story {i}\nShort line." and got[100 + i] == f"story {i}" for i in range(20))
    # One article on many pages, and what stands on few pages, is no template.
    assert all(got[200 + i] == "Copy\none body under many menus" for i in range(20))
    assert got[300].startswith("0\nRead this with our partner\nThe same long") and got[305].startswith("5\nThe same long")


def test_names_and_cards_do_not_hide_the_text():
    story = "<h1>Title</h1><p>The text of the page that everyone came for.</p>"
    text = "Title\nThe text of the page that everyone came for."
    cases = {
        **{page(f"<div id=page class='{name}'>{story}</div>"): text for name in ("has-sidebar", "no-sidebar", "header-fixed", "sidebar", "modal open")},
        page(f"<header><h1>Site</h1></header><div class=sidebar>{story}</div>"): text,
        page(f"<form id=aspnetForm>{story}</form>"): text,
        page(f"<article>{story}<section id='related-work'><p>before us</p></section><div class='social-history'>then</div></article>"): text + "\nbefore us\nthen",
        page(f"<article>{story}<div class='cookie-banner box'>ok</div><div class='x share'>mail</div></article>"): text,
        page(f"<article>{story}</article><div class=comments>" + "<p>I think so too, and more. </p>" * 20 + "</div>"): text,
        page(f"<main>{story}</main>" + "<article>Next story</article>" * 9): text,
        page(f"<main>{story}<article>Next</article></main>"): text + "\nNext",
        page(f"<main><p>Today</p><article>{story}</article></main>"): text,
    }
    for source, wanted in cases.items():
        assert "\n".join(html_text.blocks(html_text.parse(source), frozenset())) == wanted, source


def test_names_of_several_words_drop_by_their_first_or_last():
    story = "<p>The text of the page that everyone came for, at some length.</p>"
    text = "The text of the page that everyone came for, at some length."
    gone = "user-comments post-comments comments-area comment-list ad-slot cookie-bar site-footer main-nav sidebar-left newsletter-box"
    for name in gone.split():
        for attribute in ("class", "id"):
            source = page(f"<article>{story}<div {attribute}='{name}'>a word of someone else</div></article>")
            assert "\n".join(html_text.blocks(html_text.parse(source), frozenset())) == text, name
    for name in "discussion has-comments no-ads with-sidebar nav1gation x7ad related-work".split():
        source = page(f"<article>{story}<section class='{name}'>more of it</section></article>")
        assert "\n".join(html_text.blocks(html_text.parse(source), frozenset())) == text + "\nmore of it", name


def test_formulas_stay_and_stray_quotes_are_no_text():
    cases = {
        "<p>Energy <math><mi>E</mi></math> is</p>": "Energy E is",
        "<p class=\"q>broken</p><p>next": "broken\nnext",
        "<p class='q>broken</p><p>next": "broken\nnext",
        "<p class=x\">one</p><p title=\"a > b\">two</p>": "one\ntwo",
        "<p title = 'a > \"b'>three</p>": "three",
        "<p \">four</p><p>it's \"five\"": "four\nit's \"five\"",
    }
    for source, text in cases.items():
        assert "\n".join(html_text.blocks(html_text.parse(source), frozenset())) == text, source


def test_templates_are_those_of_a_plain_count(spark):
    """Boxes and lists at chosen shares of a host, against a count in plain Python."""
    box, few, many = "<div class=q>our partner</div>", "<ul><li>salt</li><li>oil</li></ul>", "<table><tr><td>all rights</td></tr></table>"
    shares = {box: 6, few: 7, many: 15}
    rows = []
    for i in range(100):
        parts = "".join(piece for piece, n in shares.items() if i < n)
        rows.append((i, f"http://a.com/{i}", page(f"<article><p>story {i}</p>{parts}</article>")))
    got = {r.page_id: r.text for r in html_text.main_text(table_of(spark, rows), html_text.site_templates(table_of(spark, rows))).collect()}
    counted = {piece: sum(piece in html for _, _, html in rows) for piece in shares}
    # Boxes from five pages and 1 %, lists and tables of articles from 10 %.
    templates = {p for p, n in counted.items() if n >= 5 and n >= len(rows) * (0.01 if p == box else 0.1)}
    plain = {box: "our partner", few: "salt\noil", many: "all rights"}
    for i, _, html in rows:
        assert got[i] == "\n".join([f"story {i}", *[plain[p] for p in shares if p in html and p not in templates]])


def table_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")
