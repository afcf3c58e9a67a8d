"""Operators 8, 9 and 10 on small cases and against their SQL."""
import hashlib

import pytest
from llm_cases import frame, have_data  # noqa: F401

from qualis.llm import html_template as H
from qualis.llm import preference as P
from qualis.llm import warc as W

PAGES = "page_id long, url string, html string"
TURNS = "pair_id long, turn long, role string, text string"


def segs(s):
    return [(x.text, x.train) for x in s]


def test_common_prefix_is_rendered_once(spark):
    c = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "more"), (1, 3, "assistant", "good")]
    r = c[:3] + [(1, 3, "assistant", "bad"), (1, 4, "user", "what?")]
    c += [(2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, None, None), (4, 1, "user", "x <|im_end|> y"), (None, 0, "user", "lost")]
    r += [(2, 0, "user", "a"), (3, 0, "unknown", ""), (5, 0, "assistant", "only here")]
    by = {x.pair_id: x for x in P.format_pairs(spark.createDataFrame(c, TURNS), spark.createDataFrame(r, TURNS)).collect()}
    one = by[1]
    assert one.prompt_turns == 3 and one.prompt == "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in
                                                          (("user", "hi"), ("assistant", "yo"), ("user", "more")))
    assert one.chosen == "<|im_start|>assistant\ngood<|im_end|>\n"
    assert segs(one.chosen_segments) == [("<|im_start|>assistant\n", False), ("good<|im_end|>", True), ("\n", False)]
    assert [t for _, t in segs(one.rejected_segments)] == [False, True, False, False, False, False]
    assert "".join(t for t, _ in segs(one.rejected_segments)) == one.rejected
    assert not by[2].usable and by[2].prompt_turns == 1 and by[2].chosen == "" and not by[3].usable
    assert by[4].prompt == "" and by[4].chosen == "<|im_start|>user\nx < |im_end|> y<|im_end|>\n" and by[4].rejected == ""
    assert by[5].chosen == "" and by[5].usable and sorted(by) == [1, 2, 3, 4, 5]
    empty = spark.createDataFrame([], TURNS)
    assert P.format_pairs(empty, empty).count() == 0


def test_rivals_swap_the_last_reply(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "bye"), (2, 0, "user", "q2"), (2, 1, "assistant", "a2"),
            (3, 0, "user", "q3")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, reply string").drop("reply")
    by = {x.pair_id: x for x in P.format_arrays(P.rivals(df)).collect()}
    assert "a1" in by[1].chosen and "a2" in by[1].rejected and "bye" not in by[1].chosen + by[1].prompt
    assert by[2].rejected == "" and "a2" in by[2].chosen and not by[3].usable and "q3" in by[3].prompt


CASES = [
    ("<html><body class='has-sidebar'><header>Top<h1>Site</h1></header><ul class=menu><li>a<li>b</ul><div id='cookie-notice'>We</div>"
     "<div><p>One &amp;&nbsp;two<br>three <b>bold</b>er<p>Next &lt;b&gt;<form>f<input></form></div><script>if(a<b){}</script> tail",
     "One & two three bolder\n\nNext <b>\n\ntail"),
    ("<nav>n</nav><article><h1>T</h1><p><b>A<br><p>B</p><section class='comments'><p>c</p></section></article><aside>x</aside>", "T\n\nA\n\nB"),
    ("<article class='comment'>no</article><main>yes <!-- not <p> this --> <span>in</span>line</main>", "yes inline"),
    ("plain & simple < text", "plain & simple < text"), ("<p>unclosed <i>x", "unclosed x"), ("", ""), (None, ""),
    ("<style>p{}</style><title>t</title>", ""), ("<article>a<footer>f</footer><header>h</header></article>", "a\n\nh"),
    ("<p title='a>b'>q</p><p title=\"x>y\">r</p>&#233;&eacute;&#x1F642;", "q\n\nr\n\néé🙂"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<div hidden>h</div><div role=navigation>m</div><DIV>Up</DIV><textarea><p>t</p></textarea>", "Up"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_main_text_of_one_page(source, want):
    assert H.Page("h").walk(source or "").main_text() == want


def test_long_and_deep_pages():
    n = 20_000
    assert H.Page("h").walk("<div>" * n + "deep" + "</div>" * n).main_text() == "deep"
    assert len(H.Page("h").walk("<p>word</p>" * n).main_text()) == n * 6 - 2


@pytest.fixture(scope="module")
def site(frame):
    bar = "<div class='top'><p>Welcome to our shop of things</p><span>call us</span></div>"
    rows = [(k, f"http://A.example/{k}", f"<body>{bar}<div><p>story {k} about {k * 7}</p><p>same closing line</p></div></body>")
            for k in range(30)]
    rows += [(100, "http://b.example/", f"<body>{bar}<p>alone</p></body>"), (101, None, None), (102, "http://[bad", "<p>odd url</p>"),
             (0, "http://A.example/0", rows[0][2]), (None, "http://a.example/x", f"{bar}<p>no id but a longer story of its own that fills this page</p>")]
    rows += [(200 + k, "http://c.example/", "<article><p>copied article</p></article>") for k in range(20)]
    return frame(rows, PAGES), rows


@pytest.mark.parametrize("shared", [H.MAX_SHARED, 0])
def test_site_template_is_removed_on_its_host_only(site, shared):
    df, rows = site
    got = H.extract(df.repartition(3), max_shared=shared).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {(r.page_id, r.url): r.text for r in got}
    for k in range(30):  # a recurring paragraph goes as well: nothing marks these pages' content
        assert f"story {k} about {k * 7}" in by[(k, f"http://A.example/{k}")] and "Welcome" not in by[(k, f"http://A.example/{k}")]
    assert by[(100, "http://b.example/")] == "Welcome to our shop of things\n\ncall us\n\nalone"
    assert by[(101, None)] == "" and by[(102, "http://[bad")] == "odd url" and by[(None, "http://a.example/x")].startswith("no id but")
    assert all(by[(200 + k, "http://c.example/")] == "copied article" for k in range(20))
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("shared", [H.MAX_SHARED, 0])
@pytest.mark.parametrize("copies,others", [(20, 5), (7, 3), (20, 0)])
def test_copies_of_a_div_article_stay(frame, shared, copies, others):
    bar = "<div class='top'><span>Our shop of things</span></div>"
    paras = [f"Paragraph {k} of a text that many pages of the site carry" for k in range(5)]
    art = "".join(f"<p>{p}</p>" for p in paras)
    page = lambda k, inner: f"<body>{bar}<div><p>visit {k}</p></div>{inner}</body>"
    kinds = ["<div>%s</div>", "<section><div>%s</div></section>", "<table><tr><td>%s</td></tr></table>"]
    rows = [(100 * h + k, f"http://h{h}.example/{k}", page(k, kinds[h] % art)) for h in range(3) for k in range(copies)]
    rows += [(100 * h + 50 + k, f"http://h{h}.example/o{k}", page(50 + k, f"<p>{paras[0]}</p><p>" + f"own story {k} " * 9 + "</p>"))
             for h in range(3) for k in range(others)]
    by = {r.page_id: r.text for r in H.extract(frame(rows, PAGES), max_shared=shared).collect()}
    for h in range(3):
        assert all("\n\n".join(paras) in by[100 * h + k] for k in range(copies))
        assert copies < 20 or not any("Our shop" in by[100 * h + k] for k in range(copies))


def test_copies_of_a_page_count_once_and_rare_paragraphs_stay(frame):
    rows = [(k, f"http://h.example/{k}", "<div><p>one page</p><p>all its text</p><p>in three parts</p></div>") for k in range(20)]
    line = "<p>a paragraph on a tenth of the pages</p>"
    rows += [(100 + k, f"http://i.example/{k}", f"<div><p>own text {k} which is longer than that line</p>{line if k < 9 else ''}</div>") for k in range(90)]
    menu = "<div><p>Menu of all</p></div>"  # inside a copied wrapper, and on pages of their own
    text = "<p>" + "a long text that stands on some pages " * 3 + "</p>"
    rows += [(300 + k, f"http://j.example/{k}", f"<i>{k}</i><div>{menu}{text}</div>") for k in range(9)]
    rows += [(320 + k, f"http://j.example/o{k}", f"<div>{menu}<p>story number {k} of this site</p></div>") for k in range(20)]
    by = {r.page_id: r.text for r in H.extract(frame(rows, PAGES)).collect()}
    assert all(by[k] == "one page\n\nall its text\n\nin three parts" for k in range(20))
    assert all("on a tenth" in by[100 + k] for k in range(9))
    assert all("Menu" not in by[300 + k] and "a long text" in by[300 + k] for k in range(9))
    assert all(by[320 + k] == f"story number {k} of this site" for k in range(20))


@pytest.mark.parametrize("pages", [2, 3, 7])
def test_template_of_a_small_host_is_removed(frame, pages):
    rows = [(k, f"http://s.example/{k}", f"<div><p>Site of ours</p></div><div><p>story {k} of this small site, longer than its menu</p></div>"
             + ("<p>said twice</p>" if pages > 4 and k < 2 else "")) for k in range(pages)]
    rows += [(50, "http://one.example/", "<p>Alone</p><p>on its host with a text</p>")] * 2
    by = {r.page_id: r.text for r in H.extract(frame(rows, PAGES)).collect()}
    assert by.pop(50) == "Alone\n\non its host with a text"
    assert by == {k: f"story {k} of this small site, longer than its menu" + ("\n\nsaid twice" if pages > 4 and k < 2 else "")
                  for k in range(pages)}


@pytest.mark.parametrize("url,key", [
    ("http://M.Example.com:80/a/B?x=1#top", "com,example,m)/a/B?x=1"), ("https://e.org", "org,e)/"), ("http://h:8080/", "h:8080)/"),
    (None, ""), ("", ""), ("no url", ")no%20url"), ("http://[bad", "http://[bad")])
def test_url_keys(url, key):
    assert W.url_key(url) == key


@pytest.mark.parametrize("lines", [3, W.LINES])
def test_archive_round_trip(spark, frame, monkeypatch, tmp_path, lines):
    monkeypatch.setattr(W, "LINES", lines)
    big = "é" * 80  # 160 bytes
    rows = [(k, f"http://x.org/{k % 4}", f"page {k}") for k in range(25)]
    rows += [(50, "http://b.org/", big), (40, "http://a.org/", big), (60, "http://b.org/\r\nX: y", big), (40, "http://a.org/", big),
             (None, "http://n.org/", big), (70, None, "x" * 200), (71, "http://x.org/0", None), (None, None, "y" * 150), (None, None, "y" * 150),
             (80, "http://s.org/", "z" * 99), (81, "http://s.org/", "z" * 99)]
    df = frame(rows, PAGES).repartition(3)
    captures = W.write(df, f"file://{tmp_path}/w")
    blocks = W.build_index(captures)
    assert lines != 3 or blocks.count() >= len(rows) // 3
    got = W.fetch(W.lookup(blocks, captures.select("key")), f"file://{tmp_path}/w").collect()
    assert len(got) == len(rows)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [a for a, _, b in rows if (b or "").encode() == data and len(data) >= 100 and a is not None]
        to = min(same) if same and i != min(same) else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")
    asked = spark.createDataFrame([("org,x)/1",), ("org,x)/99",), ("",), ("zzz",), (None,), ("org,x)/1",)], "key string")
    found = sorted(W.lookup(blocks, asked).select("key", "page_id").collect(), key=str)
    assert sorted(str((r.key, r.page_id)) for r in found) == sorted(
        str((W.url_key(u), i)) for i, u, _ in rows if W.url_key(u) in ("org,x)/1", ""))
    files = list((tmp_path / "w").iterdir())
    import gzip
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\n") for f in files if f.suffix == ".gz") == len(rows)


def test_empty_archive(frame):
    assert W.round_trip(frame([], PAGES)).count() == 0
