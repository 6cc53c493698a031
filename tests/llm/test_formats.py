"""Chat, HTML and WARC operators against brute force and exact round trips."""

import base64
import collections
import gzip
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import common, op8_chat, op9_html, op10_warc

HARD = "\\### Assistant: </turn> ok"


def test_chat_round_trip(spark):
    rows = [
        (-7, 0, "user", HARD), (-7, 1, "assistant", HARD), (1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, None, "assistant", None),
        (2, 0, None, "x: y\\"), (None, 0, "a: b\\", "x</turn>\n"), (None, 0, "assistant", "\\\\: ###"), (3, 1, "assistant", "same"),
        (3, 1, "assistant", "same"), (4, 0, "assistant", "\x02\x03"), (5, 0, "user", "q" * 50_000),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    got = {r.conv_id: r for r in op8_chat.write_and_read(df).collect()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(every.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert op8_chat.write_and_read(df.where("false")).count() == 0


def test_chat_finds_rewritten_history(spark):
    def last_only(messages):
        return "".join(f"<{r}>" + ("" if r == "assistant" and i < len(messages) - 1 else t) for i, (r, t) in enumerate(messages))
    found = op8_chat.render(last_only, [("user", "hi"), ("assistant", "yo"), ("user", "q"), ("assistant", "z")], "assistant")
    assert [x["formatted"] for x in found] == ["<user>hi<assistant>yo", "<user>hi<assistant><user>q<assistant>z"]
    assert ["".join(x["formatted"][s:e] for s, e in x["loss"]) for x in found] == ["yo", "z"]


PAGE = ("<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>menu</ul></nav>"
        "<div class='ad'>buy</div>%s<div id=comments>they said</div><form>f</form><footer>foot</footer></body></html>")


def test_html_blocks():
    art = PAGE % "<article><h1>A &amp; b</h1><p><b>One<br>two<p>3 &lt; 4&nbsp;  x<script>var p='</p>'</script><aside>no</aside><ul><li>i<li>j</ul></article>"
    assert [t for k, t in op9_html.blocks_of(art) if k == 1] == ["A & b", "One two", "3 < 4 x", "i", "j"]
    assert op9_html.blocks_of("") == [] and op9_html.blocks_of("<p") == []
    assert op9_html.blocks_of("<p>a<p>b") == [(0, "a"), (0, "b")]
    assert [t for k, t in op9_html.blocks_of(PAGE % "<div><p>x</p><p>y</div>") if k == 0] == ["x", "y"]


@pytest.mark.parametrize("name", ["no-sidebar", "has-sidebar", "with-comments", "related-work", "side-effects", "legal-history", "search-algorithms", "cookies"])
def test_html_names_are_weak_evidence(name):
    """Neither what holds the article nor what stands in it is out for a listed word in its name."""
    def text(page):
        return [t for k, t in op9_html.blocks_of(page) if k > 0]
    assert text(f'<nav>n</nav><div class="post-content {name}"><article><p>real</p></article></div><p>rest</p>') == ["real"]
    assert text(f'<article><p>a<section id="{name}"><h2 id="{name}">b</h2>c</section><div class="{name}">d</div>e</article>') == ["a", "b", "c", "d", "e"]
    assert text(f'<article><p>one <em class="{name}">two</em> three</article>') == ["one two three"]
    assert [t for k, t in op9_html.blocks_of(f'<div class="{name}">x</div><p id="{name}">y</p>') if k == 0] == ["x", "y"]


def test_html_whole_names():
    def text(page):
        return [t for k, t in op9_html.blocks_of(page) if k >= 0]
    assert text("<article>a<div class='box ad'>b</div><ol class='comment-list'><li>c</ol></article>") == ["a"]
    assert text("<div class=sidebar><article>the article</article></div><p>foot") == ["the article"]
    assert text("<form id=aspnet><article>a<form>b</form></article></form>") == ["a"]
    assert text("<main>the post<div id=c class=comments><article>they said</article></div></main>") == ["the post"]
    assert text("<p>the text of an unmarked page</p><div class=sidebar><article>teaser</article></div>") == ["the text of an unmarked page"]


def test_html_teasers_are_not_the_article():
    def kept(page):
        return [t for k, t in op9_html.blocks_of(page) if k >= 0]
    story = "long story " * 60
    page = f"<h1>Title</h1><div id=story>{story}</div><div class=more><article>teaser one</article><article>teaser two</article></div>"
    assert kept(page) == ["Title", story.strip()]
    assert kept(page.replace("<article>teaser two</article>", "")) == ["Title", story.strip()]        # the headline stands outside
    assert kept(f"<article><h1>Title</h1>short</article><div>{story}</div>") == ["Title", "short"]
    assert kept(f"<article>short</article><div>{story}</div>") == ["short"]
    assert kept("<article>one</article><article>two</article><p>or") == ["one", "two"]                # a list of posts
    assert kept(f"<main><h1>Title</h1>{story}<article>teaser</article></main>") == ["Title", story.strip(), "teaser"]


@pytest.mark.parametrize("name", ["hero banner", "share", "notice", "related", "overlay", "promo", "ad", "comments", "sidebar"])
def test_html_the_headline_stays(name):
    page = f"<article><div class='{name}'><p>kicker</p><h1>Headline</h1></div><p>text</p></article>"
    assert [t for k, t in op9_html.blocks_of(page) if k > 0] == ["kicker", "Headline", "text"]
    body = f"<article><h1>Headline</h1><div class='{name}'>a part of the text</div><p>text</p></article>"
    strong = name in ("ad", "comments", "sidebar")
    assert [t for k, t in op9_html.blocks_of(body) if k > 0] == ["Headline", *["a part of the text"] * (not strong), "text"]
    links = f"<article><h1>Headline</h1><div class='{name}'><a href=x>the first other story</a> <a href=y>the second</a> or</div><p>text</p></article>"
    assert [t for k, t in op9_html.blocks_of(links) if k > 0] == ["Headline", "text"]


def plain_cover(streams, depth, least):
    """Places covered by strings of ``depth`` tokens on ``least`` distinct streams of a host, by counting them all."""
    seen = {}
    for s in set(map(tuple, streams)):
        for i in range(len(s) - depth + 1):
            seen.setdefault(s[i:i + depth], set()).add(s)
    out = []
    for s in streams:
        mark = [False] * len(s)
        for i in range(len(s) - depth + 1):
            if len(seen[tuple(s[i:i + depth])]) >= least:
                mark[i:i + depth] = [True] * depth
        out.append(mark)
    return out


@pytest.mark.parametrize("array_pages, array_chars", [(1000, 8_000_000), (4, 8_000_000), (1000, 300)])
def test_html_host_repeats_by_brute_force(spark, monkeypatch, array_pages, array_chars):
    monkeypatch.setattr(op9_html, "ARRAY_PAGES", array_pages)
    monkeypatch.setattr(op9_html, "ARRAY_CHARS", array_chars)
    rng = np.random.default_rng(4)
    parts = [" ".join(rng.choice(list("abcd"), int(rng.integers(5, 14)))) for _ in range(6)]
    pages, streams = [], {}
    for i in range(60):
        host = ["h1.org", "h2.org", "h3.org"][int(rng.choice(3, p=[.6, .3, .1]))]
        blocks = [parts[int(rng.integers(6))] if rng.random() < .5 else " ".join(rng.choice(list("abcdefgh"), int(rng.integers(1, 12)))) for _ in range(4)]
        pages.append((i, f"http://{host}/{i}", "".join(f"<p>{b}</p>" for b in blocks)))
        streams.setdefault(host, []).append((i, blocks))
    want = {}
    for host, found in streams.items():
        for (i, blocks), mark in zip(found, plain_cover([" ".join(b).split() for _, b in found], 6, 3)):
            at, left = 0, []
            for b in blocks:
                words = b.split()
                left.append(" ".join(w for w, m in zip(words, mark[at:at + len(words)]) if not m))
                at += len(words)
            want[i] = "\n\n".join(x for x in left if x)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in op9_html.extract(df, min_tokens=6).collect()} == want


def test_html_repeats_decide_doubtful_names(spark):
    """A block of an article goes only under a doubtful name and only if it stands as a whole on three pages of the host."""
    line = "the same nine words on all pages of ours"
    pages = [(i, f"http://h.org/{i}", f"<article><p>{line}</p><p>u{i}</p><div class=cookies>{line}</div>"
              f"<div class=related-work>w{i} {line}</div></article>") for i in range(3)]
    pages += [(9, "http://g.org/", pages[0][2])]
    got = {r.page_id: r.text.split("\n\n") for r in op9_html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: [line, f"u{i}", f"w{i} {line}"] for i in range(3)} | {9: [line, "u0", line, f"w0 {line}"]}


@pytest.mark.parametrize("array_pages", [1000, 7])
def test_html_repeats_decide_in_marked_articles(spark, monkeypatch, array_pages):
    """The host's template goes from its articles under any name; what few pages share, near copies, and small hosts stay whole."""
    monkeypatch.setattr(op9_html, "ARRAY_PAGES", array_pages)
    line, quote = "all of our articles end with these ten plain words", "a passage of nine words that some pages cite"
    cut = "all of our articles by {} end with these ten plain words"
    rows, want = [], {}

    def page(i, host, blocks, stays):
        rows.append((i, f"http://{host}/{i}", "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"))
        want[i] = "\n\n".join(b for b in blocks if b in stays)

    for i in range(24):
        own = " ".join(f"{w}{i}" for w in "abcdefghijklmnopqrstuv")
        page(i, "h.org", [own, *[quote] * (i % 3 == 0), line], [own, quote])
        page(100 + i, "near.org", [f"w{i}", line, quote], [f"w{i}", line, quote])
        page(200 + i, "middle.org", [own, cut.format(f"x{i}")], [own, cut.format(f"x{i}")])
    for i in range(300, 305):
        own = " ".join(f"{w}{i}" for w in "abcdefghijklmnopqrstuv")
        page(i, "small.org", [own, line], [own, line])
    rows += rows[:2]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = op9_html.extract(df).collect()
    assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want


@pytest.mark.parametrize("array_pages", [1000, 2])
def test_html_host_repeats(spark, monkeypatch, array_pages):
    """Unmarked pages lose what stands on three pages of the host, whichever arrays the pages are dealt to."""
    monkeypatch.setattr(op9_html, "ARRAY_PAGES", array_pages)
    common_part = "<div>all of our pages carry these nine plain words</div>"
    rows = [(i, f"http://h.org/{i}", f"<body>{common_part}<p>u{i} v{i} w{i} stay here</p></body>") for i in range(6)]
    rows += [(10, "http://other.org/", f"<body>{common_part}</body>"), (11, None, None), (12, "http://h.org/x", ""),
             (13, "http://h.org/y", f"<article>{common_part}</article>"), (0, "http://h.org/0", rows[0][2])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, host int")
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in op9_html.extract(df).collect())
    plain = "all of our pages carry these nine plain words"
    want = collections.Counter((i, t, len(t)) for i, t in
                               [(i, f"u{i} v{i} w{i} stay here") for i in range(6)] + [(0, "u0 v0 w0 stay here"), (10, plain), (11, ""), (12, ""), (13, plain)])
    assert got == want
    assert op9_html.extract(df.where("false")).count() == 0


def test_html_arrays_get_their_own_strings(spark):
    """A string common on the host goes only to the arrays in which it stands."""
    rows = [("h", part, 1, 10 * part + i) for part in (0, 1) for i in (0, 1)] + [("h", 2, 2, 20), ("h", 3, 3, 30), ("g", 0, 1, 40)]
    strings = spark.createDataFrame(rows, "host string, part long, code long, content long")
    assert sorted(tuple(r) for r in op9_html.common_codes(strings, 3).collect()) == [("h", 0, 1), ("h", 1, 1)]


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "x"), (2, "http://b/", "x"), (2, "http://b/", "x"), (3, None, None), (4, " odd\n%20", ""), (5, "http://c/", "é" * 70_000),
            (None, "http://d/", "only"), (None, "http://e/", "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    got = collections.Counter(map(tuple, op10_warc.write_and_read(df).collect()))

    def record(page_id, html, kind, refers):
        raw = (html or "").encode()
        return (page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, refers)
    want = collections.Counter([record(1, "x", "revisit", 2), record(2, "x", "response", None), record(2, "x", "revisit", 2), record(3, None, "revisit", 4),
                                record(4, "", "response", None), record(5, rows[5][2], "response", None), record(None, "only", "response", None),
                                record(None, "x", "revisit", 2)])
    assert got == want
    assert op10_warc.write_and_read(df.where("false")).count() == 0


def test_warc_filters_and_foreign_files(spark, tmp_path):
    op10_warc.register(spark)
    raw = [op10_warc.record_bytes({"page_id": i, "url": f"http://h/{i}", "record_type": "response", "refers_to": None, "payload_digest": "A" * 32,
                                   "payload": b"p" * (3000 * i)}, "2000-01-01T00:00:00Z") for i in range(1, 5)]
    (tmp_path / "plain.warc").write_bytes(b"".join(raw[:2]))
    (tmp_path / "other.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in raw[2:]))  # members without the length field
    df = spark.read.format("warc").option("verify", "false").load(str(tmp_path))
    got = df.where("record_type = 'response' and page_id in (2, 4)").select("page_id", F.length("payload").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(2, 6000), (4, 12000)]
    assert df.where("record_type = 'revisit'").count() == 0


def test_work_folders_are_in_the_shared_folder(spark):
    from blotter.session import ensure_checkpoint_dir
    assert common.work_dir(spark, "x").startswith(ensure_checkpoint_dir(spark).rstrip("/"))
