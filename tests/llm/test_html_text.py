"""Text of pages against stated results, and repeats of a host against comparing all pages."""

import random

import numpy as np
import pytest

from tintflow.llm import html_text, queries

PAGES = [
    ("<article><h1>T &amp; t</h1><p>a <b>b</b>\n\n c<p>d</article><footer>x</footer>", "T & t\na b c\nd"),
    ("<nav><ul><li>m</ul></nav><div class='ad'>no</div><main>x<br>y<script>var p='</main>'</script>z</main>tail", "x yz"),
    ("<article><header>h</header><aside>s</aside><p>one</p><div id=comments><p>c</p></div><form>f</form><p>two</article>", "one\ntwo"),
    ("<article><p>1 < 2 &lt; 3 &nosuch; &#x41;&#66 <!-- <p>gone</p> --> end", "1 < 2 < 3 &nosuch; AB end"),
    ("<ARTICLE CLASS=\"post\"><P>Up<TABLE><TR><TD>1<TD>2<TR><TD>3</TABLE></ARTICLE>", "Up\n1\n2\n3"),
    ("<div class='cookie-notice'>we use</div><article><ul><li>a<ul><li>b</ul><li>c</ul></article></div></p>", "a\nb\nc"),
    ("<article><p>cut <a href='x>y", "cut y"), ("<article><p>cut <a href=", "cut"),
    ("<aside><article>no</article></aside><article>yes</article>", "yes"),
    ("plain text only", "plain text only"), ("", ""), (None, ""), ("<p>", ""), ("<style>p{}</style><title>t</title>", ""),
    ("<article>" + "<div>" * 300 + "deep " * 5000 + "</article>", ("deep " * 5000).strip()),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_pages(page, text):
    found = html_text.blocks(page or "")
    assert (html_text.main_text(found) or "\n".join(t for kind, t in found if kind == "loose")) == text


@pytest.mark.parametrize("page,text", [
    ("<article class='post comments-open'><p>one</article>", "one"), ("<main class='has-sidebar'>two</main>", "two"),
    ("<div class='layout no-sidebar'><article>three</article><div class=sidebar>no</div></div>", "three"),
    ("<div id='widget'><article>four</article></div>", "four"), ("<div class='search'><main>five</main></div>", "five"),
    ("<article>a<section id='related-work'><h2 id='header-files'>b</h2>c</section><h2 id=related>d</h2></article>", "a\nb\nc\nd"),
    ("<article class='sponsored'>six<div class='post-comments'>no</div><div class='ad-slot-2 x'>no</div></article>", "six"),
    ("<main><p>seven</p><div id=comments><article>no</article></div></main><div class=related-posts><article>no</article></div>", "seven")])
def test_names_drop_no_article(page, text):
    assert html_text.main_text(html_text.blocks(page)) == text


def test_query(spark, tmp_path):
    rows = [(i, f"http://h{i}.example/{i}", page, "x", 1) for i, (page, _) in enumerate(PAGES)] + [(None, None, None, None, None)]
    rows += rows[:2]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    df = queries.QUERIES["op8_html_text"](spark, str(tmp_path))
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    expected = [(i, url, PAGES[i][1] if i is not None else "", len(PAGES[i][1]) if i is not None else 0) for i, url, *_ in rows]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)
    assert queries.QUERIES["op8_html_text"](spark.newSession(), str(tmp_path)).where("false").collect() == []


def by_force(pages, size):
    """Tokens that no run of ``size`` tokens shared with another page of the host covers."""
    tokens = [(host, [t.split() for t in parts]) for host, parts in pages]
    runs = {}
    for i, (host, parts) in enumerate(tokens):
        flat = sum(parts, [])
        for at in range(len(flat) - size + 1):
            runs.setdefault((host, *flat[at:at + size]), set()).add(i)
    out = []
    for host, parts in tokens:
        flat, gone = sum(parts, []), set()
        for at in range(len(flat) - size + 1):
            if len(runs[(host, *flat[at:at + size])]) > 1:
                gone.update(range(at, at + size))
        kept, start = [], 0
        for part in parts:
            run = " ".join(t for i, t in enumerate(part, start) if i not in gone)
            start += len(part)
            kept += [run] if run else []
        out.append("\n".join(kept))
    return out


def test_runs_that_a_host_repeats_go(spark, tmp_path):
    common = "all rights reserved by the owner of this site since 1999"
    pages = [(f"h{i % 3}", [f"{common} page", f"unique text number {i} of many {i * i}", common if i % 2 else f"by the owner {i}"]) for i in range(12)]
    pages.append(("alone", [common, "only one page here"]))
    rows = [(i, f"https://{host.upper()}/p/{i}", "".join(f"<p>{t}</p>" for t in parts)) for i, (host, parts) in enumerate(pages)]
    rows.append((99, "https://alone/x", f"<article>{common} stays</article>"))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in queries.QUERIES["op8_html_text"](spark, str(tmp_path)).collect()}
    assert [found[i] for i in range(len(pages))] == by_force(pages, html_text.LONG)
    assert found[99] == f"{common} stays"


def test_copied_pages_keep_their_text(spark, tmp_path):
    article = " ".join(f"word{i}" for i in range(200))
    pages = [article, article, f"{article} printed on monday", "a page of its own " + " ".join(f"other{i}" for i in range(30))]
    rows = [(i, f"https://h/p/{i}", f"<nav>home</nav><p>{text}</p>") for i, text in enumerate(pages)]
    found = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [found[i] for i in range(len(pages))] == pages


def test_suffixes_are_ordered_as_by_comparing_them(spark):
    draw = random.Random(5)
    streams = [(n, f"h{n % 2}", [draw.choice("abc") for _ in range(draw.choice([0, 1, 7, 8, 9, 30]))]) for n in range(24)]
    made = spark.createDataFrame(streams, "stream long, host string, tokens array<string>").selectExpr("stream", "host", "posexplode(tokens) as (at, token)")
    ordered = {(r["stream"], r["at"]): r["rank"] for r in html_text.suffix_order(made).collect()}
    key = {(n, at): (host, tokens[at:at + html_text.LONG]) for n, host, tokens in streams for at in range(len(tokens))}
    places = {repr(k): place for place, k in enumerate(sorted({repr(k): k for k in key.values()}.values()))}
    assert ordered == {at: places[repr(k)] for at, k in key.items()}


def test_a_repeat_around_the_text_takes_nothing_of_it(spark):
    pages = [(n, "http://h/" + str(n), f"<p>{' '.join(f'w{n}x{i}' for i in range(20))}</p><footer>{'same words again ' * 4}</footer>") for n in range(3)]
    found = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {n: " ".join(f"w{n}x{i}" for i in range(20)) for n, *_ in pages}


def test_runs_of_an_article_of_the_host_stay(spark):
    passage, notice = " ".join(f"quoted{i}" for i in range(12)), " ".join(f"notice{i}" for i in range(12))
    own = [" ".join(f"own{n}x{i}" for i in range(40)) for n in range(2)]
    pages = [(n, f"http://h/{n}", f"<p>{own[n]}<p>{passage}<p>{notice}") for n in range(2)]
    pages += [(2, "http://h/2", f"<article><p>before {passage} after</article>"), (3, "http://other/3", f"<main>{notice}</main>")]
    found = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {
        0: f"{own[0]}\n{passage}", 1: f"{own[1]}\n{passage}", 2: f"before {passage} after", 3: notice}


def test_loose_text_against_comparing_all_pages(spark):
    draw, size = random.Random(11), html_text.LONG
    runs = [" ".join(draw.choice("abcdefgh") for _ in range(10)) for _ in range(6)]

    def part():
        return " ".join(draw.choice([*runs, *(f"w{draw.randrange(10**9)}" for _ in range(6))]) for _ in range(9))
    pages = [(n, f"h{n % 3}", draw.choice(["p", "p", "article"]), part(), part()) for n in range(30)]
    found = html_text.extract(spark.createDataFrame(
        [(n, f"http://{host}/{n}", f"<{tag}>{text}</{tag}><footer>{foot}</footer>") for n, host, tag, text, foot in pages],
        "page_id long, url string, html string")).collect()

    def windows(text):
        tokens = text.split()
        return [tuple(tokens[at:at + size]) for at in range(len(tokens) - size + 1)]
    expected = {}
    for n, host, tag, text, _ in pages:
        same = [p for p in pages if p[1] == host]
        held = {w for p in same if p[2] == "article" for w in windows(p[3])}
        others = {w for p in same if p[0] != n for t in p[3:] if not (t is p[3] and p[2] == "article") for w in windows(t)}
        covered = np.zeros(len(text.split()), bool)
        for state, those in ((True, others), (False, held)):
            for at, w in enumerate(windows(text)):
                if w in those:
                    covered[at:at + size] = state
        gone = html_text.without_most(covered) if tag == "p" else np.zeros(len(covered), bool)
        expected[n] = " ".join(t for t, g in zip(text.split(), gone) if not g)
    assert {r["page_id"]: r["text"] for r in found} == expected
    assert any(expected[n] != text for n, _, tag, text, _ in pages if tag == "p")
