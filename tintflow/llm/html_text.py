"""Main text of web pages: page structure first, then what a host repeats, found in the order of the host's suffixes.

A page's markup is read into blocks. Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are known
by their elements or by the names in their class, id and role; scripts, styles and comments are no text. A name marks an
element if it consists of words of MARKS and FILLERS only. It never marks ``html``, ``body``, ``main`` or ``article`` itself, nor,
as an id, a heading; a ``main`` inside a marked element counts, and an ``article`` there (a comment, a teaser, or the page's
text in a marked wrapper) counts where the page has no other. Blocks inside an
``article`` or ``main`` element are the main text and protected: a host that serves one article under several addresses
repeats it as a whole, so repetition says nothing about them. On a page without such an element every other block counts
as loose, and of it only the runs that the host does not repeat are kept.

Of the token streams of all pages of a host the suffixes are ordered by prefix doubling, up to ``LONG`` tokens deep. Neighbours in that
order with ``LONG`` tokens or more in common are a run; runs that distinct pages hold outside protected blocks are a long repeat, and their tokens are
covered. A run that a protected block of the host holds is main text wherever it stands, and its tokens stay. Where no page of a host has loose text,
nothing can be covered, and its protected blocks are not ordered.
Keys are sorted once each and runs are judged by partial minima and maxima, so neither a host nor a repeat with a third of all pages meets in one task.

Repeats say nothing about a page as a whole: pages with the same loose text count as one, and a covered run that holds
``MOST`` of a page's loose tokens or more is kept, so that copies and near copies of an article keep their text.

Defined results: a null or empty page has an empty text; a null url is a host of its own; an end tag without a start is
ignored, an element without its end reaches to its parent's end; white space is Unicode's; equal rows get equal results and
are one page; other columns are not read. Whole pages are read, blocks of any length are kept.
"""

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintflow.llm.common import numbered, staged
from tintflow.operators.lookup import key_bits, may_be_wanted

LONG = 8  # tokens from which on a repeat is boilerplate
MOST = 0.75  # of a page's loose tokens, from which on a repeat is the page's text

# Elements of HTML and words that mark what is not the main text.
NO_TEXT = "head iframe noscript object script style svg template title video audio canvas math".split()
ASIDE = "nav header footer aside form menu dialog button select textarea fieldset".split()
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo related replies reply respond share sharing sidebar social sponsor sponsored subscribe subscription widget "
    "contentinfo complementary search alert alertdialog".split())
FILLERS = frozenset(
    "a area article bar block bottom box buttons container content entry first form global group inner item items last left list "
    "main outer page panel post posts primary right secondary section site slot the top unit wrap wrapper".split())
MAIN = "article main".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
P = frozenset(["p"])
ENDED_BY = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
            "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|iframe|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAMES = re.compile(r"[^a-z0-9]+")


def is_mark(name: str) -> bool:
    parts = [part for part in NAMES.split(name) if part and not part.isdigit()]
    return not MARKS.isdisjoint(parts) and MARKS.union(FILLERS).issuperset(parts)


def set_aside(name: str, attributes: str) -> str | None:
    """aside for an element that is, marked for one whose class, id or role says so."""
    if name in ASIDE:
        return "aside"
    if "=" not in attributes or name in ("html", "body", *MAIN):
        return None
    return "marked" if any(is_mark(value) for kind, *found in MARKED.findall(attributes) if name not in HEADINGS or kind.lower() != "id"
                           for value in "".join(found).lower().split()) else None


def blocks(page: str) -> list[tuple[str, str]]:
    """The page's blocks in order, each as (kind, text): article, loose or aside."""
    out, parts = [], []
    stack: list[tuple[str, str]] = []  # open elements with the kind of text they hold

    def end_block():
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((stack[-1][1] if stack else "loose", text))

    def close(depth):
        if any(name in BLOCKS for name, _ in stack[depth:]) or stack[-1][1] != (stack[depth - 1][1] if depth else "loose"):
            end_block()
        del stack[depth:]

    for piece in PIECE.finditer(page):
        text, name = piece.group(), piece.group(3)
        if name is None:
            if text[0] != "<" or text == "<":
                if not stack or stack[-1][1] != "none":
                    parts.append(html.unescape(text) if "&" in text else text)
            continue
        name = name.lower()
        if piece.group(2):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                close(depth)
            elif name == "p":
                end_block()
            continue
        ended = ENDED_BY.get(name, frozenset()) | (P if name in BLOCKS else frozenset())
        while (depth := next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), None)) is not None \
                and stack[depth][0] in ended:
            close(depth)
        kind = stack[-1][1] if stack else "loose"
        if name in BLOCKS:
            end_block()
        if name in VOID:
            if name in ("br", "wbr"):
                parts.append(" " if name == "br" else "")
            continue
        if text.endswith("/>") and name not in BLOCKS:
            continue
        if name in NO_TEXT:
            inner = "none"
        elif kind in ("article", "held", "loose"):
            inner = set_aside(name, piece.group(4)) or ("article" if name == "main" or name == "article" and kind == "loose" else kind)
        elif kind == "marked":
            inner = "aside" if name in ASIDE else "article" if name == "main" else "held" if name == "article" else kind
        else:
            inner = kind
        if inner != kind:
            end_block()
        stack.append((name, inner))
    end_block()
    held = "aside" if any(kind == "article" for kind, _ in out) else "article"
    return [({"marked": "aside", "held": held}.get(kind, kind), text) for kind, text in out]


def main_text(found: list[tuple[str, str]]) -> str | None:
    """The protected blocks, or None on a page without any."""
    kept = [text for kind, text in found if kind == "article"]
    return "\n".join(kept) if kept else None


def ranked(suffixes: DataFrame, by: list[str]) -> DataFrame:
    """``suffixes`` staged with their ``rank`` in the order of ``by``, equal ones alike: the distinct keys are range-sorted and numbered."""
    keys = numbered(suffixes.select(*by).distinct(), by, "rank", "suffix-keys")
    return staged(suffixes.join(keys, by).drop(*by), "suffix-order")


def suffix_order(suffixes: DataFrame) -> DataFrame:
    """Every suffix (stream, at, host, token, ...) with its place among all of its host, by prefix doubling.

    By their first token first, then by the ranks of their first and second halves, 2, 4 and more tokens, until ``LONG`` are compared: equal
    ranks are runs of neighbours with a common prefix of ``LONG`` or more. A longer repeat is a run at each of its places, so no deeper
    order is needed. A stream's end comes before every token.
    """
    ordered, depth = ranked(suffixes, ["host", "token"]), 1
    while depth < LONG:
        step = min(depth, LONG - depth)
        second = F.lead("rank", step, -1).over(Window.partitionBy("stream").orderBy("at"))
        ordered, depth = ranked(ordered.withColumn("second", second).withColumnRenamed("rank", "first"), ["first", "second"]), depth + step
    return ordered


def without_most(covered: np.ndarray) -> np.ndarray:
    """``covered`` without the run that holds most of the tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
    for start, end in edges.reshape(-1, 2):
        if end - start >= MOST * len(covered):
            covered[start:end] = False
    return covered


def host_of(url: str | None) -> str:
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found.group(1).lower() if found else f"?{url}"


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per row: id, url, text, n_chars."""
    pages = pages.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("id"), F.col(url_column).alias("url"),
                         F.coalesce(F.col(html_column), F.lit("")).alias("html"))
    id_type = pages.schema["id"].dataType.simpleString()

    def streams(batches):
        for batch in batches:
            out = {"host": [], "free": [], "rest": [], "loose": []}
            for url, page in zip(batch.column(2).to_pylist(), batch.column(3)):
                found = blocks(page.as_py())
                free = [text for kind, text in found if kind == "loose"] if main_text(found) is None else []
                rest = [text for kind, text in found if kind == "aside" or kind == "loose" and not free]
                out["host"].append(host_of(url))
                out["free"].append(" ".join(free).split())
                out["rest"].append(" ".join(rest).split())
                out["loose"].append(free if main_text(found) is None else None)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, range(3)), pa.array(out["host"], pa.string()),
                 *(pa.array(out[name], pa.list_(pa.string())) for name in ("free", "rest", "loose"))],
                ["_row", "id", "url", "host", "free", "rest", "loose"])

    def with_host(batches):
        for batch in batches:
            hosts = pa.array(map(host_of, batch.column(1).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), hosts, batch.column(2)], ["_row", "host", "html"])

    def held_streams(batches):
        for batch in batches:
            tokens = [(main_text(blocks(page.as_py())) or "").split() for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.list_(pa.string()))], ["_row", "host", "tokens"])

    def protected(batches):
        for batch in batches:
            texts = [main_text(blocks(page.as_py())) for page in batch.column(2)]
            some = pa.array([t is not None for t in texts], pa.bool_())
            sizes = pa.array([t and len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
                                             ["id", "url", "text", "n_chars"]).filter(some)

    def unique_runs(batches):
        for batch in batches:
            texts = []
            for loose, at, main_at in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                sizes = [len(text.split()) for text in loose]
                covered = np.zeros(sum(sizes), bool)
                for start in at or ():
                    covered[start:start + LONG] = True
                for start in main_at or ():
                    covered[start:start + LONG] = False
                covered = without_most(covered)
                kept, start = [], 0
                for text, size in zip(loose, sizes):
                    tokens = text.split()
                    run = " ".join(t for t, gone in zip(tokens, covered[start:start + size]) if not gone)
                    start += size
                    if run:
                        kept.append(run)
                texts.append("\n".join(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], ["id", "url", "text", "n_chars"])

    shape = f"id {id_type}, url string, text string, n_chars long"
    read = staged(pages.select("_row", "id", "url", "html").mapInArrow(
        streams, f"_row long, id {id_type}, url string, host string, free array<string>, rest array<string>, loose array<string>"), "page-streams")
    page = F.when(F.size("loose") > 0, F.xxhash64(F.array_join("loose", " "))).otherwise(F.xxhash64("id", "url"))
    # A page is two streams, each ending with itself: its loose text, and what surrounds the text.
    streams_of = F.array(*[F.struct((F.col("_row") * 2 + part).alias("stream"), F.col(name).alias("tokens")) for part, name in enumerate(("free", "rest"))])
    suffixes = (read.select(page.alias("page"), "host", F.inline(streams_of)).withColumn("n", F.size("tokens"))
                .select("page", "host", "stream", "n", F.posexplode("tokens").alias("at", "token")))
    # Protected text is a stream of no page, numbered below 0, of each page whose host has loose text; a host too many changes nothing.
    loose_hosts = read.where(F.size("free") > 0).select("host").distinct()
    placed = pages.select("_row", "url", "html").mapInArrow(with_host, "_row long, host string, html string")
    held = staged(may_be_wanted(placed, loose_hosts, key_bits(loose_hosts, "host"), "host").mapInArrow(
        held_streams, "_row long, host string, tokens array<string>"), "held-streams")
    suffixes = suffixes.unionByName(held.select(F.lit(None).cast("long").alias("page"), "host", (-1 - F.col("_row")).alias("stream"), F.size("tokens").alias("n"),
                                                F.posexplode("tokens").alias("at", "token")))
    ordered = suffix_order(suffixes).where(F.col("at") + LONG <= F.col("n"))
    runs = (ordered.groupBy("rank").agg(F.expr("min(page) <> max(page)").alias("repeated"), F.expr("min(stream) < 0").alias("main"))
            .where("repeated or main"))
    free = ordered.where("stream >= 0 and stream % 2 = 0").select(F.expr("stream div 2").alias("_row"), "at", "rank")
    covered = free.join(runs, "rank").groupBy("_row").agg(
        F.collect_list(F.when(F.col("repeated"), F.col("at"))).alias("at"), F.collect_list(F.when(F.col("main"), F.col("at"))).alias("main_at"))
    loose = read.where(F.col("loose").isNotNull()).select("_row", "id", "url", "loose").join(covered, "_row", "left")
    loose = loose.select("id", "url", "loose", "at", "main_at").mapInArrow(unique_runs, shape)
    found = pages.select("id", "url", "html").mapInArrow(protected, shape).unionByName(loose)
    return found.withColumnsRenamed({"id": id_column, "url": url_column})
