"""Main-text extraction from HTML with host-wide repeats as evidence.

Each page is parsed once into blocks. Markup decides what it can: scripts,
styles, forms, navigation, asides, footers, page headers and elements with a role
or a whole class name of notices, adverts, sidebars, menus or reader comments are
out; where a page marks its article (``article``, ``main``), the article's blocks
are the text, in whole, even if other pages carry the same words (but for blocks of
the host's template, see below).

A page's article is what ``article`` or ``main`` marks, unless that is less text
than what stands beside it and there are several such elements, or the headline
(``h1``) stands outside: then these are teasers of other pages, and go.

Names are evidence of their own only as a whole class token (or, outside
articles, as the whole id) that means a page part and nothing else. An element
that holds the page's article, or inside it the headline, is never dropped for its
name; inside an article words such as ``share``, ``notice`` or ``related`` are
doubtful, and an element of that kind goes if nearly all of it is links. A part's name inside
a longer one (``related-work``), a word that is a subject as well (``cookies``)
or, inside an article, an id decides nothing: outside articles such an element
is judged like any other, inside one a block of it goes only if host repeats
cover it whole; sections and headings inside an article are not judged by an id
at all.

Everything but the plain blocks of marked articles forms the page's token stream. Per host the
streams of the pages are concatenated and sorted into a suffix array (to the
depth that matters), whose runs of equal ``min_tokens``-token strings tell on how
many distinct pages a string stands; strings on ``min_pages`` or more are
boilerplate. Covered tokens are removed from pages without a marked article; the
unique runs stay and are their text. Covered blocks with a doubtful name are
removed from articles. Pages with a marked article still count as
witnesses of what repeats on their host.

The plain blocks of marked articles meet the arrays too, where they can be covered
as a whole: blocks that begin and end with the same ``min_tokens`` tokens as blocks of
``min_pages`` pages of the host. A block so covered is part of the host's template,
and goes, if it stands on half of the host's distinct pages, the host has
``TEMPLATE_PAGES`` of them, and what would go is at most half of the article (else
the pages are near copies). Fewer repeats are quotations, licences or copied
passages: text that the article holds. Pages with equal streams count as one page, so
copies of a page do not erase each other.

A host's pages are dealt to suffix arrays of bounded size; strings of hosts with
several are counted per array and summed over the host by hash, so the result is
that of one array. Nothing is capped.

Defined cases: null or empty html gives an empty text; a null or hostless url is
a host of its own name ''; repeated rows are extracted each; unclosed, crossed
and truncated markup is read to its end; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_TOKENS, MIN_PAGES = 8, 3
TEMPLATE_PAGES = 20     # distinct pages of a host from which its articles show a template
ARRAY_PAGES, ARRAY_CHARS = 1000, 8_000_000   # mean numbers of pages, and of characters, of one suffix array

# Element names of the HTML standard and common names of page parts.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
OUT = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "head",
       "fieldset", "label", "input", "datalist", "applet", "math"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "html", "blockquote", "aside", "nav", "header", "footer"}
# whole class tokens that mean a page part and nothing else
PART_NAMES = re.compile(
    r"ads?|adv|adverts?|advertisements?|advertising|adsense|adsbygoogle|ad-(?:slot|unit|box|banner|container|wrapper)|banner|banner-ad|sponsor(?:ed|s)?|"
    r"promo(?:tion|tions|ted|s)?|sidebar|side-?bar|aside|nav|navbar|navigation|(?:site|main|page)-nav(?:igation)?|nav-?menu|nav-links|menu|menubar|menu-item|"
    r"breadcrumbs?|footer|(?:site|page)-(?:footer|header)|masthead|topbar|toolbar|cookie-?(?:banner|notice|bar|consent|popup)|gdpr|notice|notification|"
    r"popup|modal|overlay|newsletter(?:-signup)?|subscribe|social(?:-share|-links|-buttons)?|share|sharing|share-(?:buttons|links)|related|"
    r"related-(?:posts|articles|links|stories)|recommended|recommendations|widget|widget-area|pagination|pager|skip-link|hidden", re.I)
# those that mean it inside an article too; the others (share, notice, related ...) may name a part of the text
PART_IN_ARTICLE = re.compile(
    r"ads?|adv|adverts?|advertisements?|advertising|adsense|adsbygoogle|ad-(?:slot|unit|box|banner|container|wrapper)|banner-ad|sponsor(?:ed|s)?|"
    r"sidebar|side-?bar|navbar|(?:site|main|page)-nav(?:igation)?|nav-?menu|nav-links|menubar|menu-item|breadcrumbs?|"
    r"cookie-?(?:banner|notice|bar|consent|popup)|gdpr|newsletter(?:-signup)?|subscribe|social(?:-share|-links|-buttons)?|share-(?:buttons|links)|"
    r"related-(?:posts|articles|links|stories)|pagination|pager|skip-link", re.I)
COMMENT_NAMES = re.compile(
    r"comments?|comments?-?(?:list|area|section|form|body|respond)|disqus(?:_thread)?|replies|respond", re.I)
# such a word as a part of a name, or one that is a subject too, tells nothing by itself
DOUBTFUL = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side|aside|nav|navbar|navigation|menu\w*|breadcrumbs?|"
    r"footer|masthead|topbar|toolbar|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"comments?|commentlist|disqus|replies|respond|social|share|sharing|related|recommend\w*|widget|pagination|pager|skip|hidden|"
    r"copyright|legal|disclaimer|search\w*)(?:$|[\s_-])", re.I)
ANCHORED = {"section", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
BY_NAME, BY_COMMENT, BY_MARKUP = 1, 2, 3    # why an element is out; the first two give way to the page's article
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "form", "note"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _judge(name: str, tag: str, inside_article: bool) -> tuple[int, bool]:
    """(why the element is out or 0, whether its name is doubtful)."""
    if name in OUT:
        return (BY_NAME if name == "form" else BY_MARKUP), False
    if name == "header":
        return (0 if inside_article else BY_MARKUP), False
    if " " not in tag and "\n" not in tag and "\t" not in tag:
        return 0, False
    why, doubtful = 0, False
    named = name not in ("html", "body") and not _is_article(name, tag)
    for key, a, b, c in _ATTR.findall(tag, len(name) + 1):
        key, value = key.lower(), a or b or c
        if named and (key == "class" or key == "id" and not inside_article):
            for token in value.split():
                if (PART_IN_ARTICLE if inside_article else PART_NAMES).fullmatch(token):
                    why = max(why, BY_NAME)
                elif COMMENT_NAMES.fullmatch(token):
                    why = max(why, BY_COMMENT)
        if named and inside_article and name not in INLINE and (key == "class" or key == "id" and name not in ANCHORED) and DOUBTFUL.search(value):
            doubtful = True
        if key == "role" and value.lower() in OUT_ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return BY_MARKUP, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return BY_MARKUP, False
    return why, doubtful


def _is_article(name: str, tag: str) -> bool:
    return name in ("article", "main") or "role" in tag and re.search(r"role\s*=\s*[\"']?(?:main|article)\b", tag, re.I) is not None


TOP = ("", 0, 0, 0, 0)
LINKED = 80     # percent of a doubtful element's text in links from which it is a list of links


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order; kind 1 article, 2 article under a doubtful name, 0 undecided, -1 out by markup."""
    # out or 0, kind, text, name that the element around the article is out by, named element in the article, holds the headline, characters in links
    out: list[tuple[int, int, str, int, int, bool, int]] = []
    stack: list[tuple[str, int, int, int, int]] = []   # tag name, and the first, second, fourth and fifth of these (each includes the parents')
    words: list[str] = []
    above: list[int] = [0]     # of each named element, the one around it
    linked, articles = 0, 0

    def flush():
        nonlocal linked
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            _, dropped, kind, around, named = stack[-1] if stack else TOP
            out.append((dropped, kind, text, around, named, any(e[0] == "h1" for e in stack), linked))
        linked = 0

    def close(k: int):
        parent = stack[k - 1] if k else TOP
        if any(e[0] not in INLINE or e[1:] != parent[1:] for e in stack[k:]):
            flush()
        del stack[k:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        token, at = m.group(), m.end()
        if token[0] != "<" or token == "<":
            words.append(html_lib.unescape(token) if "&" in token else token)
            if any(e[0] == "a" for e in stack):
                linked += len(" ".join(words[-1].split()))
            continue
        if token[1] in "!?":
            continue
        name = _NAME.match(token).group(1).lower()
        if token[1] == "/":
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name in RAW:  # everything up to the end tag is its own
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name == "br":
            words.append(" ")
            continue
        _, dropped, kind, _, _ = stack[-1] if stack else TOP
        goes, doubtful = _judge(name, token, kind > 0)
        if name not in INLINE or goes and not dropped or doubtful and kind == 1:
            flush()
        if name in VOID or token.endswith("/>") and name in ("svg", "path"):
            continue
        if name not in INLINE:  # an open paragraph ends where the next block begins
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        if name in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[name]:
                    close(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        _, dropped, kind, around, named = stack[-1] if stack else TOP
        if _is_article(name, token):
            articles += kind == 0
            kind = kind or 1
            if dropped in (BY_NAME, BY_COMMENT) and not named:  # may be the page's article: judged below
                dropped, around = 0, max(around, dropped)
        elif kind and not dropped and (goes in (BY_NAME, BY_COMMENT) or doubtful and kind == 1):
            above.append(named)
            named = len(above) - 1
            kind = 2 if doubtful and not goes else kind
        stack.append((name, max(dropped, goes), kind, around, named))
    flush()
    return _decide(out, above, articles)


def _decide(out: list[tuple[int, int, str, int, int, bool, int]], above: list[int], articles: int) -> list[tuple[int, str]]:
    """What becomes of the blocks, seen from the whole page."""
    # a named element in an article that holds the headline is part of it; one of links alone isn't
    headed, chars, links = {0}, [0] * len(above), [0] * len(above)
    for _, _, text, _, named, headline, linked in out:
        chars[named] += len(text)
        links[named] += linked
        while headline and named not in headed:
            headed.add(named)
            named = above[named]

    def judged(dropped: int, kind: int, named: int) -> int:
        if named and named in headed and dropped != BY_MARKUP:
            return 1
        return -1 if dropped or kind == 2 and 100 * links[named] >= LINKED * chars[named] else kind

    blocks = [(judged(dropped, kind, named), text, around, headline) for dropped, kind, text, around, named, headline, _ in out]
    # an element that holds the page's article is not out for its name; teasers in a sidebar or comments are not the article
    size = [0, 0, 0]
    for kind, text, around, _ in blocks:
        size[around] += len(text) * (kind >= 0)
    lifted = {0} | ({BY_NAME} if size[BY_NAME] > size[0] else set()) | ({BY_COMMENT} if not size[0] and not size[BY_NAME] else set())
    found = [(kind if around in lifted else -1, text, headline) for kind, text, around, headline in blocks]
    inside, beside = (sum(len(text) for kind, text, _ in found if (kind > 0) == is_in and kind >= 0) for is_in in (True, False))
    if inside:
        outer = any(headline for kind, _, headline in found if kind == 0) and not any(headline for kind, _, headline in found if kind > 0)
        if beside > inside and (articles > 1 or outer):  # teasers of other pages: the article is what stands beside them
            return [(-1 if kind > 0 else kind, text) for kind, text, _ in found]
        # what a marked article leaves out is out
        return [(kind if kind > 0 else -1, text) for kind, text, _ in found]
    return [(kind, text) for kind, text, _ in found]


def parse(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, kinds, texts, n_tokens) of every page."""
    schema = "page_id long, url string, host string, kinds array<int>, texts array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [blocks_of(h or "") for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), b.column("host"),
                 pa.array([[k for k, _ in f] for f in found], pa.list_(pa.int32())), pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))],
                names=["page_id", "url", "host", "kinds", "texts"])

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1), F.lit("")))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html").mapInArrow(run, schema)


def suffix_ranks(tokens: np.ndarray, page: np.ndarray, depth: int) -> np.ndarray:
    """Rank of the ``depth``-token string at every place (equal strings, equal ranks); -1 where the page ends before.

    Prefix doubling: ranks of 1, 2, 4, ... tokens, then two overlapping strings make the wanted length.
    """
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    if n < depth:
        return np.full(n, -1)
    have = 1
    while have < depth:
        step = min(have, depth - have)
        far = np.full(n, 0, np.int64)
        far[:n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + far, return_inverse=True)[1].astype(np.int64)
        have += step
    whole = np.zeros(n, bool)
    whole[:n - depth + 1] = page[:n - depth + 1] == page[depth - 1:]
    return np.where(whole, rank, -1)


class HostArray:
    """Suffix array over the token streams of some pages of one host."""

    def __init__(self, pdf: pd.DataFrame, depth: int):
        streams = [" ".join(t).split() for t in pdf["texts"]]
        self.sizes = np.array([len(s) for s in streams], np.int64)
        self.page = np.repeat(np.arange(len(streams)), self.sizes)
        flat = [w for s in streams for w in s]
        data, offs = C.text_buffers(pa.array(flat, pa.string()))
        self.codes = C.PrefixHash(data).ranges(offs[:-1], offs[1:]) if flat else np.zeros(0, np.uint64)
        # pages with the same stream, or the same content where the stream is a part of it, stand as one
        bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(C.mix64(self.codes * np.uint64(31) + (np.arange(len(flat)) - bounds[self.page]).astype(np.uint64)))])
        self.content = pdf["content"].to_numpy(np.int64) if "content" in pdf else (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)
        self.rank = suffix_ranks(self.codes, self.page, depth)
        order = np.argsort(self.rank, kind="stable")
        self.order = order[self.rank[order] >= 0]
        self.depth = depth

    def strings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct strings: (string hash, content of a page it stands on), one row per pair, and each pair's rank."""
        r, c = self.rank[self.order], self.content[self.page[self.order]]
        keep = np.unique(np.stack([r, c], axis=1), axis=0) if len(r) else np.zeros((0, 2), np.int64)
        first = np.full(int(r.max()) + 1 if len(r) else 0, -1, np.int64)
        first[r[::-1]] = self.order[::-1]
        code = np.zeros(len(first), np.uint64)
        at = first[first >= 0]
        acc = np.full(len(at), self.depth, np.uint64)
        for j in range(self.depth):
            acc = C.mix64(acc ^ self.codes[at + j])
        code[first >= 0] = acc
        return code.view(np.int64)[keep[:, 0]], keep[:, 1], keep[:, 0]

    def covered(self, ranks: np.ndarray) -> np.ndarray:
        """Tokens covered by strings with the given ranks."""
        mark = np.zeros(len(self.codes) + 1, np.int64)
        hit = np.flatnonzero((self.rank >= 0) & np.isin(self.rank, ranks))
        np.add.at(mark, hit, 1)
        np.add.at(mark, hit + self.depth, -1)
        return np.cumsum(mark)[:-1] > 0


def undecided() -> Column:
    """Whether a page has blocks that host repeats decide about."""
    return F.array_contains("kinds", 0) | F.array_contains("kinds", 2)


def common_codes(strings: DataFrame, min_pages: int) -> DataFrame:
    """(host, part, code) of the strings on ``min_pages`` contents of their host, for the arrays in which they stand."""
    common = strings.select("host", "code", "content").distinct().groupBy("host", "code").agg(F.count("*").alias("n"))
    return strings.join(common.where(F.col("n") >= min_pages), ["host", "code"], "left_semi").select("host", "part", "code").distinct()


def clean_streams(parsed: DataFrame, min_tokens: int, min_pages: int) -> DataFrame:
    """(page, cover) of all blocks but the plain ones of marked articles."""
    streams = parsed.select("page", "host", F.filter("texts", lambda t, i: F.get("kinds", i) != 1).alias("texts")).where(F.size("texts") > 0)
    # hosts all of whose pages are decided by their marked articles need no array
    streams = streams.join(parsed.where(undecided()).select("host").distinct(), "host", "left_semi")
    return covers_of(streams, min_tokens, min_pages)


def covers_of(streams: DataFrame, min_tokens: int, min_pages: int) -> DataFrame:
    """(page, cover) of (page, host, texts) with cover = one 0/1 character per token of the page's stream.

    A further column ``content`` tells which pages are distinct where the texts are only a part of them.
    """
    arrays = F.greatest(F.ceil(F.col("pages") / ARRAY_PAGES), F.ceil(F.col("chars") / ARRAY_CHARS), F.lit(1))
    chars = F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.char_length(t))
    streams = streams.withColumn("host_hash", F.xxhash64("host"))  # the table of hosts is of fixed width, as it may be broadcast
    hosts = streams.groupBy("host_hash").agg(F.count("*").alias("pages"), F.sum(chars).alias("chars")).select("host_hash", arrays.alias("arrays"))
    hosts = C.materialize(hosts, "hosts")
    # dealt by host and part: by the host alone, all arrays of a host would meet in one task
    dealt = streams.join(C.small_side(hosts), "host_hash").drop("host_hash").withColumn("part", F.pmod(F.xxhash64("page"), F.col("arrays")))
    dealt = dealt.repartition("host", "part")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        code, content, _ = HostArray(pdf, min_tokens).strings()
        return pd.DataFrame({"host": pdf["host"].iloc[0], "part": pdf["part"].iloc[0], "code": code, "content": content})

    several = dealt.where("arrays > 1").groupBy("host", "part").applyInPandas(count, "host string, part long, code long, content long")
    spread = common_codes(C.materialize(several, "strings"), min_pages).repartition("host", "part")

    def cover(key, pages: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        if not len(pages):
            return pd.DataFrame({"page": [], "cover": []}).astype({"page": "int64"})
        array = HostArray(pages, min_tokens)
        code, content, rank = array.strings()
        if pages["arrays"].iloc[0] > 1:
            hit = rank[np.isin(code, codes["code"].to_numpy())]
        else:
            n = np.bincount(rank, minlength=1)
            hit = np.flatnonzero(n >= min_pages)
        mark = array.covered(hit).astype(np.uint8) + ord("0")
        bounds = np.concatenate([[0], np.cumsum(array.sizes)])
        return pd.DataFrame({"page": pages["page"].to_numpy(), "cover": [mark[s:e].tobytes().decode() for s, e in zip(bounds, bounds[1:])]})

    return dealt.groupBy("host", "part").cogroup(spread.groupBy("host", "part")).applyInPandas(cover, "page long, cover string")


def repeated_ends(parsed: DataFrame, min_tokens: int, min_pages: int) -> DataFrame:
    """(page, blocks) with the (pos, wide) of the article's blocks that begin and end as on ``min_pages`` pages of the host do.

    ``wide`` says whether half of the host's distinct pages have such a block.
    """
    def key(text: Column, i: Column) -> Column:
        enough = (F.get("kinds", i) == 1) & (F.substring_index(text, " ", min_tokens - 1) != text)
        return F.when(enough, F.xxhash64("host", F.substring_index(text, " ", min_tokens), F.substring_index(text, " ", -min_tokens)))

    named = parsed.select("page", F.xxhash64("host").alias("host_hash"), F.xxhash64("texts").alias("content"), F.transform("texts", key).alias("keys"))
    ends = named.select("page", "host_hash", "content", F.posexplode("keys").alias("pos", "key")).where("key is not null")
    hosts = named.groupBy("host_hash").agg(F.countDistinct("content").alias("pages"))
    counts = ends.select("host_hash", "key", "content").distinct().groupBy("host_hash", "key").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    wide = (F.col("pages") >= TEMPLATE_PAGES) & (2 * F.col("n") >= F.col("pages"))
    found = C.materialize(counts.join(hosts, "host_hash").select("host_hash", "key", wide.alias("wide")), "ends")
    return ends.join(C.small_side(found), ["host_hash", "key"]).groupBy("page").agg(F.sort_array(F.collect_list(F.struct("pos", "wide"))).alias("blocks"))


def without_templates(parsed: DataFrame, min_tokens: int, min_pages: int) -> DataFrame:
    """``parsed`` where the article's blocks that belong to the host's template have kind -1."""
    ends = C.materialize(repeated_ends(parsed, min_tokens, min_pages), "candidates")
    size = F.aggregate(F.filter("texts", lambda t, i: F.get("kinds", i) == 1), F.lit(0).cast("long"), lambda a, t: a + F.char_length(t))
    streams = parsed.join(ends, "page").select(
        "page", "host", F.transform("blocks", lambda b: F.get("texts", b["pos"])).alias("texts"), "blocks", size.alias("size"),
        F.xxhash64("texts").alias("content"))
    streams = C.materialize(streams, "repeats")

    @F.pandas_udf("array<int>")
    def template(blocks: pd.Series, texts: pd.Series, size: pd.Series, cover: pd.Series) -> pd.Series:
        def one(bs, ts, n, mark):
            at, gone, chars = 0, [], 0
            for b, t in zip(bs, ts):
                words = len(t.split())
                if b["wide"] and "0" not in mark[at:at + words]:
                    gone.append(b["pos"])
                    chars += len(t)
                at += words
            return gone if 2 * chars <= n else []
        return pd.Series([one(*row) for row in zip(blocks, texts, size, cover)], dtype=object)

    covers = covers_of(streams.select("page", "host", "texts", "content"), min_tokens, min_pages)
    gone = streams.join(covers, "page").select("page", template("blocks", "texts", "size", "cover").alias("gone")).where(F.size("gone") > 0)
    gone = C.materialize(gone, "templates")
    kind = F.transform("kinds", lambda k, i: F.when(F.array_contains("gone", i), F.lit(-1)).otherwise(k))
    return parsed.join(C.small_side(gone), "page", "left").withColumn("kinds", F.when(F.col("gone").isNull(), F.col("kinds")).otherwise(kind)).drop("gone")


def extract(pages: DataFrame, min_tokens: int = MIN_TOKENS, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every page; see the module docstring."""
    spark = pages.sparkSession
    C.bound_batches(spark)
    parsed = C.materialize(parse(pages).withColumn("page", F.monotonically_increasing_id()), "blocks")
    parsed = without_templates(parsed, min_tokens, min_pages)
    covers = clean_streams(parsed, min_tokens, min_pages)

    @F.pandas_udf("string")
    def unique_runs(kinds: pd.Series, texts: pd.Series, cover: pd.Series) -> pd.Series:
        def one(ks, ts, mark):
            at, out = 0, []
            for k, t in zip(ks, ts):
                if k == 1:
                    out.append(t)
                    continue
                words = t.split()
                own = mark[at:at + len(words)] if mark else "0" * len(words)
                at += len(words)
                if k == 2 and "0" in own:  # of an article, whole blocks only
                    out.append(t)
                if k == 0:
                    left = " ".join([w for w, m in zip(words, own) if m == "0"])
                    if left:
                        out.append(left)
            return "\n\n".join(out)
        return pd.Series([one(k, t, c) for k, t, c in zip(kinds, texts, cover)], dtype=object)

    # what is left of a marked article is the text as it stands: only pages with undecided blocks meet their covers
    plain = F.array_join(F.filter("texts", lambda t, i: F.get("kinds", i) == 1), "\n\n")
    decided = parsed.where(~undecided()).select("page_id", "url", plain.alias("text"))
    judged = parsed.where(undecided()).join(covers, "page", "left").select("page_id", "url", unique_runs("kinds", "texts", "cover").alias("text"))
    return decided.unionByName(judged).withColumn("n_chars", F.char_length("text").cast("long"))
