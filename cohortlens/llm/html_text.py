"""Main text of web pages by consensus host paths.

First pass: every page is read into containers and blocks; each container is
scored by its share of the page's running text, and less if most of its own
text is links, and known by its generalised path: tags with their classes,
digits replaced. Hidden parts (menus, adverts and the like) count for no
container, as no text is taken from them: elements that are such by their tag,
and those with a mark, a class, id or role like ``comment-list``, unless they
hold the article. Whether a name is a mark on a host at all is voted on too, by
the running text in the elements that hold the article and in the others. A page votes with its best
container's score, of equals the deepest, so with the smallest one that holds
all; a container inside an article or main element votes for that element as a
whole. Votes are added up per host and path in Spark, and the path with most
votes wins the host. Second pass: each page is read again and the blocks below
the winning path are its text. A page without that path keeps the container it
scores best itself.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, join_small, text_of
from cohortlens.llm.url_filter import host_of

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
                    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*>|<[!?/a-zA-Z][^>]*(?:>|\Z)|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_BETWEEN = re.compile(r"[-_0-9]+")
_DIGITS = re.compile(r"[0-9]+")
#: Kinds of elements.
_RAW = frozenset("script style noscript template textarea title iframe svg select option".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINERS = frozenset("html body main article section div td center".split())
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table thead tbody tfoot tr th caption figure figcaption address details summary "
    "nav header footer aside form fieldset menu dialog hr head search".split())
_NOT_TEXT = frozenset("nav footer aside form menu dialog head button search".split())
#: Words that mark what is not the article, as a class, id or role or as parts of one (cookie-banner, ad_3).
_MARKS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent notice notices alert sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead comment comments respond disqus share sharing social related recommended "
    "newsletter subscribe signup login popup modal overlay widget toolbar pagination pager complementary contentinfo".split())
#: A longer name is a mark if its last part is a word above (left-sidebar), or its first one is and its last one is one of these (comment-list).
_BOXES = frozenset("list lists section box bar area block wrapper wrap container panel form thread group links items row holder module inner".split())
#: Names with one of these parts say how an element looks (with-sidebar, no-comments).
_STATES = frozenset("no not with without has have is hide hides show shows".split())
#: A header is none of the article's if its name begins so (site-header).
_SITE = frozenset("site global top main app blog sticky fixed".split())
#: Marks of reader comments. Such an element stays out even if it is longer than the article.
_COMMENTS = frozenset("comment comments respond disqus".split())
#: Segments of a path, classes of a segment; least share of the text that makes a candidate.
_DEEP, _CLASSES, _SHARE = 8, 2, 0.3
#: An element that is marked stays if it holds more than this share of the page's running text, or an article, while the
#: articles that are not marked hold less than _ARTICLE of it.
_MOST, _ARTICLE = 0.5, 0.1
#: Share of running text from which links don't count against a container; a score of 1.
_PURE, _FULL = 0.5, 1_000_000


def _attributes(attrs: str) -> dict[str, str]:
    """class, id and role of a tag, lower case; of an attribute given twice the first."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs):
        name = m[1].lower()
        if name in ("class", "id", "role"):
            out.setdefault(name, (m[2] or m[3] or m[4] or "").lower())
    return out


@lru_cache(maxsize=100_000)
def _mark(name: str) -> int:
    """1 if a class, id or role marks what is not the article, 2 if reader comments, else 0."""
    words = [w for w in _BETWEEN.split(name) if w]
    if not words or not _STATES.isdisjoint(words):
        return 0
    if (all(w in _MARKS for w in words) or words[-1] in _MARKS or (words[0] in _MARKS and words[-1] in _BOXES)
            or (len(words) > 1 and words[-1] == "header" and words[0] in _SITE)):
        return 1 if _COMMENTS.isdisjoint(words) else 2
    return 0


class Page:
    """Blocks and containers of one page. A container is [path, depth, first
    block, last block, running text, all visible text, parent]."""

    def __init__(self, source: str, ignored: frozenset = frozenset()):
        """``ignored``: marks that are none on this page's host."""
        self.blocks: list[str] = []
        self.nodes: list[list] = [[("page",), 0, 0, 0, 0, 0, -1]]
        self._parts: list[str] = []
        self._links = 0
        #: marked elements in order, after the page itself: [element around it, running text, of that in an article, has an article,
        #: has a main, its marks, is of comments].
        self._marked: list[list] = [[-1, 0, 0, False, False, (), False]]
        self._read(source, ignored, frozenset())
        stay, running = self._marks_that_stay()
        #: running text below each mark, negative where the element is left out.
        self.marks: dict[str, int] = {}
        for i, m in enumerate(self._marked[1:], 1):
            for name in m[5]:
                self.marks[name] = self.marks.get(name, 0) + (running[i] if i in stay else -running[i])
        if stay:
            self._again(source, ignored, stay)
        if not self.blocks:  # a page that is marked as a whole
            self._again(source, None, frozenset())

    def _again(self, source: str, ignored: frozenset | None, stay: frozenset) -> None:
        self.blocks, self.nodes, self._marked = [], self.nodes[:1], [[-1, 0, 0, False, False, (), False]]
        self.nodes[0][2:6] = [0, 0, 0, 0]
        self._read(source, ignored, stay)

    def _marks_that_stay(self) -> tuple[frozenset, list[int]]:
        """Numbers of the marked elements that hold the article all the same, and
        the running text of each: a main element; or, but for comments, an
        article or most of the running text, while there is no article to speak
        of outside."""
        all_of = [list(m) for m in self._marked]
        for m in reversed(all_of[1:]):  # children come after their parents
            around = all_of[m[0]]
            around[1] += m[1]
            if not m[6]:
                around[3] |= m[3]
            around[4] |= m[4]
        inside = [False] * len(all_of)  # of comments
        for i, m in enumerate(all_of[1:], 1):
            inside[i] = inside[m[0]] or (m[0] > 0 and all_of[m[0]][6])
        outer_comments = sum(m[1] for i, m in enumerate(all_of) if m[6] and not inside[i])
        article, stay = self._marked[0][2], {0}
        everything = all_of[0][1] - outer_comments
        for i in sorted(range(1, len(all_of)), key=lambda i: (-all_of[i][1], i)):  # parents come before their children
            around, running, _own, has_article, has_main, _marks, comments = all_of[i]
            whole = article < _ARTICLE * everything and (has_article or running > _MOST * everything) and not comments
            if around in stay and running and (has_main or whole):
                stay.add(i)
                article += self._marked[i][2]
        return frozenset(stay - {0}), [m[1] for m in all_of]

    def _flush(self, node: int) -> None:
        if not self._parts:
            return
        text = _SPACE.sub(" ", html.unescape("".join(self._parts))).strip(" ")
        if text:
            self.blocks.append(text)
            self.nodes[node][4] += max(0, len(text) - self._links)
            self.nodes[node][5] += len(text)
        self._parts, self._links = [], 0

    def _read(self, source: str, ignored: frozenset | None, stay: frozenset) -> None:
        """``ignored``: marks that don't count (None: no mark counts)."""
        # open elements: (tag, container before it, opens a part that is no text, is such by its tag, marked element around it, is a link)
        stack: list[tuple[str, int, bool, bool, int, bool]] = []
        opened: dict[str, list[int]] = {}  # places of the open elements of a tag
        blocks_open: list[int] = []  # places of the open blocks but paragraphs
        node, hidden, by_tag, mark, links, pos, end = 0, 0, 0, 0, 0, 0, len(source)
        nodes, marked, match, raw_lower = self.nodes, self._marked, _TOKEN.match, None

        def pop() -> None:
            nonlocal node, hidden, by_tag, mark, links
            tag, before, hides, never, mark, link = stack.pop()
            opened[tag].pop()
            if blocks_open and blocks_open[-1] == len(stack):
                blocks_open.pop()
            hidden -= hides
            by_tag -= never
            links -= link
            if before != node:
                nodes[node][3] = len(self.blocks)
                node = before

        while pos < end:
            m = match(source, pos)
            pos = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                piece = m[0]
                if piece[0] != "<" or piece == "<":
                    if not by_tag and not links:
                        n = len(piece.strip())
                        marked[mark][1] += n
                        if opened.get("article") or opened.get("main"):
                            marked[mark][2] += n
                    if not hidden:
                        self._parts.append(piece)
                        if links:
                            self._links += len(piece)
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                if tag in _BLOCKS:
                    self._flush(node)
                if opened.get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            if tag in _RAW:
                if raw_lower is None:
                    raw_lower = source.lower()
                    if len(raw_lower) != end:  # a few letters change their length
                        raw_lower = source
                at = raw_lower.find("</" + tag, pos)
                pos = end if at < 0 else at
                if at >= 0:
                    close = source.find(">", at)
                    pos = end if close < 0 else close + 1
                continue
            if tag in _VOID:
                if tag == "hr":
                    self._flush(node)
                elif tag == "br" and not hidden:
                    self._parts.append("\n")
                continue
            attrs = m["attrs"] or ""
            if tag in _BLOCKS:
                self._flush(node)
                self._imply(tag, stack, opened, blocks_open, pop)
            hides = never = tag in _NOT_TEXT or (tag == "header" and not (opened.get("article") or opened.get("main")))
            around = mark
            if tag in ("article", "main"):
                if not by_tag:
                    marked[mark][3 if tag == "article" else 4] = True
            named = _attributes(attrs) if attrs else {}
            if tag not in ("article", "main", "html", "body") and not hides and named and ignored is not None:
                names = [_DIGITS.sub("#", x) for v in named.values() for x in v.split() if _mark(x)]
                names = tuple(sorted({x for x in names if x not in ignored}))
                if names:
                    hides = len(marked) not in stay
                    mark = len(marked)
                    marked.append([around, 0, 0, False, False, names, any(_mark(x) == 2 for x in names)])
            before = node
            if tag in _CONTAINERS and not hides and not hidden:
                classes = sorted(_DIGITS.sub("#", x) for x in named.get("class", "").split())[:_CLASSES]
                path = (*nodes[node][0][1 - _DEEP:], ".".join([tag, *classes]))
                nodes.append([path, nodes[node][1] + 1, len(self.blocks), -1, 0, 0, node])
                node = len(nodes) - 1
            opened.setdefault(tag, []).append(len(stack))
            if tag in _BLOCKS and tag != "p":
                blocks_open.append(len(stack))
            stack.append((tag, before, hides, never, around, tag == "a"))
            hidden += hides
            by_tag += never
            links += tag == "a"
        self._flush(node)
        while stack:
            pop()
        nodes[0][3] = len(self.blocks)
        for n in reversed(nodes[1:]):  # children come after their parents
            nodes[n[6]][4] += n[4]
            nodes[n[6]][5] += n[5]

    @staticmethod
    def _imply(tag: str, stack: list, opened: dict, blocks_open: list, pop) -> None:
        """End tags a block's start stands for: an open paragraph, the list
        item or cell before it."""
        def last(*tags: str) -> int:
            return max((opened[t][-1] for t in tags if opened.get(t)), default=-1)

        def close(at: int) -> None:
            while len(stack) > at:
                pop()
        p = last("p")
        if p > (blocks_open[-1] if blocks_open else -1):
            close(p)
        for items, holders in ((("li",), ("ul", "ol", "menu")), (("tr",), ("table",)), (("td",), ("tr", "table")), (("dt", "dd"), ("dl",))):
            if tag in items:
                at = last(*items)
                if at > last(*holders):
                    close(at)

    def _whole(self, i: int) -> int:
        """The article or main element that holds container i, else i."""
        at = i
        while at >= 0:
            if self.nodes[at][0][-1].split(".")[0] in ("article", "main"):
                return at
            at = self.nodes[at][6]
        return i

    def best(self) -> tuple[int, int] | None:
        """(score, container) of the container with the best score, of equals the deepest, then the last in order."""
        everything = self.nodes[0][4]
        out = []
        for i, (path, depth, _first, _last, running, total, _parent) in enumerate(self.nodes):
            if everything and running >= _SHARE * everything:
                out.append((int(_FULL * (running / everything) * min(1.0, running / max(1, total) / _PURE)), depth, ">".join(path), -i))
        if not out:
            return None
        score, _depth, _path, i = max(out)
        return score, self._whole(-i)

    def text(self, path: str | None) -> str:
        """Blocks below the containers with this path, else below the best one."""
        wanted = [self.nodes[self._whole(i)] for i, n in enumerate(self.nodes) if n[3] > n[2] and ">".join(n[0]) == path] if path else []
        if not wanted:
            best = self.best()
            wanted = [self.nodes[best[1] if best else 0]]
        take = np.zeros(len(self.blocks), dtype=bool)
        for n in wanted:
            take[n[2]:n[3]] = True
        return "\n\n".join(b for b, t in zip(self.blocks, take) if t)


def host_paths(pages: DataFrame, html_col: str = "html", host_col: str = "host") -> DataFrame:
    """host, path, ignored: the path with most votes of each host (of equals
    the deepest, then the last in order), and the marks that are none there: on
    the host's pages, more running text lies in elements with the mark that
    hold the article than in others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, source in zip(b.column(0), b.column(1)):
                page, host = Page(source.as_py() or ""), host.as_py()
                best = page.best()
                if best:
                    rows.append((host, True, best[0], page.nodes[best[1]][1], ">".join(page.nodes[best[1]][0])))
                rows += [(host, False, n, 0, name) for name, n in page.marks.items() if n]
            cols = list(zip(*rows)) or [()] * 5
            types = (pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["host", "is_path", "votes", "depth", "name"])

    votes = pages.select(F.col(host_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(
        run, "host string, is_path boolean, votes long, depth long, name string")
    sums = votes.groupBy("host", "is_path", "depth", "name").agg(F.sum("votes").alias("votes"))
    return (sums.groupBy("host").agg(F.max(F.when(F.col("is_path"), F.struct("votes", "depth", "name"))).alias("best"),
                                     F.collect_list(F.when(~F.col("is_path") & (F.col("votes") > 0), F.col("name"))).alias("ignored"))
            .select("host", F.col("best.name").alias("path"), "ignored"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars, host, path (the
    host's winning path).

    A null or empty page has an empty text; pages without a host (null url, no
    ``://``) form a host of their own. Ids may be null, rows may repeat; other
    columns are ignored. An empty table gives an empty result. Broken markup
    never fails: what can't be a tag is text."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        text_of(html_col).alias("html"))
    won = cut(host_paths(rows))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [Page(h.as_py() or "", frozenset(i.as_py() or ())).text(p.as_py()) for h, p, i in zip(b.column(3), b.column(4), b.column(5))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), b.column(2), b.column(4)],
                names=["page_id", "url", "text", "n_chars", "host", "path"])

    joined = join_small(rows, won, ["host"], F.struct("page_id", "url")).select("page_id", "url", "host", "html", "path", "ignored")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, host string, path string")
