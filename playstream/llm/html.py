"""Main text of web pages by consensus host paths.

1. Every page is read into blocks of text, each with the path of generalised
   tag-class steps of the containers around it.  A page scores its containers
   and votes for the best path.
2. Spark sums the votes by host and path.
3. Pages are re-extracted with their host's winning path; a page without that
   container falls back on the next paths of the host, then on its own best.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playstream.llm.common import save, slices, table

PATHS = 4            # paths kept of a host, by votes
SALTS = 64           # parts that a host's paths are dealt into before the best are taken

#: Fixed element names.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())   # their content is no markup
_DROP = frozenset("button noscript select svg template".split())                      # elements that hold no text of the article
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CONTAINER = frozenset("article body center div main section table td".split())
_CHROME = frozenset("aside dialog footer form head header nav menu menuitem".split())
_ENDS_P = _BLOCK - {"body", "html"}

#: Fixed words of class and id names that mark what is not the article.
_NOT_MAIN = re.compile(r"(?:^|[-_\s])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|menu|nav\w*|newsletter|notice|popup|promo\w*|related|share|sharing|side-?bar|social|sponsor\w*|subscribe|toolbar|widget)(?=$|[-_\s\d])", re.I)
#: Names that tell of a layout's state (has-sidebar, no-sidebar), not of what an element is.
_STATE = re.compile(r"(?<!\S)(?:has|no|not|with|without)[-_]\S*", re.I)
_MAIN = re.compile(r"article|content|entry|main|post|story|text", re.I)

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: The rest of an ordinary tag: quotes stand after "=" only, no value holds "<" or ">".
_REST = re.compile(r"""((?:[^<>"'=]|=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]))*+)>""")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=]+|=[^\s/>=]*)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*))?""")
_BEFORE_VALUE = re.compile(r"[^=>]*+(?:=\s*+([\"'])?|>)")
_SPACE = re.compile(r"\s+")


class _Scanner:
    """Finds the tags of a page, each character looked at a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.without: set[str] = set()     # quotes that don't occur in the rest of the page
        self.pairs: dict[str, dict[int, int]] = {}

    def tag_end(self, at: int) -> tuple[str, int] | None:
        """Attributes of the tag whose name ends at ``at`` and the place after it; None if the page ends before it does."""
        page = self.page
        if m := _REST.match(page, at):
            return m[1], m.end()
        start = at
        while m := _BEFORE_VALUE.match(page, at):
            at = m.end()
            if page[at - 1] == ">":
                return page[start:at - 1], at
            if m[1] and m[1] not in self.without:
                end = page.find(m[1], at)
                if end >= 0:
                    at = end + 1
                else:   # never closed: the quote is part of a value like any other character
                    self.without.add(m[1])
        return None

    def after(self, name: str, at: int) -> int | None:
        """The place after the end tag of the element ``name`` that starts before
        ``at``; None if another of its kind starts where its end is missing."""
        if name not in self.pairs:
            self.pairs[name], open_ = {}, []
            for m in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>?", re.I | re.A).finditer(self.page):
                if not m[1]:
                    if name in ("button", "noscript", "select"):   # never inside one of their kind
                        open_.clear()
                    open_.append(m.start())
                elif open_:
                    self.pairs[name][open_.pop()] = m.end()
        return self.pairs[name].get(at)


class Paths:
    """The different paths of a page's containers, as a tree: a node's number is
    larger than that of the node above it; 0 is the empty path."""

    def __init__(self) -> None:
        self.up, self.step, self._below = [0], [""], {}

    def below(self, node: int, step: str) -> int:
        n = self._below.setdefault((node, step), len(self.up))
        if n == len(self.up):
            self.up.append(node)
            self.step.append(step)
        return n

    def find(self, path: str) -> int | None:
        node: int | None = 0
        for step in path.split(">")[1:]:
            node = self._below.get((node, step))
            if node is None:
                return None
        return node

    def path(self, node: int) -> str:
        steps = []
        while node:
            steps.append(self.step[node])
            node = self.up[node]
        return "".join(f">{x}" for x in reversed(steps))

    def inside(self, node: int) -> list[bool]:
        """Of every node, whether it is ``node`` or below it."""
        out = [False] * len(self.up)
        for k in range(node, len(out)):
            out[k] = k == node or (k > 0 and out[self.up[k]])
        return out


class _Marks:
    """Marked elements as a tree, and the unlinked text in them."""

    def __init__(self) -> None:
        self.up: list[int] = []
        self.whole: list[bool] = []   # whether a name of it is a fixed word as a whole

    def add(self, above: int, whole: bool) -> int:
        self.up.append(above)
        self.whole.append(whole)
        return len(self.up) - 1

    def unmarked(self, found: list[tuple[int, int, bool, str, int]]) -> list[tuple[int, str, int]]:
        """The blocks in no marked element.  Where none of them is in an article or
        main element, a mark counts for nothing whose element holds more unlinked
        text than is left without it: it is the page's layout.  A name that is a
        fixed word as a whole (comments) counts unless an article or main element is in there."""
        n = len(self.up)
        own, own_main, below = [0] * (n + 1), [False] * (n + 1), [[] for _ in range(n + 1)]   # the last: outside all
        for _, mark, main, text, linked in found:
            own[mark] += max(0, len(text) - linked)
            own_main[mark] |= main
        held, main_in = own[:], own_main[:]
        for m in range(n - 1, -1, -1):
            below[self.up[m]].append(m)
            if self.up[m] >= 0:
                held[self.up[m]] += held[m]
                main_in[self.up[m]] |= main_in[m]
        open_, lifted, left, known = list[tuple[int, int]](), [False] * n + [True], own[-1], own_main[-1]
        reach = below[-1]
        while not known:
            for m in reach:
                if main_in[m] or not self.whole[m]:
                    heapq.heappush(open_, (-held[m], m))
            if not open_ or -open_[0][0] <= left:
                break
            m = heapq.heappop(open_)[1]
            lifted[m] = True
            left, known, reach = left + own[m], own_main[m], below[m]
        return [(node, text, linked) for node, mark, _, text, linked in found if lifted[mark]]


class _Open:
    """An open element: its name, node, whether it is outside the article for
    certain, in an article or main element, in a link; the innermost marked
    element around it, and the places of the nearest open block, p and li."""

    __slots__ = ("name", "node", "out", "mark", "main", "link", "block", "p", "li")

    def __init__(self, name: str, node: int, out: bool, mark: int, main: bool, link: bool, block: int, p: int, li: int) -> None:
        self.name, self.node, self.out, self.mark, self.main, self.link, self.block, self.p, self.li = name, node, out, mark, main, link, block, p, li


def _step(name: str, attributes: str) -> tuple[str, bool, str]:
    """The element's generalised step - tag and first class, digits dropped -
    whether it is outside the article for certain, and the names that mark it as not the article."""
    if not attributes or attributes.isspace():
        return name, name in _CHROME, ""
    named: dict[str, str] = {}
    for k, v in _ATTRIBUTE.findall(attributes):
        named.setdefault(k.lower(), html.unescape(v[1:-1] if v[:1] in ("'", '"') and v[-1:] == v[:1] and len(v) > 1 else v))
    marks = _STATE.sub("", " ".join(named.get(k, "") for k in ("class", "id", "role")))
    out = name in _CHROME or "hidden" in named or named.get("aria-hidden", "").lower() == "true"
    if name in ("body", "html", "article", "main") or not _NOT_MAIN.search(marks):
        marks = ""
    first = re.sub(r"[\d>]+", "", (named.get("class", "").split() or [""])[0].lower())
    return (f"{name}.{first}" if first else name), out, marks


def parsed(page: str) -> tuple[Paths, list[tuple[int, str, int]]]:
    """The page's containers, and its blocks of text outside menus and the like,
    in order: node of containers, text (references decoded, white space as one
    space), and the characters of it inside links.

    Time and memory grow with the page, however deep or broken it is."""
    paths, marks, scan = Paths(), _Marks(), _Scanner(page)
    found: list[tuple[int, int, bool, str, int]] = []
    stack = [_Open("", 0, False, -1, False, False, 0, -1, -1)]
    named: dict[str, list[int]] = {}    # places in the stack by name
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                top = stack[-1]
                found.append((top.node, top.mark, top.main, text, linked))
            parts.clear()
        linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].out:
            parts.append(raw)
            if stack[-1].link:
                linked += len(raw)

    def close(k: int) -> None:
        if stack[-1].block >= k:
            flush()
        for e in reversed(stack[k:]):
            named[e.name].pop()
        del stack[k:]

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0 or start == size - 1:
            text(page[at:])
            break
        m = _NAME.match(page, start)
        if m is None:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 2)   # <!--> is a whole one
                end = size if end < 0 else end + 3
            elif page[start + 1] in "!?" or (page[start + 1] == "/" and start + 2 < size):
                end = page.find(">", start)
                end = size if end < 0 else end + 1
            else:   # a mere character
                text(page[at:start + 1])
                at = start + 1
                continue
            text(page[at:start])
            at = end
            continue
        text(page[at:start])
        tag = scan.tag_end(m.end())
        if tag is None:   # cut off by the end of the page
            break
        attributes, at = tag
        name = m[1].lower()
        if page[start + 1] == "/":
            k = named[name][-1] if named.get(name) else 0
            if k and (name in _BLOCK or stack[-1].block <= k):   # else a stray end
                close(k)
            continue
        single = page[at - 2] == "/"
        if name in _RAW and not single:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I | re.A).search(page, at)
            at = end.end() if end else size
            continue
        if name in _DROP and not single and (end := scan.after(name, start)):
            at = end
            continue
        if name in _BLOCK or name == "br":
            while stack[-1].name in _DROP and name != "br":   # its end is missing
                close(len(stack) - 1)
            if name in _ENDS_P and stack[-1].p > 0:
                close(stack[-1].p)
            if name == "br":
                text(" ")
            else:
                flush()
        if name in _VOID or single:
            continue
        if name == "li" and stack[-1].li > 0:
            close(stack[-1].li)
        if name in _DROP and stack[-1].name == name:
            close(len(stack) - 1)
        step, aside, marked = _step(name, attributes)
        top, k = stack[-1], len(stack)
        contains = name in _CONTAINER
        mark = marks.add(top.mark, any(_NOT_MAIN.fullmatch(x) for x in marked.split())) if marked else top.mark
        stack.append(_Open(name, paths.below(top.node, step) if contains else top.node, top.out or aside or name in _DROP, mark,
                           top.main or name in ("article", "main"), top.link or name == "a", k if name in _BLOCK else top.block,
                           k if name == "p" else -1 if contains else top.p, k if name == "li" else -1 if name in ("ul", "ol") else top.li))
        named.setdefault(name, []).append(k)
    flush()
    return paths, marks.unmarked(found) if marks.up else [(node, text, linked) for node, _, _, text, linked in found]


def blocks(page: str) -> list[tuple[str, str, int]]:
    """``parsed`` with the paths written out."""
    paths, found = parsed(page)
    return [(paths.path(node), text, linked) for node, text, linked in found]


def votes(paths: Paths, found: list[tuple[int, str, int]]) -> list[tuple[int, float]]:
    """Scores of a page's containers: unlinked characters of the blocks directly
    in them and, less, of those deeper; named article or main containers count more.
    What stands outside the body is in an implied one, whose path is empty."""
    scores, held = [0.0] * len(paths.up), [False] * len(paths.up)
    for node, text, linked in found:
        scores[node] += float(max(0, len(text) - 2 * linked))
        held[node] = True
    tags = [step.partition(".")[0] for step in paths.step]
    for node in range(len(scores) - 1, 0, -1):
        if held[node] and tags[node] != "body":
            scores[paths.up[node]] += 0.5 * scores[node]
            held[paths.up[node]] = True
    return [(node, scores[node] * (4.0 if tags[node] in ("article", "main") else 2.0 if _MAIN.search(paths.step[node]) else 1.0))
            for node in range(len(scores)) if held[node]]


def host(url: Column) -> Column:
    """Host of a url, lower-cased, without www. and m.; empty where there is none."""
    name = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(name, r"^(?:www|m)\.", "")


def host_paths(pages: DataFrame, keep: int = PATHS) -> DataFrame:
    """``(host, paths)``: each host's paths by votes.  A page's vote is split over its
    containers by score, so a host of many pages is summed before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            rows = []
            sums: dict[tuple[str, str], float] = {}
            for h, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                paths, found = parsed(page or "")
                scores = votes(paths, found)
                best = max((s for _, s in scores), default=0)
                for node, score in scores:
                    if best and score >= best / 2:
                        path = paths.path(node)
                        sums[h, path] = sums.get((h, path), 0.0) + (1.0 if score == best else 0.5 * score / best)
            rows = [(h, p, round(1000 * v)) for (h, p), v in sums.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["host", "path", "votes"])

    cast = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, votes long")
    summed = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    # a host may have as many paths as pages: the best of every salt first, then of those
    w = Window.partitionBy("host", F.pmod(F.xxhash64("path"), F.lit(SALTS))).orderBy(F.desc("votes"), "path")
    summed = summed.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep)
    best = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("rank"), "path")))
    top = summed.groupBy("host").agg(F.transform(F.slice(best, 1, keep), lambda x: x["path"]).alias("paths"))
    return top


def extract(page: str, paths: list[str]) -> str:
    """Text of the blocks inside the first of ``paths`` that the page has, else inside its own best container."""
    tree, found = parsed(page)

    def inside(node: int) -> list[str]:
        held = tree.inside(node)
        return [text for at, text, _ in found if held[at]]

    for path in paths:
        node = tree.find(path)
        if node is not None and (texts := inside(node)):
            return "\n".join(texts)
    scores = votes(tree, found)
    best = max((score for _, score in scores), default=0.0)
    own = min((node for node, score in scores if score == best), key=tree.path, default=0)
    return "\n".join(inside(own))


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    * null, empty and textless html give an empty text; a null or odd url
      belongs to the host ""; repeated rows get equal rows; other columns are
      ignored; an empty table gives an empty table;
    * ties of votes go to the smaller path."""
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    # written first, so Spark knows its size: few hosts are broadcast under its
    # threshold and the pages stay where they are, more are joined by host
    paths = save(host_paths(pages)).withColumnRenamed("host", "of")
    joined = rows.join(paths, rows["host"] == paths["of"], "left").select("page_id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            texts = [extract(h or "", p or []) for h, p in zip(b.column("html").to_pylist(), b.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
