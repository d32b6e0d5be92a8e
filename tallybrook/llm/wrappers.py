"""HTML extraction by wrappers: union-free regular expressions that the pages of a host share.

A wrapper begins as one page's stream of tokens, and takes in the other pages one by one:
the streams are aligned, and each mismatch is resolved into the wrapper. Text that differs
becomes a slot, what one of them lacks becomes optional, and what recurs becomes a repeated
group, whose parts are optional where they do not always occur; there are no alternatives.
So a key (tag, class and marks) occurs once in each sequence, and a page is matched to its
wrapper by walking down both.

Pages are taken in as they stream through a task, then wrappers of tasks are merged in two
rounds of shuffles; at no time is more than one wrapper per host and task held.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm import markup
from tallybrook.llm.shared import let_workers_import, settled

# Elements deeper than this belong to the one at this depth; their texts stay.
DEPTH = 48
# A sequence with more different keys is told apart by tags and marks alone.
KEYS = 64
# Wrappers a task holds before it passes them on.
HOSTS = 256
# Tasks that share the partial wrappers of one host in the first round of merging.
SHARES = 64
# Pages from which on text that never changes is part of the frame.
PAGES = 3
# Share of a part's text that leads down into it, and share of links that makes a list a menu.
MOST, LINKS = 0.5, 0.8


class Node:
    """A part of a wrapper: an element, a block of text (`#`) or a repeated group (`()`).

    `n` counts its occurrences; `chars` and `links` the text below it. `literal` is a text that
    has never differed, by a digest if it is long; None is a slot.
    """

    __slots__ = ("chars", "key", "kids", "links", "literal", "n", "optional", "repeated")

    def __init__(self, key: str, n: int = 1, chars: int = 0, links: int = 0, literal: str | None = None) -> None:
        self.key, self.n, self.chars, self.links, self.literal = key, n, chars, links, literal
        self.optional = self.repeated = False
        self.kids: list[Node] = []

    def packed(self) -> list:
        flags = self.optional + 2 * self.repeated
        return [self.key, self.n, self.chars, self.links, self.literal, flags, [k.packed() for k in self.kids]]

    def __str__(self) -> str:
        if self.key == "#":
            inner = "#" if self.literal is None else json.dumps(self.literal, ensure_ascii=False)
        elif self.key == "()":
            inner = f"({' '.join(map(str, self.kids))})"
        else:
            inner = f"<{self.key}>{' '.join(map(str, self.kids))}</>"
        mark = "*" if self.optional and self.repeated else "?" if self.optional else "+" if self.repeated else ""
        return f"({inner}){mark}" if mark and self.key != "()" else inner + mark


def unpacked(given: list) -> Node:
    node = Node(*given[:5])
    node.optional, node.repeated = bool(given[5] & 1), bool(given[5] & 2)
    node.kids = [unpacked(k) for k in given[6]]
    return node


def literal(text: str) -> str:
    return text if len(text) <= 40 else "sha256:" + hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# Kids of a sequence with the numbers of the repeated groups they stand in.
Flat = list[tuple[Node, frozenset[int]]]


def _flat(kids: Iterable[Node], first: int) -> Flat:
    out: Flat = []
    for number, kid in enumerate(kids, first):
        out += [(k, frozenset([number])) for k in kid.kids] if kid.key == "()" else [(kid, frozenset())]
    return out


def _joined(a: Node, b: Node) -> Node:
    """One node for both occurrences; text that differs becomes a slot."""
    a.kids = aligned(a.kids, b.kids) if a.key != "#" else []
    if a.literal != b.literal:
        a.literal = None
    a.n, a.chars, a.links = a.n + b.n, a.chars + b.chars, a.links + b.links
    a.optional, a.repeated = a.optional or b.optional, a.repeated or b.repeated
    return a


def _coarse(key: str) -> str:
    return re.sub(r"\.[a-z-]*", "", key)


def folded(flat: Flat) -> list[Node]:
    """The sequence with each key once: what lies between two of a key is a repeated group."""
    if len({n.key for n, _ in flat}) > KEYS:
        for node, _ in flat:
            node.key = _coarse(node.key)
    last: dict[str | int, int] = {}
    for at, (node, groups) in enumerate(flat):
        last[node.key] = at
        last.update(dict.fromkeys(groups, at))
    out: list[Node] = []
    at = 0
    while at < len(flat):
        end, to = at, at
        while to <= end:
            end = max([end, last[flat[to][0].key], *(last[g] for g in flat[to][1])])
            to += 1
        stretch = flat[at:to]
        if len(stretch) == 1:
            node, groups = stretch[0]
            node.repeated = node.repeated or bool(groups)
            out.append(node)
        else:
            parts: dict[str, Node] = {}
            for node, _ in stretch:
                parts[node.key] = _joined(parts[node.key], node) if node.key in parts else node
            if len(parts) == 1:
                node.repeated = True
                node = next(iter(parts.values()))
                node.repeated = True
                out.append(node)
            else:
                group = Node("()")
                group.repeated = True
                group.kids = list(parts.values())
                same = len({k.n for k in group.kids}) == 1 and not any(k.optional for k in group.kids)
                for kid in group.kids:
                    kid.optional = not same
                out.append(group)
        at = to
    return out


def aligned(a: list[Node], b: list[Node]) -> list[Node]:
    """Both sequences as one: matched in the longest common order, the rest optional.

    Keys in both that do not match in order occur twice in the result, which `folded`
    makes a repeated group of.
    """
    if not a and not b:
        return []
    left, right = _flat(a, 0), _flat(b, len(a))
    place = {node.key: at for at, (node, _) in enumerate(left)}
    if any(n.key not in place for n, _ in right) and len({n.key for n, _ in (*left, *right)}) > KEYS:
        # Too many keys: both are told apart by tags before they are aligned.
        left = _flat(folded([(_renamed(n), g) for n, g in left]), 0)
        right = _flat(folded([(_renamed(n), g) for n, g in right]), len(left))
        place = {node.key: at for at, (node, _) in enumerate(left)}
    matched = _longest([(place[node.key], at) for at, (node, _) in enumerate(right) if node.key in place])
    out: Flat = []
    i = j = 0
    for x, y in [*matched, (len(left), len(right))]:
        for node, groups in (*left[i:x], *right[j:y]):
            node.optional = True
            out.append((node, groups))
        if x < len(left):
            out.append((_joined(left[x][0], right[y][0]), left[x][1] | right[y][1]))
        i, j = x + 1, y + 1
    return folded(out)


def _renamed(node: Node) -> Node:
    node.key = _coarse(node.key)
    return node


def _longest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of the pairs, ordered by the second, in which the first rises too."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for at, (x, _) in enumerate(pairs):
        k = bisect_left(tails, x)
        back.append(ends[k - 1] if k else -1)
        tails[k : k + 1] = [x]
        ends[k : k + 1] = [at]
    out = []
    at = ends[-1] if ends else -1
    while at >= 0:
        out.append(pairs[at])
        at = back[at]
    return out[::-1]


def _texts(element: markup.Element) -> Iterator[tuple[str, int]]:
    """All blocks of text below an element, in page order."""
    stack: list[markup.Element | tuple[str, int]] = [element]
    while stack:
        kid = stack.pop()
        if isinstance(kid, tuple):
            yield kid
        else:
            stack.extend(reversed(kid.kids))


def of_page(element: markup.Element, depth: int = 0) -> Node:
    """One page as a wrapper: its own recurrences are folded."""
    node = Node(element.key)
    kids: Flat = []
    for kid in element.kids if depth < DEPTH else _texts(element):
        if isinstance(kid, tuple):
            kids.append((Node("#", 1, len(kid[0]), kid[1], literal(kid[0])), frozenset()))
        else:
            kids.append((of_page(kid, depth + 1), frozenset()))
        node.chars += kids[-1][0].chars
        node.links += kids[-1][0].links
    node.kids = folded(kids)
    return node


def host(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?` or `#`, in lower case; else empty."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, share, wrapper) of the pages of a task."""
    held: dict[str, Node] = {}

    def passed_on() -> pa.RecordBatch:
        texts = [json.dumps(n.packed(), ensure_ascii=False) for n in held.values()]
        shares = [int(hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % SHARES for t in texts]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(shares, pa.int32()), pa.array(texts, pa.string())], names=["host", "share", "wrapper"])

    for batch in batches:
        for name, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            page = of_page(markup.read(html.as_py()))
            held[name] = _joined(held[name], page) if name in held else page
            if len(held) > HOSTS:
                yield passed_on()
                held = {}
    if held:
        yield passed_on()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, wrapper) of rows sorted by host: one wrapper is held while its host's rows stream by."""
    name, held = None, None

    def done() -> pa.RecordBatch:
        text = json.dumps(held.packed(), ensure_ascii=False)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text])], names=["host", "wrapper"])

    for batch in batches:
        for row_host, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            node = unpacked(json.loads(text.as_py()))
            if held is not None and row_host == name:
                held = _joined(held, node)
            else:
                if held is not None:
                    yield done()
                name, held = row_host, node
    if held is not None:
        yield done()


def inferred(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): each host's wrapper, learned from all its pages.

    Pages without a url share the empty host; null html is an empty page. Tasks first
    merge their own pages per host, so a hot host sends one wrapper per task, which
    SHARES tasks merge before one does.
    """
    let_workers_import(pages.sparkSession)
    own = pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html"))
    parts = own.mapInArrow(_share, "host string, share int, wrapper string")
    once = parts.repartition("host", "share").sortWithinPartitions("host", "wrapper").select("host", "wrapper")
    first = once.mapInArrow(_merge, "host string, wrapper string")
    return first.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_merge, "host string, wrapper string")


def expression(wrapper: str) -> str:
    """A wrapper as a regular expression of elements, slots (`#`) and literal texts."""
    return " ".join(map(str, unpacked(json.loads(wrapper)).kids))


class Plan:
    """What of a host's pages is article text, by the parts of its wrapper.

    Where the wrapper has articles or a main part, these are it. Else it is the part that
    most of the text outside links leads down to, without texts that never change and menus.
    """

    def __init__(self, wrapper: str) -> None:
        self.root = unpacked(json.loads(wrapper))
        self.kids: dict[int, dict[str, Node]] = {}
        self.region: set[int] = set()
        self.frame: set[int] = set()
        stack = [self.root]
        while stack:
            node = stack.pop()
            found = self.kids[id(node)] = {}
            for kid in node.kids:
                for part in kid.kids if kid.key == "()" else [kid]:
                    found[part.key] = part
                    stack.append(part)
        # Where nothing differs between pages, such as copies of one, all of it may be the article.
        self.varies = self.root.n >= PAGES
        self.varies = self.varies and self._mass(self.root) > 0
        self._choose()

    def kid(self, node: Node | None, key: str) -> Node | None:
        found = self.kids.get(id(node), {})
        return found.get(key) or found.get(_coarse(key))

    def _mass(self, node: Node) -> int:
        """Characters of text that changes from page to page, outside links and parts set apart."""
        if node.key == "#":
            return 0 if node.literal is not None and self.varies else node.chars - node.links
        if node.key.endswith(("~", "!")):
            return 0
        return sum(self._mass(kid) for kid in node.kids)

    def _choose(self) -> None:
        node = self.root
        while True:
            total = self._mass(node)
            single = [k for k in node.kids if not k.repeated and k.kids and not k.key.endswith(("~", "!"))]
            best = max(single, key=self._mass, default=None)
            if best is None or self._mass(best) <= MOST * total or re.match(r"(?:p|h[1-6]|pre|ul|ol|dl|table)\b", best.key):
                break
            node = best
        self.region.add(id(node))
        stack = list(node.kids)
        while stack:
            part = stack.pop()
            stack.extend(part.kids)
            fixed = self.varies and part.key == "#" and part.literal is not None and part.n >= PAGES
            menu = part.key.startswith(("ul", "ol", "dl", "table")) and part.links > LINKS * part.chars
            if fixed or menu:
                self.frame.add(id(part))


@lru_cache(maxsize=256)
def plan(wrapper: str) -> Plan:
    return Plan(wrapper)


def _central(root: markup.Element, wanted: str, marked: bool) -> list[markup.Element]:
    """The outermost articles or main parts in page order; within parts set apart by attributes only if `marked`."""
    out, stack = [], [root]
    while stack:
        element = stack.pop()
        if (element.key.endswith("!") and not marked) or element.tag in ("head", "aside", "footer", "dialog"):
            continue
        if element.central == wanted:
            out.append(element)
            continue
        stack.extend(k for k in reversed(element.kids) if not isinstance(k, tuple))
    return out


def _read_off(root: markup.Element, host_plan: Plan, chosen: set[int]) -> tuple[list[str], bool]:
    """The blocks of text that belong to the article, and whether the page has that part of the wrapper."""
    out: list[str] = []
    reached = bool(chosen) or id(host_plan.root) in host_plan.region
    # What is open: an element or text, its part of the wrapper, and whether it belongs to the article.
    stack: list[tuple] = [(root, host_plan.root, reached and not chosen)]
    while stack:
        item, node, inside = stack.pop()
        if isinstance(item, tuple):
            out.append(item[0])
            continue
        todo = []
        for kid in item.kids:
            if isinstance(kid, tuple):
                part = host_plan.kid(node, "#")
                if inside and (chosen or id(part) not in host_plan.frame):
                    todo.append((kid, part, True))
                continue
            part = host_plan.kid(node, kid.key)
            apart = kid.key.endswith(("~", "!"))
            if chosen:
                within = id(kid) in chosen or (inside and not apart)
            else:
                begins = part is not None and id(part) in host_plan.region
                reached = reached or begins
                within = not apart and id(part) not in host_plan.frame and (inside or begins)
            if within or not inside:
                todo.append((kid, part, within))
        stack.extend(reversed(todo))
    return out, reached


def extracted_text(html: str | None, wrapper: str | None) -> str:
    """The article of one page, its blocks of text parted by empty lines.

    A page that has neither an article nor the part its host's wrapper names is judged by
    a wrapper of its own.
    """
    root = markup.read(html)
    central = _central(root, "main", True)
    central = [a for m in central or [root] for a in _central(m, "article", False) if a is not m] or central
    chosen = {id(e) for e in central}
    if wrapper:
        out, reached = _read_off(root, plan(wrapper), chosen)
        if reached:
            return "\n\n".join(out)
    return "\n\n".join(_read_off(root, Plan(json.dumps(of_page(root).packed())), chosen)[0])


def extracted(
    pages: DataFrame, wrappers: DataFrame, url: str = "url", html: str = "html", text: str = "text", n_chars: str = "n_chars"
) -> DataFrame:
    """Add `text` and `n_chars`: the main text of every page, by its host's wrapper.

    Null and empty html, and pages without an article, have an empty text. Rows stay as they
    are, repeated ones too; given columns named like the added ones give way, and all others
    stay. Pages of a host without a wrapper, such as new ones, are wrappers of themselves.
    Spark sends the wrappers to all tasks if they are few, and shuffles them otherwise.
    """
    let_workers_import(pages.sparkSession)

    @F.pandas_udf("string")
    def main_text(htmls: pd.Series, of_host: pd.Series) -> pd.Series:
        return pd.Series([extracted_text(h, w) for h, w in zip(htmls, of_host, strict=True)], dtype=object)

    known = wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    rows = pages.withColumn("_host", host(F.col(url))).join(known, "_host", "left")
    rows = rows.withColumn(text, main_text(F.col(html), F.col("_wrapper"))).drop("_host", "_wrapper")
    return rows.withColumn(n_chars, F.char_length(text).cast("long"))


def main_texts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`extracted` by the wrappers of these same pages."""
    return extracted(pages, settled(inferred(pages, url, html), "wrappers", gather=True), url, html)
