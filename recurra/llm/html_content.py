"""Main text of web pages by a tree-structured graphical model.

Block elements and the texts in them are nodes that are content or not. A node's own
evidence is its tag, the words of its class, id and role, and for texts their length
and links; a parent and a child have a joint potential that depends on the child's
tag. Messages go up from the leaves and down from the root (sum-product), which gives
the exact marginal of every text. All tables are counted on labelled pages.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import map_batches, text_or_empty
from recurra.llm.labelled_pages import pages

# Element kinds of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup, or that show nothing of it; without an end they go on to the end of the page.
RAW = set("script style textarea title noscript template iframe noframes".split())
# Elements that are no content, with all in them. Without an end they close with their parent or before the next block.
NO_CONTENT = set("svg object select datalist optgroup option button canvas annotation annotation-xml".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var nobr".split()) | set(
    "math semantics mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle mpadded mspace mphantom".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"thead", "tbody"}, "tbody": {"thead", "tbody"}}
BLOCKS = CLOSES_P | set(SIBLINGS)
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "thead": {"table"}, "tbody": {"table"}}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
NAME_WORDS = re.compile(r"[a-z]+")


@dataclass
class Node:
    parent: int
    kind: str
    evidence: list[str]
    text: str = ""
    linked: int = 0
    mark: str = ""
    children: list[int] = field(default_factory=list)


@functools.lru_cache(maxsize=4096)
def evidence_of(tag: str, attributes: str) -> tuple[tuple[str, ...], str]:
    """Evidence of an element and its training mark, if any."""
    out, mark = ["<" + tag], ""
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or name == "style" and HIDDEN.search(value):
            out.append("hidden")
        elif name in ("keep", "drop") and not value:
            mark = name
        elif name in ("class", "id", "role"):
            out += {("role:" if name == "role" else "name:") + w for w in NAME_WORDS.findall(value.lower())}
    return tuple(out), mark


def parse(page: str) -> list[Node]:
    """Nodes of a page, parents before children. Texts are cut at block elements and line breaks; scripts, forms' controls and the like are left out."""
    nodes = [Node(-1, "root", ["<root"])]
    stack: list[tuple[str, int]] = [("root", 0)]  # open elements; inline ones point to their block
    text: list[str] = []
    linked = links = dropped = 0
    at, end = 0, len(page)

    def add(segment: str) -> None:
        nonlocal linked
        if segment and not dropped:
            plain = html.unescape(segment) if "&" in segment else segment
            text.append(plain)
            linked += len(plain) if links else 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join("".join(text).split())
            if words:
                owner = stack[-1][1]
                nodes.append(Node(owner, "text", [], words, linked))
                nodes[owner].children.append(len(nodes) - 1)
            text.clear()
            linked = 0

    def close(upto: int) -> None:
        nonlocal links, dropped
        links -= sum(t == "a" for t, _ in stack[upto:])
        dropped -= sum(t in NO_CONTENT for t, _ in stack[upto:])
        del stack[upto:]

    def innermost(names: set[str], barrier: set[str]) -> int | None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in barrier:
                return None
        return None

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            rest = page[at:]
            cut = rest.rfind("<")
            # a tag that the end of the page cuts off is no text
            add(rest[:cut] if cut >= 0 and re.match(r"<[/!?a-zA-Z]", rest[cut:]) else rest)
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br" or tag == "hr":
            flush()
        elif m[1]:
            if tag in RAW:
                continue
            i = innermost({tag}, set())
            if i is not None:
                if any(t not in INLINE and t not in NO_CONTENT for t, _ in stack[i:]):
                    flush()
                close(i)
        elif tag in RAW:
            if not m[3].endswith("/"):
                stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = stop.end() if stop else end
        elif tag in NO_CONTENT:
            if not m[3].endswith("/"):
                stop = re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                if stop and stop[1]:
                    at = stop.end()
                else:
                    dropped += 1
                    stack.append((tag, stack[-1][1]))
        elif tag not in VOID:
            if dropped:
                if tag not in BLOCKS:
                    continue
                first = len(stack)
                while stack[first - 1][0] in INLINE or stack[first - 1][0] in NO_CONTENT:
                    first -= 1
                close(next(i for i in range(first, len(stack)) if stack[i][0] in NO_CONTENT))
            if tag in INLINE:
                links += tag == "a"
                stack.append((tag, stack[-1][1]))
                continue
            flush()
            if tag in CLOSES_P and (i := innermost({"p"}, {"table", "td", "th", "button"})) is not None:
                close(i)
            if tag in SIBLINGS and (i := innermost(SIBLINGS[tag], SCOPES[tag])) is not None:
                close(i)
            evidence, mark = evidence_of(tag, m[3])
            owner = stack[-1][1]
            nodes.append(Node(owner, tag, list(evidence), mark=mark))
            nodes[owner].children.append(len(nodes) - 1)
            if not m[3].endswith("/"):
                stack.append((tag, len(nodes) - 1))
    flush()
    for n in nodes:
        if n.kind == "text":
            size = len(n.text)
            n.evidence = [f"chars:{min(size.bit_length(), 9)}", f"links:{4 * n.linked // max(size, 1)}", "stop" if n.text[-1] in ".!?:…\"”" else "open"]
    return nodes


@dataclass
class Model:
    """Log potentials: of evidence by state, of (parent, child) states by the child's kind."""

    unary: dict[str, tuple[float, float]]
    joint: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    general: tuple[tuple[float, float], tuple[float, float]]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content, by messages up and down the tree."""
        own: list[list[float]] = []
        for n in nodes:
            a = b = 0.0
            for e in n.evidence:
                u = self.unary.get(e)
                if u:
                    a, b = a + u[0], b + u[1]
            own.append([a, b])
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):  # upward: children come after their parents
            n, (a, b) = nodes[i], own[i]
            (p00, p01), (p10, p11) = self.joint.get(n.kind, self.general)
            up = log_sum(p00 + a, p01 + b), log_sum(p10 + a, p11 + b)
            sent[i] = up
            own[n.parent][0] += up[0]
            own[n.parent][1] += up[1]
        out = [0.0] * len(nodes)
        for i, n in enumerate(nodes):  # downward: own[parent] already holds all that the parent knows
            if i:
                a, b = own[n.parent][0] - sent[i][0], own[n.parent][1] - sent[i][1]
                (p00, p01), (p10, p11) = self.joint.get(n.kind, self.general)
                own[i][0] += log_sum(p00 + a, p10 + b)
                own[i][1] += log_sum(p01 + a, p11 + b)
            d = own[i][0] - own[i][1]
            out[i] = 1 / (1 + math.exp(min(d, 700))) if d > -700 else 1.0
        return out


def log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def trust(evidence: str) -> float:
    """Weight of evidence: names say most; texts of one part are alike, so each of them counts little."""
    return 1.5 if evidence.startswith(("name:", "role:", "hidden")) else 0.6 if evidence.startswith("<") else 0.15


def fit(labelled: list[str], smooth: float = 0.2) -> Model:
    """Count the tables on pages whose elements are marked ``keep`` or ``drop``."""
    seen: tuple[Counter, Counter] = Counter(), Counter()
    pairs: Counter = Counter()
    states = [0, 0]
    for page in labelled:
        nodes = parse(page)
        label = [0] * len(nodes)
        for i, n in enumerate(nodes):
            label[i] = {"keep": 1, "drop": 0}.get(n.mark, label[n.parent] if i else 0)
            states[label[i]] += 1
            seen[label[i]].update(n.evidence)
            if i:
                pairs[n.kind, label[n.parent], label[i]] += 1
    unary = {e: tuple(trust(e) * math.log((seen[s][e] + smooth) / (states[s] + 2 * smooth)) for s in (0, 1)) for e in seen[0] | seen[1]}
    every = [[sum(n for (_, p, c), n in pairs.items() if (p, c) == (i, j)) for j in (0, 1)] for i in (0, 1)]

    def table(kinds: set[str]) -> tuple[tuple[float, float], tuple[float, float]]:
        # kinds that are rare under a parent of one state lean on all kinds
        count = [[sum(pairs[k, p, c] for k in kinds) + smooth + 4 * every[p][c] / sum(every[p]) for c in (0, 1)] for p in (0, 1)]
        return tuple(tuple(math.log(count[p][c] / sum(count[p])) for c in (0, 1)) for p in (0, 1))

    kinds = {k for k, _, _ in pairs}
    return Model(unary, {k: table({k}) for k in kinds}, table(kinds))


@functools.cache
def model() -> Model:
    """The model of this package, counted once in each Python worker."""
    return fit(list(pages()))


def main_text(page: str, least: float = 0.5) -> tuple[str, int, int]:
    """Main text of a page, and the number of its texts that are content and of all."""
    nodes = parse(page)
    texts = [(n.text, p) for n, p in zip(nodes, model().marginals(nodes)) if n.kind == "text"]
    kept = [t for t, p in texts if p >= least]
    return "\n".join(kept), len(kept), len(texts)


def extract(table: DataFrame, least: float = 0.5) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) of every page.

    Null pages are empty and give an empty text; a page without content too. Every row is
    kept, null and repeated ids included; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(p, least) for p in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([t for t, _, _ in found], pa.string()), pa.array([len(t) for t, _, _ in found], pa.int64()),
            pa.array([n for _, _, n in found], pa.int32()), pa.array([k for _, k, _ in found], pa.int32())], ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    rows = table.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long, n_blocks int, n_kept int")
