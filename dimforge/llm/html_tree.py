"""Main text of web pages with a tree-structured graphical model.

The block elements of a page form a tree; each is content or not.  An element's
own features give its potential, and an element and its parent share one.
Sum-product messages go up the tree and down again, which gives the exact
marginal of every element; text directly in an element is kept if content is
the likelier.  Weights maximise the likelihood of hand-labelled pages, whose
gradient needs the same marginals.
"""

from __future__ import annotations

import math
import re
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimforge.llm.labelled_pages import pages
from dimforge.llm.shared import batch_of, pick
from dimforge.llm.shingles import text_chunks

TAG = re.compile(r"<(?:!--(?:.*?-->|.*)|(/?)([A-Za-z][^\s/>\"'<]*+)((?:[^>\"'<]++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|[!?][^>]*>)", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of HTML: elements by how they are read.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section
    summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg math object select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"p": BLOCKS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
             "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
             "th": frozenset({"td", "th", "tr", "tbody", "tfoot"})}
HOLDS = {"li": frozenset({"ul", "ol", "menu", "dir"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"}),
         "tr": frozenset({"table"}), "td": frozenset({"table"}), "th": frozenset({"table"})}

PARAGRAPHS = frozenset("p h1 h2 h3 blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3 h4".split())
INNER = HEADINGS | frozenset("p li tr ul ol tbody dd dt".split())
RUN = 80  # characters from which text directly in an element counts as a paragraph


class Node:
    __slots__ = ("parent", "tag", "words", "hidden", "keep", "text", "linked", "children", "commas")

    def __init__(self, parent: int, tag: str, words: frozenset, hidden: bool, keep: int | None):
        self.parent, self.tag, self.words, self.hidden, self.keep = parent, tag, words, hidden, keep
        self.text = self.linked = self.children = self.commas = 0


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements (parents first) and the text blocks in page order, as (element, text without markup)."""
    nodes = [Node(-1, "page", frozenset(), False, None)]
    stack, blocks, pieces = [0], [], []
    links, at, end = 0, 0, len(html)

    def flush():
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                node = nodes[stack[-1]]
                node.text += len(text)
                node.commas += text.count(",") + text.count(". ")
                blocks.append((stack[-1], text))
            pieces.clear()

    def add(raw):
        if raw:
            text = unescape(raw)
            pieces.append(text)
            if links:
                nodes[stack[-1]].linked += len(text)

    def close(tag, within=frozenset()):
        for depth in range(len(stack) - 1, 0, -1):
            here = nodes[stack[depth]].tag
            if here == tag:
                del stack[depth:]
                return
            if here in within:
                return

    unclosed: set[str] = set()
    while at < end:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        m = TAG.match(html, start)
        if m is None:
            add(html[at:start + 1])
            at = start + 1
            continue
        add(html[at:start])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                flush()
                close(tag, frozenset({"table"}) if tag in ("tr", "td", "th") else frozenset())
            continue
        if tag in RAW and not m[3].endswith("/"):
            closing = None if tag in unclosed else re.compile(f"</{tag}\\s*>", re.I).search(html, at)
            if closing is None:
                unclosed.add(tag)  # nor is there one further on
            at = closing.end() if closing else (end if tag in ("script", "style", "textarea", "title", "xmp") else at)
            continue
        if tag == "a":
            links = min(1, links + 1)
        elif tag in ("br", "img", "input"):
            pieces.append(" ")
        elif tag in BLOCKS:
            flush()
            links = 0
            top = nodes[stack[-1]].tag
            if tag in CLOSED_BY.get(top, ()):
                del stack[-1]
            elif tag in HOLDS:
                for other, closers in CLOSED_BY.items():
                    if tag in closers and other != "p":
                        close(other, HOLDS[tag])
            if tag == "body" or tag == "html":
                stack[1:] = [x for x in stack[1:] if nodes[x].tag in ("html", "body")]
            if tag in VOID:
                continue
            words, hidden, keep = set(), False, None
            for name, *values in ATTRIBUTE.findall(m[3]):
                name, value = name.lower(), next((v for v in values if v), "")
                if name in ("class", "id", "role"):
                    words.update(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
                elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) \
                        or name == "aria-hidden" and value == "true":
                    hidden = True
                elif name == "keep":
                    keep = int(value)
            nodes[stack[-1]].children += 1
            nodes.append(Node(stack[-1], tag, frozenset(words), hidden, keep))
            stack.append(len(nodes) - 1)
    flush()
    return nodes, blocks


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of each element's features; sizes are those of its whole subtree."""
    text = [n.text for n in nodes]
    linked = [n.linked for n in nodes]
    commas = [n.commas for n in nodes]
    paragraphs = [int(n.text >= RUN) for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        p = nodes[k].parent
        text[p] += text[k]
        linked[p] += linked[k]
        commas[p] += commas[k]
        if nodes[k].tag in PARAGRAPHS:
            paragraphs[p] += 1
    out = []
    for k, n in enumerate(nodes):
        share = linked[k] / text[k] if text[k] else 0.0
        links = 0 if share < .05 else 1 if share < .3 else 2 if share < .7 else 3
        if n.tag in INNER:  # long texts have many of them: what all of them share may say nothing
            row = [f"tag={n.tag}"] if n.tag in HEADINGS else []
            if links:
                row.append(f"links={links},inner")
        else:
            of_page = 4 * text[k] // text[0] if text[0] else 0
            row = ["bias", f"tag={n.tag}", f"links={links}", f"links,size={links},{text[k] >= RUN}",
                   f"size={min(5, text[k].bit_length() // 2)}", f"commas={min(3, commas[k].bit_length())}",
                   f"of page={of_page}", f"paragraphs={min(3, paragraphs[k].bit_length())}"]
        for w in n.words:
            row += [f"word={w}", f"start={w[:5]}"]
        if n.hidden:
            row.append("hidden")
        out.append(row)
    return out


def pair_name(child: Node, parent: Node) -> str:
    """Which pair potential an element shares with its parent."""
    return "inner" if child.tag in INNER else "top" if parent.tag in ("page", "html", "body") else "block"


def sum_product(parents: list[int], unary: np.ndarray, pairs: list[np.ndarray]):
    """Exact marginals of a tree, and of each element with its parent (parent's label first).

    ``unary`` are log potentials per label; ``pairs[k]`` those of element k with its parent.
    """
    n = len(parents)
    up = [None] * n               # message of k to its parent
    inside = [(float(a), float(b)) for a, b in unary]
    for k in range(n - 1, 0, -1):
        a, b = inside[k]
        (p00, p01), (p10, p11) = pairs[k]
        m0, m1 = _log_sum(p00 + a, p01 + b), _log_sum(p10 + a, p11 + b)
        top = max(m0, m1)
        up[k] = (m0 - top, m1 - top)
        x, y = inside[parents[k]]
        inside[parents[k]] = (x + up[k][0], y + up[k][1])
    belief = [inside[0]] * n
    joint = [None] * n
    for k in range(1, n):
        x, y = belief[parents[k]]
        x, y = x - up[k][0], y - up[k][1]      # all the parent knows but from this element
        a, b = inside[k]
        (p00, p01), (p10, p11) = pairs[k]
        joint[k] = (x + p00 + a, x + p01 + b, y + p10 + a, y + p11 + b)
        down0, down1 = _log_sum(x + p00, y + p10), _log_sum(x + p01, y + p11)
        top = max(down0 + a, down1 + b)
        belief[k] = (a + down0 - top, b + down1 - top)
    return [1 / (1 + math.exp(min(700.0, a - b))) for a, b in belief], joint


def _log_sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _gold(nodes: list[Node]) -> list[int]:
    out = []
    for n in nodes:
        out.append(n.keep if n.keep is not None else out[n.parent] if n.parent >= 0 else 0)
    return out


def forest_marginals(parents: np.ndarray, levels: list[np.ndarray], unary: np.ndarray, pairs: np.ndarray):
    """``sum_product`` of many trees at once, level by level; roots have themselves as parent."""
    inside, up = unary.copy(), np.zeros_like(unary)
    for level in reversed(levels[1:]):
        m = np.logaddexp(pairs[level][:, :, 0] + inside[level][:, None, 0], pairs[level][:, :, 1] + inside[level][:, None, 1])
        up[level] = m - m.max(axis=1, keepdims=True)
        for y in (0, 1):
            inside[:, y] += np.bincount(parents[level], weights=up[level][:, y], minlength=len(inside))
    belief, joint = inside.copy(), np.zeros_like(pairs)
    for level in levels[1:]:
        rest = belief[parents[level]] - up[level]      # all the parent knows but from this element
        joint[level] = rest[:, :, None] + pairs[level] + inside[level][:, None, :]
        m = np.logaddexp(joint[level][:, 0], joint[level][:, 1])
        belief[level] = m - m.max(axis=1, keepdims=True)
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    return 1 / (1 + np.exp(np.minimum(700.0, belief[:, 0] - belief[:, 1]))), joint / joint.sum(axis=(1, 2), keepdims=True)


@cache
def learn(steps: int = 250, rate: float = 0.5, decay: float = 1e-3) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Weights of features and of pairs: gradient ascent on the likelihood of the labelled pages, all as one forest."""
    names: dict[str, int] = {}
    kinds = ("inner", "block", "top")
    parents, depths, gold, kind, at_node, at_feature = [], [], [], [], [], []
    for html in pages():
        nodes, _ = parse(html)
        first = len(parents)
        for k, (n, row) in enumerate(zip(nodes, features(nodes))):
            parents.append(first + max(0, n.parent))
            depths.append(depths[first + n.parent] + 1 if k else 0)
            kind.append(kinds.index(pair_name(n, nodes[n.parent])) if k else 0)
            at_node += [first + k] * len(row)
            at_feature += [names.setdefault(f, len(names)) for f in row]
        gold += _gold(nodes)
    parents, depths, gold, kind = (np.array(x) for x in (parents, depths, gold, kind))
    levels = [np.flatnonzero(depths == d) for d in range(depths.max() + 1)]
    below = np.flatnonzero(depths > 0)
    wanted = np.zeros((len(kinds), 2, 2))
    np.add.at(wanted, (kind[below], gold[parents[below]], gold[below]), 1)
    weights, pairs = np.zeros(len(names)), np.zeros((len(kinds), 2, 2))
    moved, pairs_moved = np.full(len(names), 1e-6), np.full(pairs.shape, 1e-6)
    for _ in range(steps):
        score = np.bincount(at_node, weights=weights[at_feature], minlength=len(parents))
        p, joint = forest_marginals(parents, levels, np.stack((-score, score), axis=1), pairs[kind])
        expected = np.zeros_like(pairs)
        np.add.at(expected, kind[below], joint[below])
        gain = np.bincount(at_feature, weights=(gold - p)[at_node])
        moved += gain ** 2  # steps as long as a feature has moved little allow the weights of rare ones to follow
        weights = weights * (1 - decay) + rate * gain / np.sqrt(moved)
        pair_gain = wanted - expected
        pair_gain[0] = (pair_gain[0] + pair_gain[0, ::-1, ::-1]) / 2  # an inner element without features leaves its parent as it is
        pairs_moved += pair_gain ** 2
        pairs = pairs * (1 - decay) + rate * pair_gain / np.sqrt(pairs_moved)
    return ({f: np.array((-weights[i], weights[i])) for f, i in names.items()}, {x: pairs[i] for i, x in enumerate(kinds)})


def main_text(html: str, model) -> str:
    weights, pairs = model
    nodes, blocks = parse(html)
    if not blocks:
        return ""
    unary = np.zeros((len(nodes), 2))
    for k, row in enumerate(features(nodes)):
        for f in row:
            w = weights.get(f)
            if w is not None:
                unary[k] += w
    p, _ = sum_product([n.parent for n in nodes], unary, [pairs[pair_name(n, nodes[n.parent])] for n in nodes])
    return " ".join(text for k, text in blocks if p[k] > 0.5)


def _extract(model):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        learned = (model.value[0], {k: v.tolist() for k, v in model.value[1].items()})
        for batch in batches:
            for a, b in text_chunks(batch.column(2)):
                texts = [main_text(h, learned) if h else "" for h in batch.column(2).slice(a, b - a).to_pylist()]
                yield batch_of(schema, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), texts,
                               [len(t) for t in texts])
    return run


def extract_main_text(web_pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``(page_id, url, text, n_chars)``, a row for each input row.

    Null or empty html, and pages without content, have empty text.  Markup that
    is cut off or not closed is read as far as it goes.  Other columns are
    ignored.
    """
    model = web_pages.sparkSession.sparkContext.broadcast(learn())
    return pick(web_pages, page_id="long", url="string", html="string").mapInArrow(
        _extract(model), "page_id long, url string, text string, n_chars long")
