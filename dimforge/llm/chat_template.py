"""A compiler for chat templates: text with ``{{ value }}`` and ``{% tags %}``.

Source is parsed into a syntax tree, constants are folded, and the tree becomes
Python closures.  Templates reach nothing but the values given to them: there
are no attributes of Python objects, no calls and no loops but ``for``.

Tags: ``for x in messages`` / ``endfor``, ``if`` / ``elif`` / ``else`` /
``endif``, ``generation`` / ``endgeneration`` (what is written between belongs
to the loss mask), ``set x = value``.  Values: names, ``x.field``, strings,
numbers, ``true`` / ``false`` / ``none``, ``+``, ``==``, ``!=``, ``and``, ``or``,
``not``, parentheses, and filters ``value | name``.  In a loop there are
``loop.first``, ``loop.last`` and ``loop.index``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
WORDS = re.compile(r"\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\"|([A-Za-z_]\w*)|(==|!=|[+|().=]))", re.S)
ESCAPED = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template isn't in the language."""


@dataclass
class Output:
    """What has been written, and the marked stretches of it, in code points."""

    parts: list[str] = field(default_factory=list)
    size: int = 0
    marked: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def text(self) -> str:
        return "".join(self.parts)


# --- syntax tree: tuples (kind, ...) -------------------------------------------------------------

class _Expression:
    def __init__(self, source: str):
        self.words: list[tuple[str, Any]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = WORDS.match(source, at)
            if not m:
                raise TemplateError(f"not understood: {source[at:at + 30]!r}")
            number, single, double, name, sign = m.groups()
            if number is not None:
                self.words.append(("const", int(number)))
            elif name is not None:
                self.words.append(("name", name))
            elif sign is not None:
                self.words.append(("sign", sign))
            else:
                raw = single if single is not None else double
                self.words.append(("const", re.sub(r"\\(.)", lambda x: ESCAPED.get(x[1], x[1]), raw, flags=re.S)))
            at = m.end()
        self.at = 0

    def _next(self, *wanted) -> bool:
        if self.at < len(self.words) and self.words[self.at] in wanted:
            self.at += 1
            return True
        return False

    def whole(self) -> tuple:
        tree = self._either()
        if self.at < len(self.words):
            raise TemplateError(f"not expected: {self.words[self.at][1]!r}")
        return tree

    def _either(self) -> tuple:
        tree = self._both()
        while self._next(("name", "or")):
            tree = ("or", tree, self._both())
        return tree

    def _both(self) -> tuple:
        tree = self._not()
        while self._next(("name", "and")):
            tree = ("and", tree, self._not())
        return tree

    def _not(self) -> tuple:
        if self._next(("name", "not")):
            return ("not", self._not())
        tree = self._sum()
        for sign in ("==", "!="):
            if self._next(("sign", sign)):
                return (sign, tree, self._sum())
        return tree

    def _sum(self) -> tuple:
        tree = self._filtered()
        while self._next(("sign", "+")):
            tree = ("+", tree, self._filtered())
        return tree

    def _filtered(self) -> tuple:
        tree = self._single()
        while self._next(("sign", "|")):
            tree = ("filter", self._name(), tree)
        return tree

    def _name(self) -> str:
        if self.at == len(self.words) or self.words[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return self.words[self.at - 1][1]

    def _single(self) -> tuple:
        if self._next(("sign", "(")):
            tree = self._either()
            if not self._next(("sign", ")")):
                raise TemplateError("a parenthesis isn't closed")
            return tree
        if self.at < len(self.words) and self.words[self.at][0] == "const":
            self.at += 1
            return ("const", self.words[self.at - 1][1])
        name = self._name()
        if name in ("true", "false", "none"):
            return ("const", {"true": True, "false": False, "none": None}[name])
        tree = ("name", name)
        while self._next(("sign", ".")):
            tree = ("field", tree, self._name())
        return tree


def parse(source: str) -> list[tuple]:
    """The template's syntax tree: text, value, if, for, generation and set nodes."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in PARTS.finditer(source):
        parts.append(("text", source[at:m.start()]))
        at = m.end()
        if m[1] is not None:
            parts.append(("value", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
    parts.append(("text", source[at:]))
    place = 0

    def block(ends: tuple[str, ...]) -> tuple[list[tuple], str]:
        nonlocal place
        nodes: list[tuple] = []
        while place < len(parts):
            kind, body = parts[place]
            place += 1
            if kind == "text":
                nodes.append(("text", body))
            elif kind == "value":
                nodes.append(("value", _Expression(body).whole()))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return nodes, body
                nodes.append(tag(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, ""

    def tag(word: str, rest: str) -> tuple:
        if word == "if":
            inside, end = block(("elif", "else", "endif"))
            end_word, _, end_rest = end.partition(" ")
            if end_word == "elif":
                other = [tag("if", end_rest)]
            else:
                other = block(("endif",))[0] if end_word == "else" else []
            return ("if", _Expression(rest).whole(), inside, other)
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+([A-Za-z_]\w*)", rest.strip())
            if not m:
                raise TemplateError(f"not a loop: {rest!r}")
            return ("for", m[1], m[2], block(("endfor",))[0])
        if word == "generation":
            return ("generation", block(("endgeneration",))[0])
        if word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError(f"not an assignment: {rest!r}")
            return ("set", name.strip(), _Expression(value).whole())
        raise TemplateError(f"no such tag: {word!r}")

    return block(())[0]


# --- constant folding ----------------------------------------------------------------------------

def _shown(value: Any) -> str:
    return "" if value is None else str(value)


PURE: dict[str, Callable[[Any], Any]] = {
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _shown(a) + _shown(b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "not": lambda a: not a,
}


def fold_value(tree: tuple, filters: Mapping[str, Callable[[str], str]]) -> tuple:
    kind = tree[0]
    if kind == "filter":
        if tree[1] not in filters:
            raise TemplateError(f"no such filter: {tree[1]!r}")
        inner = fold_value(tree[2], filters)
        return ("const", filters[tree[1]](_shown(inner[1]))) if inner[0] == "const" else ("filter", tree[1], inner)
    if kind in ("and", "or"):
        left, right = (fold_value(t, filters) for t in tree[1:])
        if left[0] == "const":
            return right if bool(left[1]) == (kind == "and") else left
        return (kind, left, right)
    if kind in PURE:
        inner = [fold_value(t, filters) for t in tree[1:]]
        return ("const", PURE[kind](*(t[1] for t in inner))) if all(t[0] == "const" for t in inner) else (kind, *inner)
    return tree


def fold(nodes: list[tuple], filters: Mapping[str, Callable[[str], str]]) -> list[tuple]:
    """Fold constant values, drop branches that can't be taken, and join neighbouring texts."""
    out: list[tuple] = []
    for node in nodes:
        kind = node[0]
        if kind == "value":
            value = fold_value(node[1], filters)
            new = [("text", _shown(value[1]))] if value[0] == "const" else [("value", value)]
        elif kind == "if":
            test = fold_value(node[1], filters)
            branches = fold(node[2], filters), fold(node[3], filters)
            new = branches[0 if test[1] else 1] if test[0] == "const" else [("if", test, *branches)]
        elif kind == "for":
            new = [("for", node[1], node[2], fold(node[3], filters))]
        elif kind == "generation":
            new = [("generation", fold(node[1], filters))]
        elif kind == "set":
            new = [("set", node[1], fold_value(node[2], filters))]
        else:
            new = [node]
        for x in new:
            if x[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + x[1])
            elif x != ("text", ""):
                out.append(x)
    return out


# --- closures ------------------------------------------------------------------------------------

Value = Callable[[dict], Any]
Step = Callable[[dict, Output], None]


def _value(tree: tuple, filters: Mapping[str, Callable[[str], str]]) -> Value:
    kind = tree[0]
    if kind == "const":
        return lambda names, v=tree[1]: v
    if kind == "name":
        return lambda names, n=tree[1]: names.get(n)
    if kind == "field":
        of, name = _value(tree[1], filters), tree[2]

        def get(names):
            got = of(names)
            return got.get(name) if isinstance(got, Mapping) else None  # nothing of other objects
        return get
    if kind == "filter":
        of, call = _value(tree[2], filters), filters[tree[1]]
        return lambda names: call(_shown(of(names)))
    parts = [_value(t, filters) for t in tree[1:]]
    if kind == "and":
        return lambda names: parts[0](names) and parts[1](names)
    if kind == "or":
        return lambda names: parts[0](names) or parts[1](names)
    call = PURE[kind]
    if len(parts) == 1:
        return lambda names: call(parts[0](names))
    return lambda names: call(parts[0](names), parts[1](names))


def looped(items: Iterable) -> Iterator[tuple[Any, dict]]:
    """Items with their loop values; reads one item ahead."""
    index, held = 0, None
    for item in items:
        if held is not None:
            yield held[0], {"first": index == 1, "last": False, "index": index}
        held, index = (item,), index + 1
    if held is not None:
        yield held[0], {"first": index == 1, "last": True, "index": index}


def _step(nodes: list[tuple], filters: Mapping[str, Callable[[str], str]]) -> Step:
    steps: list[Step] = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            steps.append(lambda names, out, t=node[1]: out.write(t))
        elif kind == "value":
            steps.append(lambda names, out, v=_value(node[1], filters): out.write(_shown(v(names))))
        elif kind == "set":
            steps.append(lambda names, out, n=node[1], v=_value(node[2], filters): names.__setitem__(n, v(names)))
        elif kind == "if":
            test, yes, no = _value(node[1], filters), _step(node[2], filters), _step(node[3], filters)
            steps.append(lambda names, out, test=test, yes=yes, no=no: (yes if test(names) else no)(names, out))
        elif kind == "generation":
            def generation(names, out, inside=_step(node[1], filters)):
                start = out.size
                inside(names, out)
                out.marked.append((start, out.size))
            steps.append(generation)
        else:
            def loop(names, out, name=node[1], source=node[2], inside=_step(node[3], filters)):
                for item, state in looped(names.get(source) or ()):
                    inside({**names, name: item, "loop": state}, out)
            steps.append(loop)

    def run(names, out):
        for s in steps:
            s(names, out)
    return run


class Template:
    """A compiled template.

    ``render`` does a whole conversation.  Where the only loop over ``messages``
    is at top level, ``before``, ``message`` and ``after`` do its parts, so that a
    conversation of any length can be rendered a message at a time.
    """

    def __init__(self, source: str, filters: Mapping[str, Callable[[str], str]]):
        self.tree = fold(parse(source), filters)
        self._run = _step(self.tree, filters)
        loops = [k for k, node in enumerate(self.tree) if node[0] == "for"]
        if len(loops) == 1:
            _, self.name, _, body = self.tree[loops[0]]
            self.before, self.after = _step(self.tree[:loops[0]], filters), _step(self.tree[loops[0] + 1:], filters)
            self.body = _step(body, filters)

    def render(self, messages: Iterable[Mapping], **names) -> Output:
        out = Output()
        self._run({**names, "messages": list(messages)}, out)
        return out

    def message(self, item: Mapping, state: Mapping, names: Mapping | None = None) -> Output:
        """One message; the first has what stands before the loop in front, the last what follows it behind."""
        out, names = Output(), dict(names or {})
        if state["first"]:
            self.before(names, out)
        self.body({**names, self.name: item, "loop": state}, out)
        if state["last"]:
            self.after(names, out)
        return out
