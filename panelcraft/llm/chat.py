"""Chat formatting: a small sandboxed template language compiled to closures.

A template is parsed into a syntax tree, constant parts are folded, and the
tree becomes nested Python closures. The language has

* ``{{ expression }}``, ``{% set name = expression %}``,
* ``{% for name in expression %} ... {% endfor %}`` with ``loop.index``, ``loop.first``, ``loop.last``,
* ``{% if %} {% elif %} {% else %} {% endif %}``,
* ``{% generation %} ... {% endgeneration %}``: what stands inside belongs to the loss mask,
* ``-`` next to a marker trims the white space beside it.

Expressions know text, numbers, names, ``a.b``, ``a['b']``, ``+ ~ == != < <= > >= in not and or``
and the filters ``trim upper lower length escape``. There is no call, no attribute of an
object and no name beyond those given: keys are looked up in mappings only.

The filter ``escape`` makes a text free of the template's control strings and
is undone by ``unescape``: a backslash is doubled, and every control string
gets a backslash after its first character.

Defined cases: a null text is empty, a null role is an empty role; turns are
ordered by (turn, role, text), nulls first, so repeated turns are kept in a
fixed order; rows with a null conversation id form one conversation of their
own. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcraft.llm.common import map_rows

#: Strings with a meaning in formatted conversations.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")

TEMPLATE = """
{%- for m in messages -%}
  {{- '<s>[ROLE]' + m.role | escape + '[/ROLE]' -}}
  {%- if m.role == 'assistant' -%}
    {%- generation -%}{{- m.text | escape -}}{%- endgeneration -%}
  {%- else -%}
    {{- '[INST]' ~ (m.text | escape) ~ '[/INST]' -}}
  {%- endif -%}
  {{- '</s>' -}}
{%- endfor -%}
"""

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_PARTS = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\})", re.S)
_TOKEN = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>[0-9]+)"
    r"|(?P<name>[A-Za-z_][A-Za-z_0-9]*)|(?P<sign>==|!=|<=|>=|[-+~<>()\[\].|]))"
)

Node = tuple
Closure = Callable[[dict], Any]


class TemplateError(ValueError):
    """The template is not in the language, or it asks for something that is not there."""


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": len,
    "escape": lambda v: escape(_text(v)),
}


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _compare(sign: str, a: Any, b: Any) -> bool:
    if sign == "==":
        return a == b
    if sign == "!=":
        return a != b
    if sign == "in":
        return a in b
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[sign]


def _add(a: Any, b: Any) -> Any:
    return a + b if type(a) is type(b) else _text(a) + _text(b)


# Expressions: precedence or < and < not < comparison < sum < filter < item.


class _Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str:
        if self.at >= len(self.tokens) or (values and self.tokens[self.at][1] not in values):
            raise TemplateError(f"expected {' or '.join(values) or 'a value'}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Node:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.peek("or"):
            self.take()
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.peek("and"):
            self.take()
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        if self.peek("not"):
            self.take()
            return ("not", self.negated())
        node = self.total()
        if self.peek("==", "!=", "<", "<=", ">", ">=", "in"):
            return ("compare", self.take(), node, self.total())
        return node

    def total(self) -> Node:
        node = self.filtered()
        while self.peek("+", "~"):
            node = ("join" if self.take() == "~" else "add", node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.item()
        while self.peek("|"):
            self.take()
            name = self.take()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def item(self) -> Node:
        node = self.value()
        while self.peek(".", "["):
            if self.take() == ".":
                node = ("item", node, ("const", self.take()))
            else:
                node = ("item", node, self.either())
                self.take("]")
        return node

    def value(self) -> Node:
        if self.peek("("):
            self.take()
            node = self.either()
            self.take(")")
            return node
        if self.at >= len(self.tokens) or self.tokens[self.at][0] == "sign":
            raise TemplateError("expected a value")
        kind, word = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("const", _unquote(word[1:-1]))
        if kind == "number":
            return ("const", int(word))
        words = {"true": True, "false": False, "none": None}
        return ("const", words[word]) if word in words else ("name", word)


def _unquote(text: str) -> str:
    known = {"n": "\n", "t": "\t"}
    return re.sub(r"\\(.)", lambda m: known.get(m[1], m[1]), text, flags=re.S)


# Statements.


def parse(template: str) -> Node:
    """The syntax tree of a template: ("block", [nodes])."""
    parts = _PARTS.split(template)
    for i in range(1, len(parts), 2):
        if parts[i][2] == "-":
            parts[i - 1] = parts[i - 1].rstrip()
        if parts[i][-3] == "-":
            parts[i + 1] = parts[i + 1].lstrip()
    items = [
        ("plain", p) if not i % 2 else (p[1], p[2:-2].strip("-").strip())
        for i, p in enumerate(parts)
        if i % 2 or p
    ]
    node, at = _block(items, 0, ())
    if at < len(items):
        raise TemplateError(f"unexpected {items[at][1]!r}")
    return node


def _block(items: list, at: int, ends: tuple[str, ...]) -> tuple[Node, int]:
    nodes: list[Node] = []
    while at < len(items):
        kind, body = items[at]
        if kind == "plain":
            nodes.append(("out", ("const", body)))
            at += 1
        elif kind == "{":
            nodes.append(("out", _Expression(body).whole()))
            at += 1
        else:
            word, _, rest = body.partition(" ")
            if word in ends:
                return ("block", nodes), at
            node, at = _statement(word, rest, items, at + 1)
            nodes.append(node)
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return ("block", nodes), at


def _statement(word: str, rest: str, items: list, at: int) -> tuple[Node, int]:
    if word == "set":
        name, sign, value = rest.partition("=")
        if not sign or not name.strip().isidentifier():
            raise TemplateError(f"cannot read set {rest!r}")
        return ("set", name.strip(), _Expression(value).whole()), at
    if word == "for":
        found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
        if not found:
            raise TemplateError(f"cannot read for {rest!r}")
        body, at = _block(items, at, ("endfor",))
        return ("for", found[1], _Expression(found[2]).whole(), body), at + 1
    if word == "generation":
        body, at = _block(items, at, ("endgeneration",))
        return ("generation", body), at + 1
    if word == "if":
        cases = []
        while word in ("if", "elif"):
            test = _Expression(rest).whole()
            body, at = _block(items, at, ("elif", "else", "endif"))
            cases.append((test, body))
            word, _, rest = items[at][1].partition(" ")
            at += 1
        other: Node = ("block", [])
        if word == "else":
            other, at = _block(items, at, ("endif",))
            at += 1
        return ("if", cases, other), at
    raise TemplateError(f"no statement {word!r}")


# Folding of constants.


def fold(node: Node) -> Node:
    """The tree with constant expressions computed, dead branches gone and plain text merged."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "block":
        return ("block", _merged([fold(n) for n in node[1]]))
    if kind in ("generation", "out"):
        return (kind, fold(node[1]))
    if kind == "set":
        return ("set", node[1], fold(node[2]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "if":
        cases = []
        for test, body in node[1]:
            test = fold(test)
            if test[0] != "const":
                cases.append((test, fold(body)))
            elif test[1]:
                return ("if", cases, fold(body)) if cases else fold(body)
        return ("if", cases, fold(node[2])) if cases else fold(node[2])
    parts = [fold(n) if isinstance(n, tuple) else n for n in node[1:]]
    made = (kind, *parts)
    if all(p[0] == "const" for p in parts if isinstance(p, tuple)):
        return ("const", _value(made)({}))
    return made


def _merged(nodes: list[Node]) -> list[Node]:
    out: list[Node] = []
    for n in nodes:
        if n[0] == "block":
            out = _merged(out + n[1])
        elif n[0] == "out" and n[1][0] == "const" and out and out[-1][0] == "out" and out[-1][1][0] == "const":
            out[-1] = ("out", ("const", _text(out[-1][1][1]) + _text(n[1][1])))
        else:
            out.append(n)
    return out


# Code generation: every node becomes a closure over its children's closures.


def _value(node: Node) -> Closure:
    kind, *rest = node
    if kind == "const":
        constant = rest[0]
        return lambda names: constant
    if kind == "name":
        name = rest[0]

        def look_up(names: dict) -> Any:
            if name not in names:
                raise TemplateError(f"no name {name!r}")
            return names[name]

        return look_up
    if kind == "filter":
        run, inner = FILTERS[rest[0]], _value(rest[1])
        return lambda names: run(inner(names))
    if kind == "compare":
        sign, left, right = rest[0], _value(rest[1]), _value(rest[2])
        return lambda names: _compare(sign, left(names), right(names))
    if kind == "not":
        inner = _value(rest[0])
        return lambda names: not inner(names)
    left, right = _value(rest[0]), _value(rest[1])
    if kind == "and":
        return lambda names: left(names) and right(names)
    if kind == "or":
        return lambda names: left(names) or right(names)
    if kind == "add":
        return lambda names: _add(left(names), right(names))
    if kind == "join":
        return lambda names: _text(left(names)) + _text(right(names))
    if kind == "item":

        def item(names: dict) -> Any:
            owner, key = left(names), right(names)
            if isinstance(owner, dict):
                return owner.get(key)
            if isinstance(owner, (list, str)) and isinstance(key, int):
                return owner[key] if key < len(owner) else None
            raise TemplateError(f"no item {key!r}")

        return item
    raise TemplateError(f"no expression {kind!r}")


class Output:
    """Text so far, its length, and the spans under the loss mask."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _run(node: Node) -> Callable[[dict, Output], None]:
    kind, *rest = node
    if kind == "block":
        steps = [_run(n) for n in rest[0]]

        def block(names: dict, out: Output) -> None:
            for step in steps:
                step(names, out)

        return block
    if kind == "out":
        value = _value(rest[0])
        return lambda names, out: out.write(_text(value(names)))
    if kind == "set":
        name, value = rest[0], _value(rest[1])
        return lambda names, out: names.__setitem__(name, value(names))
    if kind == "generation":
        inner = _run(rest[0])

        def generation(names: dict, out: Output) -> None:
            start = out.length
            inner(names, out)
            out.spans.append((start, out.length))

        return generation
    if kind == "for":
        name, values, body = rest[0], _value(rest[1]), _run(rest[2])

        def loop(names: dict, out: Output) -> None:
            items = list(values(names))
            own = dict(names)
            for i, item in enumerate(items):
                own[name] = item
                own["loop"] = {"index": i + 1, "first": i == 0, "last": i + 1 == len(items)}
                body(own, out)

        return loop
    tests = [(_value(test), _run(body)) for test, body in rest[0]]
    other = _run(rest[1])

    def choose(names: dict, out: Output) -> None:
        for test, body in tests:
            if test(names):
                return body(names, out)
        return other(names, out)

    return choose


@functools.lru_cache(maxsize=16)
def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages (role, text) to the formatted text and its loss spans."""
    run = _run(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run({"messages": messages}, out)
        return "".join(out.parts), out.spans

    return render


_TURN = re.compile(
    r"<s>\[ROLE\](?P<role>.*?)\[/ROLE\](?:\[INST\](?P<text>.*?)\[/INST\]</s>|(?P<reply>.*?)</s>)", re.S
)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a text formatted by ``TEMPLATE``."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        body = m["reply"] if m["text"] is None else m["text"]
        turns.append((unescape(m["role"]), unescape(body)))
    if at != len(formatted):
        raise ValueError("this is not a formatted conversation")
    return turns


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, formatted, loss_spans (start, end in code points) per conversation."""
    turns = conversations.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("turn"),
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )

    def made(conversations: list) -> Iterator[tuple]:
        render = compile_template(template)
        for conversation in conversations:
            text, spans = render(conversation)
            yield text, [{"start": s, "end": e} for s, e in spans]

    schema = "formatted string, loss_spans array<struct<start:long,`end`:long>>"
    return map_rows(turns, ["conv_id"], ["turns"], made, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of the turns and of the loss text, read back from the output."""

    def made(texts: list[str], all_spans: list) -> Iterator[tuple]:
        for text, spans in zip(texts, all_spans, strict=True):
            turns = read_back(text)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            body = "".join(f"{role}\n{said}\n" for role, said in turns)
            yield len(turns), _sha256(body), len(loss), _sha256(loss), len(text)

    schema = (
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return map_rows(formatted, ["conv_id"], ["formatted", "loss_spans"], made, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
