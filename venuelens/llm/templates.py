"""A small sandboxed template language, compiled to Python closures.

``{{ value }}`` writes a value, ``{% if %} {% elif %} {% else %} {% endif %}`` choose, ``{% for m in messages %}
{% endfor %}`` goes over the messages, ``{% generation %} {% endgeneration %}`` mark what the model is to learn.
Values are texts, whole numbers, true, false, names, fields (``m.role``), ``+``, ``==``, ``!=``, ``not``, ``and``,
``or``, brackets, and filters (``m.text | escape``). Names are the loop's variable, ``loop`` (first, index0) and what
the caller gives. There are no calls, no attributes of Python objects and no imports: a field is a key of a mapping.

A template is parsed into a tree of tuples; parts that depend on no name are folded; the rest becomes closures that
append (text, learned) pieces to a list. A missing field is the empty text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

# Marks of the chat format.
CHAT = (
    "{% for m in messages %}<|im_start|>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "<|im_end|>\n{% endfor %}"
)


class TemplateError(ValueError):
    """The template is not well formed or asks for something it may not have."""


def escape(text: str) -> str:
    """No control string ``<|...|>`` is left in the text; ``unescape`` gives it back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower}

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[().|+]))")


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while source[at:].strip():
        match = _TOKEN.match(source, at)
        if not match:
            raise TemplateError(f"cannot read {source[at:].strip()!r}")
        kind = ("text", "number", "name", "sign")[match.lastindex - 1]
        out.append((kind, match[match.lastindex]))
        at = match.end()
    return out


class _Values:
    """Parses one value."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0
        self.source = source

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else None

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted:
            self.at += 1
            return True
        return False

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"cannot read {self.source.strip()!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = _fold(("or", tree, self.both()))
        return tree

    def both(self):
        tree = self.opposite()
        while self.take("and"):
            tree = _fold(("and", tree, self.opposite()))
        return tree

    def opposite(self):
        return _fold(("not", self.opposite())) if self.take("not") else self.compared()

    def compared(self):
        tree = self.sum()
        while self.peek() in ("==", "!="):
            sign = self.peek()
            self.at += 1
            tree = _fold((sign, tree, self.sum()))
        return tree

    def sum(self):
        tree = self.filtered()
        while self.take("+"):
            tree = _fold(("+", tree, self.filtered()))
        return tree

    def filtered(self):
        tree = self.atom()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if name not in FILTERS or kind != "name":
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = _fold(("filter", name, tree))
        return tree

    def atom(self):
        if self.at >= len(self.tokens):
            raise TemplateError(f"value missing in {self.source.strip()!r}")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return ("constant", int(value))
        if value == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("bracket not closed")
            return tree
        if kind != "name" or value in ("and", "or", "not"):
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false"):
            return ("constant", value == "true")
        tree = ("name", value)
        while self.take("."):
            kind, field = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name":
                raise TemplateError("field missing")
            self.at += 1
            tree = ("field", tree, field)
        return tree


def _shown(value) -> str:
    return value if isinstance(value, str) else "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _fold(tree):
    """The value of an operation on constants, else the operation."""
    if all(part[0] == "constant" for part in tree[1:] if isinstance(part, tuple)):
        return ("constant", _closure(tree)({}))
    return tree


def _closure(tree) -> Callable[[Mapping], object]:
    kind = tree[0]
    if kind == "constant":
        return lambda scope, value=tree[1]: value
    if kind == "name":
        return lambda scope, name=tree[1]: scope.get(name, "")
    if kind == "field":
        of, name = _closure(tree[1]), tree[2]

        def field(scope):
            value = of(scope)
            return value.get(name, "") if isinstance(value, Mapping) else ""

        return field
    if kind == "filter":
        change, of = FILTERS[tree[1]], _closure(tree[2])
        return lambda scope: change(_shown(of(scope)))
    if kind == "not":
        of = _closure(tree[1])
        return lambda scope: not of(scope)
    left, right = _closure(tree[1]), _closure(tree[2])
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    if kind == "==":
        return lambda scope: left(scope) == right(scope)
    if kind == "!=":
        return lambda scope: left(scope) != right(scope)

    def plus(scope):
        a, b = left(scope), right(scope)
        return a + b if type(a) is type(b) is int else _shown(a) + _shown(b)

    return plus


def parse(source: str) -> list[tuple]:
    """The tree: ("text", s), ("write", value), ("if", [(value, body)...]), ("for", name, body), ("generation", body)."""
    parts: list[tuple[str, str]] = []
    at = 0
    for match in _TAG.finditer(source):
        parts.append(("text", source[at : match.start()]))
        parts.append(("write", match[1]) if match[1] is not None else ("tag", match[2].strip()))
        at = match.end()
    parts.append(("text", source[at:]))
    parts.reverse()

    def body(*ends: str) -> tuple[list[tuple], str]:
        out: list[tuple] = []
        while parts:
            kind, text = parts.pop()
            word = text.split(None, 1)[0] if text.split() else ""
            if kind == "text":
                node = ("text", text)
            elif kind == "write":
                tree = _Values(text).whole()
                node = ("text", _shown(tree[1])) if tree[0] == "constant" else ("write", tree)
            elif word in ends:
                return out, text
            elif word == "generation":
                node = ("generation", body("endgeneration")[0])
            elif word == "for":
                match = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", text)
                if not match:
                    raise TemplateError(f"only messages can be gone over: {text!r}")
                node = ("for", match[1], body("endfor")[0])
            elif word == "if":
                branches, tag = [], text
                while tag != "endif":
                    value = ("constant", True) if tag == "else" else _Values(tag.split(None, 1)[1] if " " in tag else "").whole()
                    inner, tag = body("elif", "else", "endif")
                    branches.append((value, inner))
                node = _folded_if(branches)
            else:
                raise TemplateError(f"unexpected tag {text!r}")
            for one in node[1] if node[0] == "block" else [node]:
                if one[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + one[1])
                elif one != ("text", ""):
                    out.append(one)
        if ends:
            raise TemplateError(f"{ends[-1]} missing")
        return out, ""

    return body()[0]


def _folded_if(branches: list[tuple]) -> tuple:
    kept = []
    for value, inner in branches:
        if value[0] == "constant" and not value[1]:
            continue
        kept.append((value, inner))
        if value[0] == "constant":
            break
    if not kept:
        return ("block", [])
    return ("block", kept[0][1]) if kept[0][0][0] == "constant" else ("if", kept)


Piece = tuple[str, bool]


def _writer(nodes: list[tuple], learned: bool) -> Callable[[dict, list[Piece]], None]:
    steps = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda scope, out, piece=(node[1], learned): out.append(piece))
        elif node[0] == "write":
            steps.append(lambda scope, out, of=_closure(node[1]): out.append((_shown(of(scope)), learned)))
        elif node[0] == "generation":
            steps.append(_writer(node[1], True))
        elif node[0] == "if":
            choices = [(_closure(value), _writer(inner, learned)) for value, inner in node[1]]

            def choose(scope, out, choices=choices):
                for test, write in choices:
                    if test(scope):
                        return write(scope, out)

            steps.append(choose)
        else:
            raise TemplateError("messages can be gone over at the top only")

    def run(scope: dict, out: list[Piece]) -> None:
        for step in steps:
            step(scope, out)

    return run


def _mentions(tree, name: str) -> bool:
    return tree == ("name", name) or isinstance(tree, (tuple, list)) and any(_mentions(part, name) for part in tree)


@dataclass
class Template:
    """A compiled template: what stands before the messages, the form of one message, what stands after them."""

    head: Callable
    message: Callable
    tail: Callable
    variable: str
    #: Each message is written by itself, whatever stands around it.
    alone: bool

    def pieces(self, messages: Iterable[Mapping], **names) -> Iterator[list[Piece]]:
        """The pieces of the head, of each message and of the tail, as the messages come."""
        out: list[Piece] = []
        self.head(names, out)
        yield out
        for i, message in enumerate(messages):
            yield self.one(message, {**names, "loop": {"first": i == 0, "index0": i}})
        out = []
        self.tail(names, out)
        yield out

    def one(self, message: Mapping, names: Mapping) -> list[Piece]:
        out: list[Piece] = []
        self.message({**names, self.variable: message}, out)
        return out


def compile_template(source: str) -> Template:
    """Compiles a template with one loop over the messages."""
    tree = parse(source)
    loops = [i for i, node in enumerate(tree) if node[0] == "for"]
    if len(loops) != 1:
        raise TemplateError("the template needs one loop over messages")
    at = loops[0]
    alone = len(tree) == 1 and not _mentions(tree[at][2], "loop")
    return Template(_writer(tree[:at], False), _writer(tree[at][2], False), _writer(tree[at + 1 :], False), tree[at][1], alone)


def joined(pieces: Iterable[Piece]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some pieces and the stretches of it that are learned, in code points."""
    out, stretches, at = [], [], 0
    for text, learned in pieces:
        if learned:
            stretches.append((at, at + len(text)))
        out.append(text)
        at += len(text)
    return "".join(out), stretches
