"""Operator 3: chat formatting by a small sandboxed template language.

A template is parsed to a syntax tree, constants are folded, and every node
becomes a Python closure; rendering calls closures only and can reach nothing
but the fields of the conversation.  The language::

    {{ expr }}                                     print
    {% for m in messages %} ... {% endfor %}       loop; loop.index, loop.first, loop.last
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}       text under the loss mask
    {% control "text" %}                           print a control string and register it

    expr: "text", numbers, true, false, m.role, m.text, loop.index,
          == != and or not ~ ( ), and the filters |escape |trim |upper |lower

``escape`` puts a backslash before every backslash and control string, so
no text can end a turn or open another one, and ``unescape`` undoes it.  This is
unambiguous because no control string contains a backslash or, after its
first character, the first character of any control string; the compiler
refuses others.

Rendering is a generator over an iterator of messages: a conversation of any
length passes through in bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

#: Turns are marked <turn>role<text>text</turn>; the loss covers what the assistant says.
DEFAULT_TEMPLATE = (
    '{% for m in messages %}{% control "<turn>" %}{{ m.role | escape }}{% control "<text>" %}'
    '{% if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}'
    '{% else %}{{ m.text | escape }}{% endif %}{% control "</turn>" %}{{ "\\n" }}{% endfor %}')
FIELDS = ("role", "text")
LOOP_FIELDS = ("index", "first", "last")
#: Characters of formatted text that an output row holds before the next turn opens a new one.
PART_CHARS = 1_000_000


class TemplateError(ValueError):
    pass


# ------------------------------------------------------------------ syntax tree

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Look:
    name: str
    field: str


@dataclass(frozen=True)
class Call:
    """An operator or filter on expressions."""
    op: str
    args: tuple


@dataclass(frozen=True)
class Print:
    expr: object


@dataclass(frozen=True)
class Control:
    text: str


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r'\s*(?:("(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\')|(\d+)|([A-Za-z_]\w*)|(==|!=|[.()|~]))')
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _string(quoted: str) -> str:
    return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1], flags=re.S)


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, text: str, names: dict[str, tuple]):
        self.names, self.tokens, at = names, [], 0
        text = text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"unexpected {text[at:at + 10]!r} in {text!r}")
            self.tokens.append((m.lastindex, m[m.lastindex]))
            at = m.end()
        self.at, self.text = 0, text

    def parse(self):
        found = self._or()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.text!r}")
        return found

    def _take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in (3, 4) and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _chain(self, below: Callable, *operators: str):
        found = below()
        while op := self._take(*operators):
            found = Call(op, (found, below()))
        return found

    def _or(self):
        return self._chain(self._and, "or")

    def _and(self):
        return self._chain(self._not, "and")

    def _not(self):
        return Call("not", (self._not(),)) if self._take("not") else self._chain(self._join, "==", "!=")

    def _join(self):
        return self._chain(self._filtered, "~")

    def _filtered(self):
        found = self._value()
        while self._take("|"):
            name = self._take(*FILTERS)
            if not name:
                raise TemplateError(f"unknown filter in {self.text!r}")
            found = Call(name, (found,))
        return found

    def _value(self):
        if self.at == len(self.tokens):
            raise TemplateError(f"expression ends early: {self.text!r}")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return Const(_string(token))
        if kind == 2:
            return Const(int(token))
        if token == "(":
            found = self._or()
            if not self._take(")"):
                raise TemplateError(f"missing ) in {self.text!r}")
            return found
        if token in ("true", "false"):
            return Const(token == "true")
        if kind == 3 and token in self.names and self._take("."):
            name = self.tokens[self.at][1] if self.at < len(self.tokens) else ""
            self.at += 1
            if name in self.names[token]:
                return Look(token, name)
        raise TemplateError(f"{token!r} is not known in {self.text!r}")


FILTERS = ("escape", "trim", "upper", "lower")


def parse(template: str) -> tuple:
    """The syntax tree of a template: a tuple of nodes."""
    pieces, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            pieces.append(("literal", template[at:m.start()]))
        pieces.append(("print", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(template):
        pieces.append(("literal", template[at:]))
    pieces.reverse()

    def block(names: dict, ends: tuple[str, ...]) -> tuple[tuple, str]:
        nodes = []
        while pieces:
            kind, text = pieces.pop()
            if kind == "literal":
                nodes.append(Print(Const(text)))
                continue
            if kind == "print":
                nodes.append(Print(_Expression(text, names).parse()))
                continue
            word, _, rest = text.partition(" ")
            if word in ends:
                return tuple(nodes), text
            if word == "control":
                value = _Expression(rest, {}).parse()
                if not isinstance(value, Const) or not isinstance(value.value, str) or not value.value:
                    raise TemplateError(f"control takes a text: {text!r}")
                nodes.append(Control(value.value))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
                if not m or names:
                    raise TemplateError(f"only one loop over messages is possible: {text!r}")
                nodes.append(For(m[1], block({m[1]: FIELDS, "loop": LOOP_FIELDS}, ("endfor",))[0]))
            elif word == "generation":
                nodes.append(Generation(block(names, ("endgeneration",))[0]))
            elif word == "if":
                branches, condition = [], rest
                while True:
                    body, end = block(names, ("elif", "else", "endif"))
                    branches.append((_Expression(condition, names).parse(), body))
                    word, _, condition = end.partition(" ")
                    if word != "elif":
                        break
                if word == "else":
                    branches.append((Const(True), block(names, ("endif",))[0]))
                nodes.append(If(tuple(branches)))
            else:
                raise TemplateError(f"unknown tag {text!r}")
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(nodes), ""

    return block({}, ())[0]


def controls_of(nodes: tuple) -> list[str]:
    found = []
    for node in nodes:
        if isinstance(node, Control):
            found.append(node.text)
        for body in ([b for _, b in node.branches] if isinstance(node, If) else [getattr(node, "body", ())]):
            found.extend(controls_of(body))
    return list(dict.fromkeys(found))


def fold(nodes: tuple, controls: list[str]) -> tuple:
    """Constant expressions are worked out, dead branches dropped, texts joined."""
    apply = _operators(controls)

    def expression(node):
        if not isinstance(node, Call):
            return node
        args = tuple(expression(a) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            return Const(apply[node.op](*[a.value for a in args]))
        return Call(node.op, args)

    out: list = []

    def put(node) -> None:
        if isinstance(node, Print) and isinstance(node.expr, Const):
            text = _text(node.expr.value)
            if out and isinstance(out[-1], Print) and isinstance(out[-1].expr, Const):
                text = out.pop().expr.value + text
            if not text:
                return
            node = Print(Const(text))
        out.append(node)

    for node in nodes:
        if isinstance(node, Control):
            node = Print(Const(node.text))
        if isinstance(node, Print):
            node = Print(expression(node.expr))
        elif isinstance(node, If):
            branches = []
            for condition, body in node.branches:
                condition = expression(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(body, controls)))
                if isinstance(condition, Const):
                    break
            if not branches:
                continue
            if isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    put(inner)
                continue
            node = If(tuple(branches))
        elif isinstance(node, For):
            node = For(node.name, fold(node.body, controls))
        elif isinstance(node, Generation):
            node = Generation(fold(node.body, controls))
        put(node)
    return tuple(out)


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _operators(controls: list[str]) -> dict[str, Callable]:
    escape = escaper(controls)
    return {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "~": lambda a, b: _text(a) + _text(b),
            "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a,
            "escape": lambda a: escape(_text(a)), "trim": lambda a: _text(a).strip(),
            "upper": lambda a: _text(a).upper(), "lower": lambda a: _text(a).lower()}


def escaper(controls: list[str]) -> Callable[[str], str]:
    firsts = {c[0] for c in controls}
    if any("\\" in c or set(c[1:]) & firsts for c in controls):
        raise TemplateError(f"control strings that could overlap: {controls}")
    special = re.compile("|".join(map(re.escape, ["\\", *sorted(controls, key=len, reverse=True)])))
    return lambda text: special.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


# ------------------------------------------------------------------ closures

@dataclass
class Template:
    """``render(messages)`` yields (text, under the loss mask) in order, and (None, False) after each message."""
    tree: tuple
    controls: list[str]
    render: Callable[[Iterator[dict]], Iterator[tuple[str | None, bool]]] = field(repr=False, default=None)


@lru_cache(maxsize=32)
def compile_template(template: str) -> Template:
    tree = parse(template)
    controls = controls_of(tree)
    folded = fold(tree, controls)
    apply = _operators(controls)

    def expression(node) -> Callable[[dict], object]:
        if isinstance(node, Const):
            return lambda env, value=node.value: value
        if isinstance(node, Look):
            return lambda env, name=node.name, key=node.field: env[name][key]
        args = [expression(a) for a in node.args]
        run = apply[node.op]
        if len(args) == 1:
            return lambda env, a=args[0]: run(a(env))
        if node.op == "and":
            return lambda env, a=args[0], b=args[1]: a(env) and b(env)
        if node.op == "or":
            return lambda env, a=args[0], b=args[1]: a(env) or b(env)
        return lambda env, a=args[0], b=args[1]: run(a(env), b(env))

    def body(nodes: tuple, masked: bool) -> Callable[[dict], Iterator]:
        steps = [statement(n, masked) for n in nodes]

        def run(env):
            for step in steps:
                yield from step(env)
        return run

    def statement(node, masked: bool) -> Callable[[dict], Iterator]:
        if isinstance(node, Print):
            if isinstance(node.expr, Const):
                return lambda env, out=((node.expr.value, masked),): out
            value = expression(node.expr)
            return lambda env: ((_text(value(env)), masked),)
        if isinstance(node, Generation):
            return body(node.body, True)
        if isinstance(node, If):
            branches = [(expression(c), body(b, masked)) for c, b in node.branches]

            def choose(env):
                for condition, then in branches:
                    if condition(env):
                        return then(env)
                return ()
            return choose
        inner, name = body(node.body, masked), node.name

        def loop(env):
            messages = iter(env["messages"])
            current = next(messages, None)
            index = 0
            while current is not None:
                following = next(messages, None)
                index += 1
                yield from inner({name: current,
                                  "loop": {"index": index, "first": index == 1, "last": following is None}})
                yield None, False
                current = following
        return loop

    run = body(folded, False)
    return Template(folded, controls, lambda messages: run({"messages": messages}))


# ------------------------------------------------------------------ Spark

PARTS = "conv_id long, part long, start long, text string, loss array<struct<start:long,end:long>>"


def _by_conversation(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    """(conv_id, iterator of rows) per run of equal ids; each iterator is read up before the next begins."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in names))
    from itertools import groupby
    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, group


def _format_with(template: str, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template).render
        for conv_id, rows in _by_conversation(batches, ("conv_id", "role", "text")):
            held, spans, at, start, part = [], [], 0, 0, 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_pydict(
                    {"conv_id": pa.array([conv_id], pa.int64()), "part": [part], "start": [start],
                     "text": ["".join(held)],
                     "loss": pa.array([spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

            for text, masked in render({"role": r[1], "text": r[2]} for r in rows):
                if text is None:
                    if at - start >= part_chars:
                        yield out()
                        held, spans, start, part = [], [], at, part + 1
                elif text:
                    held.append(text)
                    if masked:
                        spans.append({"start": at, "end": at + len(text)})
                    at += len(text)
            if held or not part:
                yield out()
    return run


def format_conversations(rows: DataFrame, template: str = DEFAULT_TEMPLATE,
                         part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted text of each conversation: conv_id, part, start, text, loss.

    ``rows`` has conv_id, turn, role, text.  Turns go in ascending order, null
    first, ties by role and text; null roles and texts are empty; rows without
    a conv_id form one conversation.  A conversation longer than
    ``part_chars`` goes on in further parts, cut between turns; start and the
    loss spans count code points of the whole.  Other columns are not read.
    An empty table gives no row.  Rows of a conversation meet in one task, where
    they stream through; none is held longer than its turn.
    """
    ship_package(rows.sparkSession)
    compile_template(template)
    narrow = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                         F.coalesce(F.col("role"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return (narrow.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_format_with(template, part_chars), PARTS))


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read back from text formatted by the default template."""
    token = re.compile(r"\\.|<turn>|<text>|</turn>", re.S)
    opened = middle = None
    for m in token.finditer(text):
        if m[0] == "<turn>":
            opened = m.end()
        elif m[0] == "<text>":
            middle = m.span()
        elif m[0] == "</turn>":
            yield unescape(text[opened:middle[0]]), unescape(text[middle[1]:m.start()])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for conv_id, parts in _by_conversation(batches, ("conv_id", "start", "text", "loss")):
        n_turns = loss_chars = chars = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()
        for _, start, text, spans in parts:
            chars += len(text)
            for role, said in turns_of(text):
                n_turns += 1
                turns.update(f"{role}\n{said}\n".encode())
            for span in spans:
                under = unescape(text[span["start"] - start:span["end"] - start])
                loss_chars += len(under)
                loss.update(under.encode())
        out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(out) == 5000:
            yield _digest_batch(out)
            out = []
    if out:
        yield _digest_batch(out)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations hold: turns, and text under the loss mask.

    Parts of a conversation must lie together in order, as they come out of
    ``format_conversations``; parts read from storage need
    ``repartition("conv_id").sortWithinPartitions("conv_id", "part")`` first.
    Null and empty texts were written as empty turns and count as such, repeated
    rows as turns of their own; rows without a conversation id are one
    conversation.  Other columns are not read.  An empty table gives none.
    """
    return formatted.mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                  "formatted_chars long")
