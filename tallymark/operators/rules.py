"""The keyword and app rule language, compiled to Spark columns.

    rule  := term (('&' | '|') term)*            equal precedence, from the left
    term  := '!'* ( atom | '(' rule ')' range? )
    range := '\\r' low ('-' high)? '\\f'
    atom  := 'data_word=' apps ':' query ':' words | 'apps_days=' words | 'apps_freq=' words | 'apps_list=' words
    words := item (',' item)*
    item  := part (('+' | '-') part)*            equal precedence, from the left
    part  := word | '{' words '}' ('[' low? ('-' high)? ']')?

A backslash takes the next character literally. Scores are whole numbers: ``&`` and ``+`` are the
smallest, ``|`` and ``,`` the sum, ``!x`` is 1 if x is 0, ``a-b`` is a if b is 0, and a range keeps a
score that lies in it. ``[3]`` has no upper end, ``[-4]`` begins at 0.

Evaluation has two phases. Slots are counted per row and may be summed over a user's rows; tags are
computed from slots. A plain word has a slot. A combination in a ``data_word`` list has one slot, which
is computed within each row; its outermost range is applied to the slot, after any summing. Each name
of an ``apps_*`` atom has a slot, and combinations of them are computed from slots.

Empty apps mean all; blanks between terms are ignored; what cannot be parsed raises RuleSyntaxError.
A range after a word without braces is part of the word.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.records import app_records, rule_lines
from tallymark.session import ship_active

#: From so many words on, one pass of an automaton over Arrow batches beats one expression for each: at sf0.1 2.6 and 1.7 s for three words, 1.9 and 1.7 s for two.
ARROW_COUNTERS = 3
#: Counts after which a batch of rows is handed on.
RUN_COUNTS = 1 << 20
NO_END = 2**31 - 1


class RuleSyntaxError(ValueError):
    """A rule that cannot be parsed."""


@dataclass(frozen=True)
class Word:
    text: str


@dataclass(frozen=True)
class Slot:
    number: int


@dataclass(frozen=True)
class Node:
    """An operation: sum, least, minus, not."""

    kind: str
    parts: tuple


@dataclass(frozen=True)
class Range:
    part: object
    low: int
    high: int


@dataclass(frozen=True)
class Counter:
    """What is counted in a row's lines or records."""

    kind: str  # data_word, apps_days, apps_freq, apps_list
    word: str
    apps: frozenset | None = None  # None: all
    query: str = "0"


@dataclass
class SlotSpec:
    """A slot's value in a row: an expression over counters."""

    expr: object  # Counter, or Node over them


@dataclass
class RuleSet:
    rules: list[str]
    slots: list[SlotSpec] = field(default_factory=list)
    tags: list[object] = field(default_factory=list)

    def counters(self) -> list[Counter]:
        """Each distinct counter once, in order."""
        return list(dict.fromkeys(c for s in self.slots for c in leaves(s.expr)))


def leaves(node: object) -> Iterator:
    if isinstance(node, Node):
        for part in node.parts:
            yield from leaves(part)
    elif isinstance(node, Range):
        yield from leaves(node.part)
    else:
        yield node


class _Chars:
    """A cursor over (character, escaped) pairs."""

    def __init__(self, text: str):
        self.items, escaped = [], False
        for c in text:
            if escaped or c != "\\":
                self.items.append((c, escaped))
                escaped = False
            else:
                escaped = True
        if escaped:
            self.items.append(("\\", True))
        self.at = 0

    def peek(self) -> str | None:
        """The next character if it is not escaped, else an empty string; None at the end."""
        if self.at >= len(self.items):
            return None
        c, escaped = self.items[self.at]
        return "" if escaped else c

    def take(self) -> str:
        self.at += 1
        return self.items[self.at - 1][0]


def _bounds(text: str) -> tuple[int, int]:
    low, dash, high = text.partition("-")
    try:
        return int(low or 0), int(high) if dash and high else NO_END
    except ValueError:
        raise RuleSyntaxError(f"no range: {text!r}") from None


def _until(chars: _Chars, end: str) -> str:
    out = ""
    while chars.peek() != end:
        if chars.peek() is None:
            raise RuleSyntaxError(f"missing {end!r}")
        out += chars.take()
    chars.take()
    return out


def _node(kind: str, parts: list) -> object:
    return parts[0] if len(parts) == 1 else Node(kind, tuple(parts))


def _words(chars: _Chars, nested: bool) -> list:
    """The items of a list."""
    items = [_item(chars)]
    while chars.peek() == ",":
        chars.take()
        items.append(_item(chars))
    if chars.peek() == "}" and not nested:
        raise RuleSyntaxError("'}' without '{'")
    return items


def _item(chars: _Chars) -> object:
    left = _part(chars)
    while chars.peek() in ("+", "-"):
        kind = "least" if chars.take() == "+" else "minus"
        left = Node(kind, (left, _part(chars)))
    return left


def _part(chars: _Chars) -> object:
    if chars.peek() == "{":
        chars.take()
        inner = Node("sum", tuple(_words(chars, True)))
        if chars.peek() != "}":
            raise RuleSyntaxError("'{' without '}'")
        chars.take()
        if chars.peek() == "[":
            chars.take()
            return Range(inner, *_bounds(_until(chars, "]")))
        return inner
    word = ""
    while chars.peek() not in (None, ",", "+", "-", "{", "}"):
        word += chars.take()
    if not word:
        raise RuleSyntaxError("a word is missing")
    return Word(word)


def _mapped(node: object, leaf: Callable) -> object:
    if isinstance(node, Word):
        return leaf(node.text)
    if isinstance(node, Range):
        return Range(_mapped(node.part, leaf), node.low, node.high)
    return Node(node.kind, tuple(_mapped(x, leaf) for x in node.parts))


class _Compiler:
    """Parses rules and gives out slots, from left to right."""

    def __init__(self) -> None:
        self.slots: list[SlotSpec] = []

    def slot(self, expr: object) -> Slot:
        self.slots.append(SlotSpec(expr))
        return Slot(len(self.slots) - 1)

    def rule(self, chars: _Chars) -> object:
        left = self.term(chars)
        while (c := self.skip(chars)) in ("&", "|"):
            chars.take()
            left = Node("least" if c == "&" else "sum", (left, self.term(chars)))
        return left

    @staticmethod
    def skip(chars: _Chars) -> str | None:
        while chars.peek() == " ":
            chars.take()
        return chars.peek()

    def term(self, chars: _Chars) -> object:
        c = self.skip(chars)
        if c == "!":
            chars.take()
            return Node("not", (self.term(chars),))
        if c == "(":
            chars.take()
            inner = self.rule(chars)
            if self.skip(chars) != ")":
                raise RuleSyntaxError("'(' without ')'")
            chars.take()
            if chars.peek() == "\r":
                chars.take()
                return Range(inner, *_bounds(_until(chars, "\f")))
            return inner
        start = chars.at
        while chars.peek() not in (None, "&", "|", "(", ")"):
            chars.take()
        return self.atom(chars.items[start : chars.at])

    def atom(self, items: list[tuple[str, bool]]) -> object:
        text = "".join(c for c, _ in items)
        kind, equals, _ = text.partition("=")
        kind = kind.strip()
        if not equals or kind not in ("data_word", "apps_days", "apps_freq", "apps_list"):
            raise RuleSyntaxError(f"no atom: {text!r}")
        while items and items[-1] == (" ", False):
            items = items[:-1]
        chars = _Chars("")
        chars.items = items[text.index("=") + 1 :]
        if kind != "data_word":
            parsed = _words(chars, False)
            self.ended(chars, text)
            return _node("sum", [_mapped(x, lambda w: self.slot(Counter(kind, w))) for x in parsed])
        apps, query = _until(chars, ":"), _until(chars, ":").strip()
        among = None if apps.strip() in ("", "all") else frozenset(a.strip() for a in apps.split(","))
        parsed = _words(chars, False)
        self.ended(chars, text)
        counter = lambda w: Counter("data_word", w, among, query)
        out = []
        for x in parsed:
            if isinstance(x, Range):
                out.append(Range(self.slot(_mapped(x.part, counter)), x.low, x.high))
            else:
                out.append(self.slot(_mapped(x, counter)))
        return _node("sum", out)

    @staticmethod
    def ended(chars: _Chars, text: str) -> None:
        if chars.peek() is not None:
            raise RuleSyntaxError(f"unexpected {chars.take()!r} in {text!r}")


def compile_rules(rules: list[str]) -> RuleSet:
    """Parse rules; slots are numbered rule by rule, from left to right."""
    compiler, tags = _Compiler(), []
    for text in rules:
        chars = _Chars(text)
        tags.append(compiler.rule(chars))
        if compiler.skip(chars) is not None:
            raise RuleSyntaxError(f"unexpected {chars.take()!r} in {text!r}")
    return RuleSet(list(rules), compiler.slots, tags)


def evaluate(node: object, leaf: Callable[[object], int]) -> int:
    """An expression's value in plain Python."""
    if isinstance(node, Range):
        x = evaluate(node.part, leaf)
        return x if node.low <= x <= node.high else 0
    if not isinstance(node, Node):
        return leaf(node)
    parts = [evaluate(x, leaf) for x in node.parts]
    if node.kind == "not":
        return int(parts[0] <= 0)
    if node.kind == "minus":
        return parts[0] if all(x <= 0 for x in parts[1:]) else 0
    return min(parts) if node.kind == "least" else sum(parts)


def to_column(node: object, leaf: Callable[[object], Column]) -> Column:
    """An expression as a column; leaves must not be null."""
    if isinstance(node, Range):
        x = to_column(node.part, leaf)
        return F.when(x.between(node.low, node.high), x).otherwise(F.lit(0))
    if not isinstance(node, Node):
        return leaf(node)
    parts = [to_column(x, leaf) for x in node.parts]
    if node.kind == "not":
        return F.when(parts[0] > 0, F.lit(0)).otherwise(F.lit(1))
    if node.kind == "minus":
        clear = parts[1] <= 0
        for x in parts[2:]:
            clear = clear & (x <= 0)
        return F.when(clear, parts[0]).otherwise(F.lit(0))
    if node.kind == "least":
        return F.least(*parts) if len(parts) > 1 else parts[0]
    total = parts[0]
    for x in parts[1:]:
        total = total + x
    return total


def _pattern(word: str) -> str:
    """A look-ahead for a literal word, so that overlapping occurrences count."""
    return "(?=" + "".join(f"\\{c}" if not c.isalnum() and ord(c) < 128 else c for c in word) + ")"


def overlaps_itself(word: str) -> bool:
    """True if two occurrences of a word can share characters."""
    return any(word.endswith(word[:k]) for k in range(1, len(word)))


def _occurrences(text: Column, word: str) -> Column:
    """How often a word occurs; a plain replacement counts, unless occurrences can overlap."""
    if overlaps_itself(word):
        return F.regexp_count(text, F.lit(_pattern(word)))
    rest = F.length(F.replace(text, F.lit(word), F.lit("")))
    return ((F.length(text) - rest) / F.lit(len(word))).cast("int")


def _native(counter: Counter, lines: Column | None, apps: Column | None) -> Column:
    """One counter as a column over parsed lines and app records."""
    zero, total = F.lit(0), None
    if lines is not None:
        if counter.kind == "data_word":
            if counter.query not in ("0", "1"):
                return zero

            def wanted(x: Column) -> Column:
                ok = F.lit(True) if counter.apps is None else x["app"].isin(sorted(counter.apps))
                return ok & x["is_query"] if counter.query == "1" else ok

            return F.aggregate(F.filter(lines, wanted), zero, lambda acc, x: acc + _occurrences(x["corpus"], counter.word))
        hits = F.size(F.filter(lines, lambda x: x["app"] == counter.word))
        total = hits if counter.kind == "apps_freq" else F.least(hits, F.lit(1))
    if apps is not None and counter.kind != "data_word":
        mine = F.filter(apps, lambda x: x["app"] == counter.word)
        if counter.kind == "apps_freq":
            more = F.aggregate(mine, zero, lambda acc, x: acc + F.greatest(F.coalesce(x["freq"], zero), zero))
        elif counter.kind == "apps_days":
            more = F.size(F.filter(mine, lambda x: x["freq"] > 0))
        else:
            more = F.least(F.size(mine), F.lit(1))
        total = more if total is None else F.greatest(total, more) if counter.kind == "apps_list" else total + more
    return zero if total is None else total


def _matcher(counters: list[Counter]):
    """A UDF over parsed lines that counts all words in one pass of an automaton."""
    words: dict[str, list[tuple[int, frozenset | None, bool]]] = {}
    for k, c in enumerate(counters):
        if c.query in ("0", "1"):
            words.setdefault(c.word, []).append((k, c.apps, c.query == "1"))
    only_queries = all(q for found in words.values() for *_, q in found)

    ship_active()

    @F.arrow_udf("array<int>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, uses in words.items():
            automaton.add_word(word, uses)
        if words:
            automaton.make_automaton()

        def row(lines) -> list[int]:
            out = [0] * len(counters)
            for line in lines if lines is not None and words else ():
                if only_queries and not line["is_query"]:
                    continue
                for _, uses in automaton.iter(line["corpus"]):
                    for k, apps, query in uses:
                        if (apps is None or line["app"] in apps) and (line["is_query"] or not query):
                            out[k] += 1
            return out

        def lists(found: array) -> pa.Array:
            n = len(found) // len(counters)
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(counters), pa.int32()), pa.array(np.frombuffer(found, np.int32)))

        for batch in batches:
            found = array("i")
            for lines in batch:  # a row's lines are Python objects only while they are counted
                found.extend(row(lines.as_py()))
                if len(found) >= RUN_COUNTS:
                    yield lists(found)
                    found = array("i")
            if found:
                yield lists(found)

    return count


def by_automaton(words: list[Counter], matcher: str) -> bool:
    return bool(words) and (matcher == "arrow" or matcher == "auto" and len(words) >= ARROW_COUNTERS)


def _slots(rules: RuleSet, lines: Column | None, records: Column | None, matcher: str, counts: Column | None = None) -> Column:
    """Slots from parsed lines and app records, and from words' counts if these are there already."""
    words = [c for c in rules.counters() if c.kind == "data_word"]
    found: dict[Counter, Column] = {}
    if lines is not None and by_automaton(words, matcher):
        counts = _matcher(words)(lines) if counts is None else counts
        found = {c: counts[k] for k, c in enumerate(words)}
    values = {c: found[c] if c in found else _native(c, lines, records) for c in rules.counters()}
    return F.array(*[to_column(s.expr, values.__getitem__) for s in rules.slots]).cast("array<int>")


def slot_values(rules: RuleSet, data: Column | None = None, apps: Column | None = None, matcher: str = "auto", layout: str = "rule") -> Column:
    """Phase one: each row's slots as array<int>.

    data: array of packed lines; apps: array of packed app records in ``layout``. matcher: ``native``
    (column expressions), ``arrow`` (one automaton for all words), or ``auto`` by their number.
    """
    return _slots(rules, None if data is None else rule_lines(data), None if apps is None else app_records(apps, layout), matcher)


def once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """The frame with a column that is computed once a row: as the output of a generator, it is not copied into filters and projections above it."""
    return frame.select("*", F.explode(F.array(value)).alias(name))


def with_slots(frame: DataFrame, rules: RuleSet, data: str | None = None, apps: str | None = None, out: str = "_slots", matcher: str = "auto", layout: str = "rule") -> DataFrame:
    """The frame with slot_values as a column; lines and records are parsed once for all counters, and all is counted once a row."""
    parsed, values = frame, {}
    if data is not None:
        parsed, values["_lines"] = once(parsed, "_lines", rule_lines(F.col(data))), F.col("_lines")
    if apps is not None:
        parsed, values["_records"] = once(parsed, "_records", app_records(F.col(apps), layout)), F.col("_records")
    words = [c for c in rules.counters() if c.kind == "data_word"]
    if data is not None and by_automaton(words, matcher):
        parsed, values["_counts"] = parsed.withColumn("_counts", _matcher(words)(F.col("_lines"))), F.col("_counts")
    slots = _slots(rules, values.get("_lines"), values.get("_records"), matcher, values.get("_counts"))
    return once(parsed, out, slots).drop(*values)


def tag_values(rules: RuleSet, slots: Column) -> Column:
    """Phase two: tags as array<int> from slots."""
    return F.array(*[to_column(t, lambda s: slots[s.number]) for t in rules.tags]).cast("array<int>")
