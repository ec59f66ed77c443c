"""Rule sets of any size as one compiled program: thousands of rules, or atoms of a hundred thousand apps.

A rule set is turned into layers of equal operations over numbered values. A task counts words with one
automaton (kept for the tasks of its process), looks apps up in one table, fills a matrix of values by rows, and
evaluates each layer by a few array operations; a matrix holds a bounded number of cells, whatever the
number of rules. The plan is one step, so it does not grow with the rules. Slots and tags come out sparse:
arrays of (place, score) of what is not 0, in order of place.

Results equal those of ``rules.with_slots`` and ``rules.tag_values``: null lines and records count as none,
a row without any has the scores of an empty one (so a negated rule may hold). The frame's other columns
pass through; their names may be any but ``out``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.records import app_records, rule_lines
from tallymark.operators.rules import Node, Range, RuleSet, Slot, compile_rules
from tallymark.session import ship_package

#: Values of a matrix at most, one row at least.
CELLS = 1 << 20
#: Nodes of a layer that are evaluated at once, so that their inputs stay in a core's cache.
NODES = 256
SCORES = "array<struct<place:int,score:int>>"
_SCORES = pa.list_(pa.struct([("place", pa.int32()), ("score", pa.int32())]))
KINDS = ("apps_days", "apps_freq", "apps_list")

_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def _reduced(operation: np.ufunc, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Runs of rows reduced to one each; pairs, the most frequent case, by one operation."""
    if len(x) == 2 * len(starts) and (starts[1:] - starts[:-1] == 2).all():
        return operation(x[::2], x[1::2])
    return operation.reduceat(x, starts, axis=0)


class Layers:
    """Expressions over numbered values, in layers of one kind whose inputs are ready."""

    def __init__(self, leaves: int):
        self.size = leaves
        self.depth = [0] * leaves
        self.nodes: dict[tuple[int, str], list[tuple[int, tuple, int, int]]] = {}
        self.known: dict[object, int] = {}
        self.layers: list[tuple] = []

    def add(self, root: object, leaf) -> int:
        """The number of an expression's value; no recursion, as chains may be long."""
        stack, done = [(root, False)], []
        while stack:
            node, ready = stack.pop()
            if not isinstance(node, (Node, Range)):
                done.append(leaf(node))
            elif not ready:
                stack.append((node, True))
                stack += [(x, False) for x in reversed(self._parts(node))]
            else:
                n = len(self._parts(node))
                inputs, done = tuple(done[-n:]), done[:-n]
                done.append(self._number(node, inputs))
        return done[0]

    @staticmethod
    def _parts(node: Node | Range) -> list:
        """A node's inputs; a chain of one kind from the left is one node."""
        if isinstance(node, Range):
            return [node.part]
        rest = []
        while node.kind != "not" and isinstance(node.parts[0], Node) and node.parts[0].kind == node.kind:
            rest += reversed(node.parts[1:])
            node = node.parts[0]
        return [*node.parts, *reversed(rest)]

    def _number(self, node: Node | Range, inputs: tuple) -> int:
        kind, low, high = ("range", node.low, node.high) if isinstance(node, Range) else (node.kind, 0, 0)
        key = (kind, inputs, low, high)
        if key not in self.known:
            depth = 1 + max(self.depth[k] for k in inputs)
            self.known[key] = self.size
            self.nodes.setdefault((depth, kind), []).append((self.size, inputs, low, high))
            self.depth.append(depth)
            self.size += 1
        return self.known[key]

    def close(self) -> None:
        """Arrays for each layer: kind, outputs, inputs, where each one's inputs begin, bounds."""
        parts = [(kind, nodes[at : at + NODES]) for (_, kind), nodes in sorted(self.nodes.items()) for at in range(0, len(nodes), NODES)]
        for kind, nodes in parts:
            outs, inputs, low, high = zip(*nodes, strict=True)
            starts = np.cumsum([0, *[len(x) for x in inputs]])[:-1]
            self.layers.append((kind, np.array(outs), np.array([k for x in inputs for k in x]), starts, np.array(low)[:, None], np.array(high)[:, None]))
        del self.nodes, self.known, self.depth

    def evaluate(self, values: np.ndarray) -> None:
        """Fill the rows of a matrix (values by frame rows) whose leaves are filled."""
        for kind, outs, inputs, starts, low, high in self.layers:
            x = values[inputs]
            if kind == "sum":
                values[outs] = _reduced(np.add, x, starts)
            elif kind == "least":
                values[outs] = _reduced(np.minimum, x, starts)
            elif kind == "not":
                values[outs] = x <= 0
            elif kind == "range":
                values[outs] = np.where((x >= low) & (x <= high), x, 0)
            else:  # minus: the first one if all others are 0
                first = x[starts]
                x[starts] = 0
                values[outs] = np.where(np.maximum.reduceat(x, starts, axis=0) <= 0, first, 0)


class RuleProgram:
    """A rule set's two phases: slots from counters, tags from slots."""

    def __init__(self, rules: RuleSet):
        self.key = hashlib.sha256(repr(rules.rules).encode()).hexdigest()
        counters = {c: k for k, c in enumerate(rules.counters())}
        self.words: dict[str, list[tuple[int, frozenset | None, bool]]] = {}
        self.apps: dict[str, list[tuple[int, int]]] = {}  # app -> (kind, counter)
        for c, k in counters.items():
            if c.kind != "data_word":
                self.apps.setdefault(c.word, []).append((KINDS.index(c.kind), k))
            elif c.query in ("0", "1"):
                self.words.setdefault(c.word, []).append((k, c.apps, c.query == "1"))
        self.row, self.user = Layers(len(counters)), Layers(len(rules.slots))
        self.slots = np.array([self.row.add(s.expr, counters.__getitem__) for s in rules.slots], np.int64)
        self.tags = np.array([self.user.add(t, self._slot) for t in rules.tags], np.int64)
        self.row.close()
        self.user.close()

    @staticmethod
    def _slot(leaf: Slot) -> int:
        return leaf.number

    def automaton(self) -> ahocorasick.Automaton | None:
        """The process's automaton for these rules."""
        if self.words and self.key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[self.key] = made = ahocorasick.Automaton()
            for word, uses in self.words.items():
                made.add_word(word, uses)
            made.make_automaton()
        return _AUTOMATA.get(self.key)

    def count(self, values: np.ndarray, row: int, lines: list[tuple[str, str, bool]], records: list[tuple[str, int | None]]) -> None:
        """Fill the counters of one row: lines are (app, corpus, is_query), records (app, freq)."""
        column, automaton = values[:, row], self.automaton()
        if automaton is not None:
            for app, corpus, is_query in lines:
                for _, uses in automaton.iter(corpus):
                    for k, apps, query in uses:
                        if (apps is None or app in apps) and (is_query or not query):
                            column[k] += 1
        if not self.apps:
            return
        found: dict[str, list[int]] = {}  # app -> lines, records, days, uses
        for app, *_ in lines:
            if app in self.apps:
                found.setdefault(app, [0, 0, 0, 0])[0] += 1
        for app, freq in records:
            if app in self.apps:
                seen = found.setdefault(app, [0, 0, 0, 0])
                seen[1] += 1
                seen[2] += (freq or 0) > 0
                seen[3] += max(freq or 0, 0)
        for app, (hits, held, days, uses) in found.items():
            scores = (min(hits, 1) + days, hits + uses, min(hits + held, 1))
            for kind, k in self.apps[app]:
                column[k] = scores[kind]

    def slot_rows(self, lines: list[list], records: list[list]) -> Iterator[np.ndarray]:
        """Slots by rows, in matrices of bounded size."""
        step = max(1, CELLS // max(1, self.row.size))
        for at in range(0, len(lines), step):
            n = min(step, len(lines) - at)
            values = np.zeros((self.row.size, n), np.int64)
            for row in range(n):
                self.count(values, row, lines[at + row], records[at + row])
            self.row.evaluate(values)
            yield values[self.slots]

    def tag_rows(self, slots: np.ndarray) -> np.ndarray:
        """Tags by rows from slots by rows."""
        out = np.zeros((len(self.tags), slots.shape[1]), np.int64)
        step = max(1, CELLS // max(1, self.user.size))
        for at in range(0, slots.shape[1], step):
            part = slots[:, at : at + step]
            values = np.zeros((self.user.size, part.shape[1]), np.int64)
            values[: len(part)] = part
            self.user.evaluate(values)
            out[:, at : at + step] = values[self.tags]
        return out


def _sparse(scores: np.ndarray) -> pa.Array:
    """Scores by rows as lists of (place, score) of what is not 0."""
    row, place = np.nonzero(scores.T)
    ends = np.cumsum(np.r_[0, np.bincount(row, minlength=scores.shape[1])])
    items = pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(scores[place, row].astype(np.int32))], ["place", "score"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)


def _lists(column: pa.ListArray, names: list[str]) -> list[list[tuple]]:
    """A column of lists of structs as Python tuples, field by field."""
    items, ends = column.flatten(), np.cumsum(np.r_[0, column.value_lengths().fill_null(0).to_numpy()])
    rows = list(zip(*[items.field(x).to_pylist() for x in names], strict=True))
    return [rows[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _with(batch: pa.RecordBatch, at: int, n: int, column: pa.Array, keep: int, out: str) -> pa.RecordBatch:
    part = batch.slice(at, n)
    return pa.RecordBatch.from_arrays([*part.columns[:keep], column], names=[*part.schema.names[:keep], out])


def _scan(program: RuleProgram, keep: int, out: str, tags: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, records = _lists(batch.column(keep), ["app", "corpus", "is_query"]), _lists(batch.column(keep + 1), ["app", "freq"])
            at = 0
            for slots in program.slot_rows(lines, records):
                yield _with(batch, at, slots.shape[1], _sparse(program.tag_rows(slots) if tags else slots), keep, out)
                at += slots.shape[1]

    return run


def _applied(frame: DataFrame, rules: list[str], data: str | None, apps: str | None, layout: str, out: str, tags: bool) -> DataFrame:
    ship_package(frame.sparkSession)
    program, own = RuleProgram(compile_rules(rules)), f"_{uuid.uuid4().hex}"
    lines = F.array().cast("array<string>") if data is None else F.col(data)
    records = F.array().cast("array<string>") if apps is None else F.col(apps)
    parsed = frame.select("*", rule_lines(lines).alias(f"{own}_lines"), F.transform(app_records(records, layout), lambda x: F.struct(x["app"].alias("app"), x["freq"].alias("freq"))).alias(f"{own}_records"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    return parsed.mapInArrow(_scan(program, len(frame.columns), out, tags), f"{kept}, `{out}` {SCORES}")


def with_program_tags(frame: DataFrame, rules: list[str], data: str | None = "data", apps: str | None = None, layout: str = "rule", out: str = "tags") -> DataFrame:
    """The frame with each row's tags: (place of the rule, score) of what is not 0."""
    return _applied(frame, rules, data, apps, layout, out, tags=True)


def with_program_slots(frame: DataFrame, rules: list[str], data: str | None = "data", apps: str | None = None, layout: str = "rule", out: str = "slots") -> DataFrame:
    """Phase one: the frame with each row's slots, (place, score) of what is not 0."""
    return _applied(frame, rules, data, apps, layout, out, tags=False)


def _users(program: RuleProgram, places: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // max(1, program.user.size))
        for batch in batches:
            found = _lists(batch.column(1), ["place", "score"])
            for at in range(0, len(found), step):
                part = found[at : at + step]
                slots = np.zeros((places, len(part)), np.int64)
                for row, held in enumerate(part):
                    for place, score in held:
                        slots[place, row] = score
                yield _with(batch, at, len(part), _sparse(program.tag_rows(slots)), 2, "tags")

    return run


def program_user_tags(slots: DataFrame, rules: list[str], user: str = "userid", column: str = "slots") -> DataFrame:
    """Phase two: (user, slots, tags) from rows of phase one, summed by user and slot before and after one shuffle.

    A user holds each slot once at most, so a user's list is bounded by the rules. A user whose slots are
    all 0 has no slots to sum and is left out, as are users without tags.
    """
    ship_package(slots.sparkSession)
    compiled = compile_rules(rules)
    program = RuleProgram(compiled)
    each = slots.select(F.col(user).alias(user), F.inline(column)).groupBy(user, "place").agg(F.sum("score").cast("int").alias("score"))
    summed = each.where("score <> 0").groupBy(user).agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("slots"))
    kind = slots.schema[user].dataType.simpleString()
    return summed.mapInArrow(_users(program, len(compiled.slots)), f"`{user}` {kind}, slots {SCORES}, tags {SCORES}").where(F.size("tags") > 0)
