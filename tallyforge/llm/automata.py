"""Compiling several regular expressions into one table: subset construction, then minimisation.

The expressions may hold literals, classes, groups, alternatives and the repeats ``? * + {m} {m,} {m,n}``; they match bytes.
"""

from __future__ import annotations

import re._parser as syntax  # the standard module's own reader of expressions; only its tree is used
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np


@dataclass
class _Nfa:
    """States with empty steps and steps on sets of bytes."""

    empty: list[list[int]] = field(default_factory=list)
    steps: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def add(self, tree: syntax.SubPattern, start: int, fold: bool) -> int:
        """Add a parsed expression behind ``start``; returns the state behind it."""
        for op, value in tree:
            name = str(op)
            if name in ("LITERAL", "IN"):
                end = self.state()
                self.steps[start].append((_bytes_of(name, value, fold), end))
                start = end
            elif name == "SUBPATTERN":
                _, on, _, inner = value
                start = self.add(inner, start, fold or bool(on & syntax.SRE_FLAG_IGNORECASE))
            elif name == "BRANCH":
                end = self.state()
                for inner in value[1]:
                    first = self.state()
                    self.empty[start].append(first)
                    self.empty[self.add(inner, first, fold)].append(end)
                start = end
            elif name == "MAX_REPEAT":
                low, high, inner = value
                for _ in range(low):
                    start = self.add(inner, start, fold)
                if high is syntax.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.empty[start].append(loop)
                    self.empty[self.add(inner, loop, fold)].append(loop)
                    self.empty[loop].append(end)
                    start = end
                else:
                    ends = [start]
                    for _ in range(high - low):
                        start = self.add(inner, start, fold)
                        ends.append(start)
                    end = self.state()
                    for at in ends:
                        self.empty[at].append(end)
                    start = end
            else:
                raise ValueError(f"{name} is not supported in a rule")
        return start

    def closure(self, states: set[int]) -> frozenset[int]:
        open_, seen = list(states), set(states)
        while open_:
            for there in self.empty[open_.pop()]:
                if there not in seen:
                    seen.add(there)
                    open_.append(there)
        return frozenset(seen)


def _bytes_of(name: str, value: object, fold: bool) -> frozenset[int]:
    items = [("LITERAL", value)] if name == "LITERAL" else [(str(op), v) for op, v in value]
    out: set[int] = set()
    for op, what in items:
        if op == "LITERAL":
            out.add(what)
        elif op == "RANGE":
            out.update(range(what[0], what[1] + 1))
        elif op != "NEGATE":
            raise ValueError(f"{op} is not supported in a class")
    if fold:
        out |= {ord(chr(b).swapcase()) for b in out if b < 128}
    if items[0][0] == "NEGATE":
        out = set(range(256)) - out
    return frozenset(out)


@dataclass
class Automaton:
    """A deterministic automaton: ``rows[state][byte]`` is the next state, ``accepts[state]`` the bits of finished rules.

    States are numbered so that those with a finished rule come last, from ``first_accept`` on; state 0 is the start.
    """

    rows: list[tuple[int, ...]]
    accepts: list[int]
    first_accept: int
    #: The state that is never left and fulfils nothing; -1 if there is none.
    sink: int


def compile_rules(patterns: list[bytes], anywhere: bool = True) -> Automaton:
    """One automaton for all patterns. ``anywhere``: a match may start at any byte, else only at the first."""
    nfa = _Nfa()
    start = nfa.state()
    finals = {}
    for n, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        finals[nfa.add(syntax.parse(pattern), first, False)] = 1 << n
    if anywhere:
        nfa.steps[start].append((frozenset(range(256)), start))

    # Bytes that all steps treat alike share a column.
    sets = {members for steps in nfa.steps for members, _ in steps}
    kinds: dict[tuple[bool, ...], list[int]] = defaultdict(list)
    for byte in range(256):
        kinds[tuple(byte in members for members in sets)].append(byte)
    columns = list(kinds.values())

    # Subset construction.
    first = nfa.closure({start})
    numbers, table, open_ = {first: 0}, [], [first]
    while open_:
        states = open_.pop(0)
        row = []
        for column in columns:
            there = nfa.closure({to for s in states for members, to in nfa.steps[s] if column[0] in members})
            if there not in numbers:
                numbers[there] = len(numbers)
                open_.append(there)
            row.append(numbers[there])
        table.append(row)
    accepts = np.array([sum({finals[s] for s in states if s in finals}) for states in numbers], dtype=np.int64)
    moves = np.array(table, dtype=np.int64)

    # Minimisation: split classes of states until all states of a class step into the same classes.
    _, classes = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack((classes, classes[moves])), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == classes.max():
            break
        classes = finer
    members = np.unique(classes, return_index=True)[1]
    final = accepts[members] > 0
    order = sorted(range(len(members)), key=lambda c: (final[c], c != classes[0], c))
    if final[classes[0]]:
        raise ValueError("a rule matches the empty text")
    place = np.empty(len(members), dtype=np.int64)
    place[order] = np.arange(len(members))
    wide = np.empty((len(members), 256), dtype=np.int64)
    for at, column in enumerate(columns):
        wide[:, column] = place[classes[moves[members, at]]][:, None]
    rows = [tuple(row) for row in wide[order].tolist()]
    sink = next((n for n, row in enumerate(rows[: int((~final).sum())]) if set(row) == {n}), -1)
    return Automaton(rows, accepts[members][order].tolist(), int((~final).sum()), sink)
