"""Several regular expressions as one minimal deterministic automaton over bytes.

Supported: literals, escapes of signs, ``\\d``-free character classes with ranges, groups,
alternation, ``? * +`` and ``{m,}``/``{m}``/``{m,n}``; a rule may ignore the case of ASCII letters.
The automaton searches: its start state loops on every byte, so a match may begin anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class _Nfa:
    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)
    empty: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1


class _Parser:
    """Recursive descent over a pattern; adds each part to the NFA as (entry, exit)."""

    def __init__(self, pattern: str, nfa: _Nfa, ignore_case: bool) -> None:
        self.text, self.at, self.nfa, self.ignore_case = pattern, 0, nfa, ignore_case

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        c = self.peek()
        self.at += 1
        return c

    def bytes_of(self, codes: set[int]) -> frozenset[int]:
        if self.ignore_case:
            codes |= {c ^ 32 for c in codes if chr(c).isalpha() and c < 128}
        return frozenset(codes)

    def edge(self, codes: set[int]) -> tuple[int, int]:
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.moves[a].append((self.bytes_of(codes), b))
        return a, b

    def alternatives(self) -> tuple[int, int]:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        if len(parts) == 1:
            return parts[0]
        a, b = self.nfa.state(), self.nfa.state()
        for x, y in parts:
            self.nfa.empty[a].append(x)
            self.nfa.empty[y].append(b)
        return a, b

    def sequence(self) -> tuple[int, int]:
        start = end = self.nfa.state()
        while self.peek() not in ("", "|", ")"):
            begin = self.at
            x, y = self.atom()
            stop = self.at
            low, high = self.counts()
            after = self.at
            for k in range(max(low, 1 if high is None or high > 0 else 0) if high is None else high):
                if k:  # every further copy is parsed anew
                    self.at = begin
                    x, y = self.atom()
                self.nfa.empty[end].append(x)
                if k >= low:
                    out = self.nfa.state()
                    self.nfa.empty[y].append(out)
                    self.nfa.empty[end].append(out)
                    end = out
                else:
                    end = y
            if high is None:
                if low == 0:
                    pass
                self.nfa.empty[y].append(x)
            self.at = max(stop, after)
        return start, end

    def counts(self) -> tuple[int, int | None]:
        c = self.peek()
        if c == "?":
            self.take()
            return 0, 1
        if c == "*":
            self.take()
            return 0, None
        if c == "+":
            self.take()
            return 1, None
        if c == "{":
            close = self.text.index("}", self.at)
            low, comma, high = self.text[self.at + 1 : close].partition(",")
            self.at = close + 1
            return int(low), (int(high) if high else None) if comma else int(low)
        return 1, 1

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            code = int(self.text[self.at : self.at + 2], 16)
            self.at += 2
            return code
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def atom(self) -> tuple[int, int]:
        c = self.take()
        if c == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            part = self.alternatives()
            self.take()
            return part
        if c == "[":
            codes: set[int] = set()
            while self.peek() != "]":
                low = self.escape() if (c := self.take()) == "\\" else ord(c)
                if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                    self.take()
                    high = self.escape() if (c := self.take()) == "\\" else ord(c)
                    codes |= set(range(low, high + 1))
                else:
                    codes.add(low)
            self.take()
            return self.edge(codes)
        return self.edge({self.escape() if c == "\\" else ord(c)})


@dataclass(frozen=True)
class Automaton:
    """``table[state * 256 + byte]`` is the next state, 0 the start; ``accepts[state]`` has a bit per rule."""

    table: np.ndarray
    accepts: np.ndarray

    @property
    def resets(self) -> np.ndarray:
        """Bytes after which every state is the start: no match spans them."""
        return (self.table.reshape(-1, 256) == 0).all(0)


def compile_rules(rules: list[tuple[str, bool]]) -> Automaton:
    """Subset construction over all rules (pattern, ignore case) at once, then minimisation by refinement."""
    nfa = _Nfa()
    begin = nfa.state()
    finals: dict[int, int] = {}
    for bit, (pattern, ignore_case) in enumerate(rules):
        parser = _Parser(pattern, nfa, ignore_case)
        x, y = parser.alternatives()
        if parser.at < len(pattern):
            raise ValueError(f"not understood from {parser.at}: {pattern}")
        nfa.empty[begin].append(x)
        finals[y] = 1 << bit

    def closure(states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    start = closure({begin})
    number, todo, table, accepts = {start: 0}, [start], [], []
    while todo:
        current = todo.pop(0)
        targets: list[set[int]] = [set() for _ in range(256)]
        for s in current:
            for codes, t in nfa.moves[s]:
                for c in codes:
                    targets[c].add(t)
        row, cache = [], {}
        for t in targets:
            key = frozenset(t)
            if key not in cache:
                cache[key] = closure(t | {begin})
            state = cache[key]
            if state not in number:
                number[state] = len(number)
                todo.append(state)
            row.append(number[state])
        table.append(row)
        accepts.append(sum(finals.get(s, 0) for s in current))
    grid, accept = np.array(table), np.array(accepts)
    _, group = np.unique(accept, return_inverse=True)
    while True:
        rows = np.column_stack((group, group[grid]))
        _, refined = np.unique(rows, axis=0, return_inverse=True)
        refined = refined.ravel()
        if refined.max() == group.max():
            break
        group = refined
    # The start's group becomes state 0.
    first = np.array([np.flatnonzero(group == g)[0] for g in range(group.max() + 1)])
    swap = np.arange(len(first))
    swap[group[0]], swap[0] = 0, group[0]
    order = np.argsort(swap)
    small = swap[group[grid[first[order]]]]
    kind = np.uint16 if small.max() < 65536 else np.int32
    return Automaton(small.astype(kind).ravel(), accept[first[order]].astype(np.uint32))


def scan(automaton: Automaton, data: np.ndarray, lanes: int = 4096) -> np.ndarray:
    """The accepted rules (bits) after each byte of ``data``, read once from the start state.

    ``data`` is cut into about ``lanes`` runs behind reset bytes, where the state is the start anyway,
    and all runs advance together, one byte at a time. A run without a reset byte is longer.
    """
    n = len(data)
    out = np.zeros(n, np.uint32)
    if not n:
        return out
    resets = np.flatnonzero(automaton.resets[data]) + 1
    wanted = np.arange(0, n, max(1, -(-n // lanes)))
    at = np.searchsorted(resets, wanted)
    begins = np.unique(np.concatenate(([0], resets[at[at < len(resets)]])))
    begins = begins[begins < n]
    sizes = np.diff(np.concatenate((begins, [n])))
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[order], sizes[order]
    table, accepts = automaton.table, automaton.accepts
    state = np.zeros(len(begins), np.int64)
    accepting = accepts > 0
    alive = len(begins)
    for step in range(int(sizes[0])):
        while alive and sizes[alive - 1] <= step:
            alive -= 1
        place = begins[:alive] + step
        state = table[(state[:alive].astype(np.int64) << 8) | data[place]]
        hit = accepting[state]
        if hit.any():
            out[place[hit]] = accepts[state[hit]]
    return out
