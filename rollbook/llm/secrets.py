"""Secret scan: patterns label credentials, automata learned from them find more of the same formats.

The base patterns mark spans of three kinds. From their values, written as character classes after the first letters, a prefix tree is built for
each kind and its statistically compatible states are merged (ALERGIA: two states are compatible if all their relative
frequencies, and those of the states that follow, agree within the Hoeffding bound). Every candidate (a run of credential
characters outside the base spans, from the shortest learned value's length on) is scored by its log-likelihood per character under each
automaton; one that is as typical as the kind's own credentials (its likelihood lies between their lower
and upper `QUANTILE`: a run of one digit may be too likely) is a span `format-<kind>`. Base spans always stay.

Texts are read twice, to learn and to score; the values of the base spans are written to a table in the shared folder between. Learning
takes at most `MAX_LEARNED` distinct values of a kind, those with the smallest hashes; scoring covers all candidates of whole texts.
What was scored is kept for at most `KEPT_RUNS` short runs in a task. Missing and empty texts have no spans; repeated rows are scanned
each; other columns are not read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import checkpointed, keyed_text, per_text

MAX_LEARNED = 1000
KEPT_RUNS = 200_000
LONGEST_KEPT = 100
ALPHA = 0.05
QUANTILE = 0.01
KINDS = ("assign", "access", "hex")

# fixed values: the patterns of the base spans; an assign match counts if its value has 6 characters
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
MIN_ASSIGNED = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# a quick test that every text with a match passes: lower-casing maps A-Z to a-z, whatever else it does
KEYWORD = re.compile(r"passw|secret|token|api_?key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), by start and then by kind."""
    found = []
    if KEYWORD.search(text.lower()):
        found += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: Iterable[tuple[str, int, int, str]], least: int) -> list[tuple[int, int]]:
    """(start, end) of the runs, and of the parts of runs outside base spans, that are long enough."""
    taken = sorted((start, end) for _, start, end, _ in base)
    found = []
    for run in CANDIDATE.finditer(text):
        start, stop = run.span()
        if stop - start < least:
            continue
        while taken and taken[0][1] <= start:
            taken.pop(0)
        for first, last in taken:
            if first >= stop:
                break
            if first - start >= least:
                found.append((start, first))
            start = max(start, last)
        if stop - start >= least:
            found.append((start, stop))
    return found


LITERAL = 4  # formats begin with fixed letters; so many stand for themselves, the rest for their class
# character classes: digits, the letters that hexadecimal digits use, other small letters, capitals; the rest are themselves
CLASSES = str.maketrans({c: "0" for c in "0123456789"} | {c: "a" for c in "abcdef"} | {c: "g" for c in "ghijklmnopqrstuvwxyz"}
                        | {c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def symbols(value: str) -> list[str]:
    return list(value[:LITERAL]) + [c + c for c in value[LITERAL:].translate(CLASSES)]


class Automaton:
    """A probabilistic automaton: for each state how often it was passed, ended, and left by each symbol."""

    def __init__(self, values: Iterable[str], alpha: float = ALPHA):
        self.alpha = alpha
        self.ends = [0]
        self.counts: list[Counter] = [Counter()]
        self.next: list[dict[str, int]] = [{}]
        for value in values:
            state = 0
            for symbol in symbols(value):
                self.counts[state][symbol] += 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.ends.append(0)
                    self.counts.append(Counter())
                    self.next.append({})
                state = self.next[state][symbol]
            self.ends[state] += 1
        self._merge_states()

    def passed(self, state: int) -> int:
        return self.ends[state] + sum(self.counts[state].values())

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / self.alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return abs(x / n - y / m) > bound

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.passed(a), self.passed(b)
            if n == 0 or m == 0:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for symbol in {*self.counts[a], *self.counts[b]}:
                if self._differ(self.counts[a][symbol], n, self.counts[b][symbol], m):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Adds a subtree's counts to a state and those that follow it; `state` is still a tree."""
        todo = [(into, state)]
        while todo:
            into, state = todo.pop()
            self.ends[into] += self.ends[state]
            self.counts[into].update(self.counts[state])
            for symbol, child in self.next[state].items():
                if symbol in self.next[into]:
                    todo.append((self.next[into][symbol], child))
                else:
                    self.next[into][symbol] = child

    def _merge_states(self) -> None:
        """Settled states grow from the root; the next unsettled one joins the first it is compatible with, or settles."""
        settled = [0]
        while True:
            fringe = [(s, symbol, child) for s in settled for symbol, child in self.next[s].items() if child not in settled]
            if not fringe:
                return
            source, symbol, child = max(fringe, key=lambda f: (self.passed(f[2]), -f[2]))
            for state in settled:
                if self._compatible(state, child):
                    self.next[source][symbol] = state
                    self._fold(state, child)
                    break
            else:
                settled.append(child)

    def likelihood(self, value: str, least: float = -math.inf) -> float:
        """Mean logarithm of the probability of each symbol and of the end; unseen ones have a small probability. As
        soon as it can only be below `least`, -infinity."""
        state, total, known = 0, 0.0, True
        bound = least * (len(value) + 1)
        for place, letter in enumerate(value[:LITERAL] + value[LITERAL:].translate(CLASSES)):
            symbol = letter if place < LITERAL else letter + letter
            n = self.passed(state) if known else 0
            seen = self.counts[state][symbol] if known else 0
            total += math.log((seen + 0.01) / (n + 1))
            if total < bound:
                return -math.inf
            known = known and symbol in self.next[state]
            if known:
                state = self.next[state][symbol]
        n, seen = (self.passed(state), self.ends[state]) if known else (0, 0)
        return (total + math.log((seen + 0.01) / (n + 1))) / (len(value) + 1)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
SCANNED = pa.schema([("id", pa.int64()), ("spans", pa.list_(SPAN))])
SPANS_DDL = "array<struct<kind:string,start:long,end:long,value:string>>"


@dataclass
class Model:
    """An automaton, the likelihoods that values of its kind lie between, and the shortest one's length."""

    automaton: Automaton
    low: float
    high: float
    least: int


def learn(values: DataFrame, most: int = MAX_LEARNED) -> dict[str, Model]:
    """A model for each kind that occurs among (kind, value)."""
    models = {}
    for kind in KINDS:
        of_kind = values.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(most)
        sample = [r["value"] for r in of_kind.select("value").collect()]
        if sample:
            automaton = Automaton(sample)
            low, high = np.quantile([automaton.likelihood(v) for v in sample], [QUANTILE, 1 - QUANTILE])
            models[kind] = Model(automaton, float(low), float(high), min(map(len, sample)))
    return models


def best_kind(models: dict[str, Model], value: str) -> str | None:
    """The kind whose automaton likes a value most, among those for which it is typical."""
    scored = [(likely, k) for k, m in models.items() if len(value) >= m.least
              and m.low <= (likely := m.automaton.likelihood(value, m.low)) <= m.high]
    return max(scored)[1] if scored else None


def _listed(spans: list[tuple[str, int, int, str]]) -> list[dict]:
    return [dict(zip(("kind", "start", "end", "value"), s)) for s in spans]


def _base(ids, texts):
    return ids, [_listed(base_spans(t)) for t in texts]


def _scan(models: dict[str, Model]):
    def make():
        known: dict[str, str | None] = {}
        least = min((m.least for m in models.values()), default=0)

        def kind_of(value: str) -> str | None:
            if value in known:
                return known[value]
            kind = best_kind(models, value)
            if len(value) <= LONGEST_KEPT:
                if len(known) >= KEPT_RUNS:
                    known.clear()
                known[value] = kind
            return kind

        def spans(text: str) -> list[dict]:
            base = base_spans(text)
            more = [(f"format-{kind}", start, end, text[start:end]) for start, end in (candidates(text, base, least) if models else [])
                    if (kind := kind_of(text[start:end]))]
            return _listed(sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]) if s[0] in KINDS else len(KINDS), s[0], s[2])))

        return lambda ids, texts: (ids, [spans(t) for t in texts])

    return make


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text: `spans`, an array of (kind, start, end, value) by start and then by kind."""
    keyed = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    ddl = f"id long, spans {SPANS_DDL}"
    labelled = per_text(keyed, lambda: _base, SCANNED, ddl).select(F.explode("spans").alias("s")).select("s.kind", "s.value")
    models = learn(checkpointed(labelled.distinct()))
    return per_text(keyed, _scan(models), SCANNED, ddl).withColumnRenamed("id", id_col)
