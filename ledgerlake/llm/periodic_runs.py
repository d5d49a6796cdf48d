"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal), of at least ``min_length`` words and ``min_exponent`` periods,
that no neighbouring word extends.

Method.  Words are appended to a suffix automaton one by one.  The tree of its
suffix links is held in link-cut paths, each coloured with the position at which
its strings ended last.  Appending word ``i`` accesses the path from the new
state to the root: every segment it crosses says that the suffix of ``length``
words, the length of the segment's deepest state on the path, ended before at
the segment's colour ``j`` and no later.  If that length reaches the distance
``i - j``, the words up to ``i`` end in a square of period ``i - j``; the length
is the whole common suffix of both places, so the square is already extended to
the left as far as it goes.  The path is then recoloured ``i``.  The smallest
period of any repetition that ends at ``i`` is always among these distances (a
primitive word does not occur inside its own square but at its ends), so the
last ``i`` of a start and a period is the end of a run.  An access crosses
O(log n) segments, amortised.

Before that, words that cannot lie in a run are cut out, exactly: a word of a run
occurs at least ``min_exponent`` times within it.  So a word that occurs less
often in its stretch is in no run, the stretch falls in two there, and the count
is repeated in the parts until nothing changes.

Scale: documents are independent, nothing is shuffled.  A task holds a few
megabytes of text, or one document, at a time; the automaton is kept in flat
arrays, some 100 bytes a word of the stretches that are left.

Defined results: a null, empty or blank text has no words and no runs; a null id
is kept; repeated rows are answered each; an empty table gives an empty result;
further columns are ignored.  Words are the runs of characters other than ASCII
white space, whole texts, compared by their bytes.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 22

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass(frozen=True)
class Runs:
    min_length: int = 6      # words
    min_exponent: int = 4    # periods, 2 at least

    def __post_init__(self):
        if self.min_exponent < 2:
            raise ValueError("a run has two periods at least")


class LastEnds:
    """A suffix automaton whose states know where their strings ended last."""

    def __init__(self, words: int):
        states = 2 * words + 2
        self.used = 0
        self.last = 0
        self.length, self.link = array("i", [0]) * states, array("i", [-1]) * states
        # a state's first transition lies in arrays, further ones in a dict
        self.word, self.next = array("i", [-1]) * states, array("i", [-1]) * states
        self.more: dict[int, dict[int, int]] = {}
        # link-cut paths as splay trees in order of depth; the root of a path's
        # tree has its colour, and ``up`` leads on to the path above it
        self.up, self.left, self.right = (array("i", [-1]) * states for _ in range(3))
        self.colour = array("i", [-1]) * states
        self._state(0)

    def _state(self, length: int) -> int:
        k = self.used
        self.used += 1
        self.length[k] = length
        return k

    def _go(self, p: int, w: int) -> int:
        if self.word[p] == w:
            return self.next[p]
        more = self.more.get(p)
        return more.get(w, -1) if more else -1

    def _set(self, p: int, w: int, q: int) -> None:
        if self.word[p] in (-1, w):
            self.word[p], self.next[p] = w, q
        else:
            self.more.setdefault(p, {})[w] = q

    def append(self, w: int) -> int:
        """The state of the text so far with ``w`` behind it."""
        length, link, go = self.length, self.link, self._go
        new, p = self._state(length[self.last] + 1), self.last
        while p >= 0 and (q := go(p, w)) < 0:
            self._set(p, w, new)
            p = link[p]
        if p < 0:
            link[new] = 0
        elif length[p] + 1 == length[q]:
            link[new] = q
        else:
            link[new] = twin = self._split(p, q)
            while p >= 0 and go(p, w) == q:
                self._set(p, w, twin)
                p = link[p]
        self.up[new] = link[new]
        self.last = new
        return new

    def _split(self, p: int, q: int) -> int:
        """A state for the shorter strings of ``q``, which ended last where
        those of ``q`` did: it goes right above ``q`` in its path."""
        twin = self._state(self.length[p] + 1)
        self.word[twin], self.next[twin] = self.word[q], self.next[q]
        if q in self.more:
            self.more[twin] = dict(self.more[q])
        self.link[twin], self.link[q] = self.link[q], twin
        self._splay(q)
        above = self.left[twin] = self.left[q]
        if above >= 0:
            self.up[above] = twin
        self.left[q], self.up[twin] = twin, q
        return twin

    def _splay(self, x: int) -> None:
        """Makes ``x`` the root of its path's tree."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        while p >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            if inner and (left[g] == p) == (left[p] == x):
                self._rotate(p)
            elif inner:
                self._rotate(x)
            else:
                self.colour[x] = self.colour[p]
            self._rotate(x)
            if inner:
                self.colour[x] = self.colour[g]
            p = up[x]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b >= 0:
            up[b] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, x: int, now: int) -> list[tuple[int, int]]:
        """(length, last end) of every segment between ``x`` and the root, whose
        strings then all end ``now``."""
        seen, below = [], -1
        up, right, colour = self.up, self.right, self.colour
        while x >= 0:
            self._splay(x)
            c = colour[x]
            if c >= 0:
                seen.append((self.length[x], c))
                if (r := right[x]) >= 0:
                    colour[r] = c
            right[x] = below
            below, x = x, up[x]
        colour[below] = now
        return seen


def runs_of(words: list[int], how: Runs = Runs()) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, in this order."""
    ends: dict[tuple[int, int], int] = {}
    text = LastEnds(len(words))
    least, times = how.min_length, how.min_exponent
    for i, w in enumerate(words):
        for common, j in text.access(text.append(w), i):
            period = i - j
            whole = common + period
            if common >= period and whole >= least and whole >= times * period:
                ends[i - whole + 1, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def stretches(words: np.ndarray, text: np.ndarray, how: Runs = Runs()) -> list[tuple[int, int]]:
    """(from, to) of the stretches of ``words`` that may hold a run; ``text`` is
    the number of the text of each word."""
    at, part = np.arange(len(words)), text.astype(np.int64)
    wide = int(words.max()) + 1 if len(words) else 1
    while len(at):
        kinds = pa.array(part * wide + words[at]).dictionary_encode().indices.to_numpy()
        often = np.bincount(kinds)[kinds] >= how.min_exponent
        left, part = at[often], part[often]
        # a new part begins where a word is missing or another text begins
        begins = np.ones(len(left), bool)
        begins[1:] = (np.diff(left) != 1) | (np.diff(part) != 0)
        part = np.cumsum(begins) - 1
        long = np.bincount(part, minlength=1)[part] >= max(how.min_length, how.min_exponent)
        left, part = left[long], part[long]
        if len(left) == len(at):
            first = np.flatnonzero(np.diff(part, prepend=-1))
            last = np.append(first[1:], len(at)) - 1
            return list(zip(at[first].tolist(), (at[last] + 1).tolist()))
        at = left
    return []


def _answer(texts: pa.Array, how: Runs) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(number of words, runs, collapsed text) of each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    number = pc.list_parent_indices(split).to_numpy()
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    words, number = words.filter(pa.array(full)), number[full]
    counts = np.bincount(number, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(counts)))
    codes = words.dictionary_encode().indices.to_numpy()
    keep = np.ones(len(codes), bool)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, z in stretches(codes, number, how):
        d = int(number[a])
        for start, length, period in runs_of(codes[a:z].tolist(), how):
            found.setdefault(d, []).append((a - int(first[d]) + start, length, period))
            keep[a + start + period:a + start + length] = False
    rows = [r for d in sorted(found) for r in sorted(found[d], key=lambda r: (r[0], r[2]))]
    sizes = np.array([len(found.get(d, ())) for d in range(len(texts))], np.int64)
    columns = np.array(rows, np.int64).reshape(-1, 3)
    runs = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(columns[:, k]) for k in range(3)], ["start", "length", "period"]))
    kept = np.concatenate(([0], np.cumsum(np.bincount(number[keep], minlength=len(texts)))))
    left = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(keep)))
    return pa.array(counts, pa.int64()), runs, pc.binary_join(left, " ")


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", how: Runs = Runs()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (by start, then period)
    and ``collapsed``, the words joined by one space without those that a run
    holds after its first period."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy())
            at = 0
            while at < len(b):      # a few megabytes of text, or one document
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + BATCH_BYTES, "right")))
                some = b.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([some.column(0), *_answer(some.column(1), how)],
                                                 names=["doc_id", "n_words", "runs", "collapsed"])
                at = to

    return given.mapInArrow(answers, f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length; of these the first, then of least period."""
    best = F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    return F.when(best.isNotNull(), F.struct(
        best["start"].alias("start"), (-best["n"]).alias("length"), best["period"].alias("period")))
