"""Periodic runs against all periods of all stretches, the registered query
against plain Python over the whole documents table, and the odd rows."""

import hashlib
import random
import zlib

import pyarrow.parquet as pq
import pytest

from ledgerlake.llm import periodic_runs, queries
from ledgerlake.llm.periodic_runs import Runs, find_runs, runs_of

SF = "/root/testdata/sf0.001"


def plain_runs(w, how=Runs()):
    n, out = len(w), []
    for q in range(1, n // how.min_exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if size >= max(how.min_length, how.min_exponent * q) and not any(
                    w[s:s + size - p] == w[s + p:s + size] for p in range(1, q)):
                out.append((s, size, q))
    return sorted(out)


def test_runs_against_all_periods():
    rng = random.Random(7)
    for how in (Runs(), Runs(2, 2), Runs(7, 3)):
        for _ in range(800):
            n, kinds = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 6])
            w = [rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 9)
                w = w[:a] + [w[min(n - 1, a + (i - a) % p)] for i in range(a, n)]
            assert runs_of(w, how) == plain_runs(w, how)


def test_every_end_of_a_repeated_suffix_is_seen():
    """An access tells the latest earlier end of each suffix, no more."""
    rng = random.Random(2)
    w = [rng.randrange(3) for _ in range(60)]
    text = periodic_runs.LastEnds(len(w))
    for i, x in enumerate(w):
        seen = text.access(text.append(x), i)
        for size in range(1, i + 2):
            ends = [j for j in range(size - 1, i) if w[j - size + 1:j + 1] == w[i - size + 1:i + 1]]
            told = [c for n, c in seen if n >= size]
            assert (max(told, default=None)) == (ends[-1] if ends else None)


def test_a_run_needs_two_periods():
    with pytest.raises(ValueError):
        Runs(min_exponent=1)


def test_odd_rows(spark):
    hot = "a b " * 4000
    texts = [None, "", " \t\n ", "x", "x " * 5, "x " * 6, hot, hot, "p q r\n" * 4 + "p", "\x1cx  " * 7,
             "é è " * 6, "a\x0bb\x0ca\rb\ta b a b"]
    given = spark.createDataFrame([(None if i == 3 else i % 11, t, "k", [1]) for i, t in enumerate(texts)],
                                  "doc_id long, text string, runs string, n_words array<int>")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
           for r in find_runs(given.coalesce(1)).collect()]
    assert len(got) == len(texts)
    for (doc_id, n, runs, text), (i, t) in zip(got, enumerate(texts)):
        w = (t or "").encode().split()
        assert doc_id == (None if i == 3 else i % 11) and n == len(w)
        assert runs == plain_runs(w)
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        assert text == b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
    assert find_runs(given.limit(0)).count() == 0


def test_query_against_plain_python(spark):
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = {}
    for r in rows:
        w = (r["text"] or "").encode().split()
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        best = min(((-size, s, q) for s, size, q in runs), default=None)
        top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        said = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda x: (x[0], x[2])))
        want[r["doc_id"]] = (len(runs), *top, hashlib.sha256(said.encode()).hexdigest(),
                             hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, SF).collect()}
    assert got == want and sum(x[0] for x in want.values()) > 5
