"""Token alignment against plain Python over byte ends: the lockstep walk, groups
and links, corpus counts, odd texts, both ways the counts come back."""

import dataclasses
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from ledgerlake.llm import queries, token_alignment
from ledgerlake.llm.token_alignment import lanes_of, lockstep

SF = "/root/testdata/sf0.001"
HOW = queries.alignment_defaults()


@pytest.fixture(scope="module")
def tokens():
    """A text's tokens under A and B as (id, bytes), from the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(HOW.a), sentencepiece.SentencePieceProcessor(model_file=HOW.b)
    a.encode_special_tokens = True
    spell, n = {}, 0
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174:
            spell[chr(x)] = x
        else:
            spell[chr(256 + n)], n = x, n + 1

    def of(text):
        if not text:
            return [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        x = [(i, bytes(spell[c] for c in a.id_to_token(i))) for i in ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = all(b"".join(s for _, s in t) == whole for t in (x, y))
        return (x, y) if same else ([], [])

    return of


def plain_groups(x, y):
    def ends(t):
        return list(np.cumsum([len(s) for _, s in t]))
    ex, ey = ends(x), ends(y)
    cuts = sorted(set(ex) & set(ey))
    groups, low = [], 0
    for c in cuts:
        groups.append(([i for (i, _), e in zip(x, ex) if low < e <= c], [i for (i, _), e in zip(y, ey) if low < e <= c]))
        low = c
    return groups


def plain_rows(texts, tokens):
    rows, holders = [], defaultdict(int)
    for t in texts:
        x, y = tokens(t)
        groups = plain_groups(x, y)
        links = Counter((a, b) for g in groups for a in g[0] for b in g[1])
        for p in links:
            holders[p] += 1
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((len(x), len(y), len(groups), links, hashlib.sha256(said.encode()).hexdigest() if x else ""))
    top = defaultdict(int)
    for (a, _), n in holders.items():
        top[a] = max(top[a], n)
    return [(na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if holders[p] == top[p[0]]),
             sum(n * holders[p] for p, n in links.items()), sha) for na, nb, ng, links, sha in rows]


def test_lockstep_walk():
    rng = random.Random(5)
    for _ in range(200):
        ends_a, ends_b, counts, at = [], [], [], 0
        for _ in range(rng.randint(1, 5)):
            n = rng.choice([1, 2, 5, 30, 200])
            a = sorted(set(rng.sample(range(1, n + 1), rng.randint(1, n))) | {n})
            b = sorted(set(rng.sample(range(1, n + 1), rng.randint(1, n))) | {n})
            ends_a += [at + e for e in a]
            ends_b += [at + e for e in b]
            counts.append(len(a))
            at += n
        walk, i, j = [], 0, 0
        while i < len(ends_a):
            walk.append((i, j))
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
        cuts = [(i, j) for i, j in walk if ends_a[i] == ends_b[j]]
        for lane in (1, 3, 7, 512):
            la, lb, ca, cb = lockstep(np.array(ends_a), np.array(ends_b), *lanes_of(np.array(counts), lane))
            assert list(zip(la.tolist(), lb.tolist())) == walk
            assert list(zip(ca.tolist(), cb.tolist())) == cuts


TEXTS = [None, "", " ", "a", "Hello, world!  two  spaces", "naïve Ünïcödé 漢字かな 🎉🎉", "x" * 5000, "ab" * 3000 + "c",
         "</s> <|endoftext|> <s> <0x41> <unk>", "a▁b", "tab\there\nand\r\nthere", "\x00\x01 null", "١٢٣ ९८७", "é́́ " * 40,
         "Hello, world!  two  spaces", "漢" * 3000, "0123456789" * 700]


def test_odd_texts(spark, tokens):
    given = spark.createDataFrame([(None if i == 4 else i % 9, t, "k", 0) for i, t in enumerate(TEXTS)],
                                  "doc_id long, text string, k string, pairs int")
    want = Counter((None if i == 4 else i % 9, *r) for i, r in enumerate(plain_rows(TEXTS, tokens)))
    for most in (500_000, 20, 0):      # counts by broadcast, by both ways, by the join alone
        how = dataclasses.replace(HOW, broadcast_pairs=most)
        assert Counter(tuple(r) for r in token_alignment.corpus_links(given, how).collect()) == want
    assert token_alignment.corpus_links(given.limit(0), HOW).count() == 0
    assert not any(n for _, n, *_ in (r for r in want if r[-1] == ""))


def test_groups_as_text(spark, tokens):
    given = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in token_alignment.align(given.coalesce(1), HOW, with_groups=True).collect():
        groups = plain_groups(*tokens(TEXTS[r.doc_id]))
        assert r.groups == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        links = Counter((a << 32) | b for g in groups for a in g[0] for b in g[1])
        assert dict(zip(r.pairs, r.times)) == links and r.pairs == sorted(r.pairs)


def test_large_groups_are_counted_by_id():
    """The same pairs whether a group is listed or its ids are counted first."""
    v = token_alignment.vocabularies(HOW)
    texts = ["漢" * 300 + " a b", None, "x" * 999, "hello there " * 30]
    want = token_alignment.align_batch(texts, v)
    full, token_alignment.FULL_GROUP = token_alignment.FULL_GROUP, 1
    try:
        got = token_alignment.align_batch(texts, v)
    finally:
        token_alignment.FULL_GROUP = full
    assert {k: x.to_pylist() for k, x in got.items()} == {k: x.to_pylist() for k, x in want.items()}


def test_query_against_plain_python(spark, tokens):
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = dict(zip((r["doc_id"] for r in rows), plain_rows([r["text"] for r in rows], tokens)))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_token_alignment(spark, SF).collect()}
    assert got == want


def test_parts_are_encoded_as_in_the_whole_text():
    v = token_alignment.vocabularies(HOW)
    rng, pool = random.Random(8), list("ab1.,'ñé漢🎉́ ​﻿ \x1c\x85▁</s>\t\n\r") + [" "] * 12 + ["'s", "the"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(20_000)]
    texts += ["a ", "a  ", " a", "  ", " ", "a \n b", "a  b", "x  y   z", "don't 'll I'm "]
    assert v.apart
    want_a = [e.ids for e in v.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    want_b = v.b.encode(texts, num_threads=1)
    for t, (x, y), a, b in zip(texts, v.encode(texts), want_a, want_b):
        whole = (" " + t).encode()
        same = (t and b"".join(v.bytes_a[i] for i in a) == whole and b"".join(v.bytes_b[i] for i in b) == whole)
        assert (x.tolist(), y.tolist()) == ((a, b) if same else ([], [])), repr(t)
