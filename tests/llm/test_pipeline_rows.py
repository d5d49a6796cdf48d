"""The quality rule and the pipeline's rows against plain Python."""

import os
import random
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402

from ledgerlake.llm import quality_rules, queries  # noqa: E402


def engine_hashes(spark, rows):
    """The hashes of (source, word) and (source, line) that order sketches."""
    hosts = {}
    pairs = {(s, x) for s, t in rows for line in (t or "").split("\n") if plain.words(line)
             for x in [plain.normalised(line)]}
    with_words = {(s, w) for s, x in pairs for w in x.split(" ")}
    df = spark.createDataFrame([(s, x, True) for s, x in pairs] + [(s, w, False) for s, w in with_words],
                               "s string, x string, line boolean")
    h = F.xxhash64(F.col("s").isNull().cast("int"), F.col("s"))
    for r in df.select("s", "x", "line", F.hash(h, F.col("x")).alias("w"), F.xxhash64(h, F.col("x")).alias("k")).collect():
        hosts[(r.s, r.x, r.line)] = r.k if r.line else r.w

    class Hashes:
        def __getitem__(self, key):
            # a line of one word is asked for by its word only in sketches of few words
            return hosts.get((*key, False), hosts.get((*key, True)))

    return Hashes()


def corpus(seed=1):
    """Rows with boilerplate and its variants, copies, near copies, benchmark
    passages, short, repetitive and depleted documents."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "rt", "st", "x")]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n))
    licence = "all rights " + sentence(14)
    items = [sentence(n) for n in (8, 12, 25, 40, 9)]
    rows = []
    for i in range(110):
        parts = [sentence(rng.randint(6, 25)) for _ in range(rng.randint(2, 5))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), licence if i % 2 else licence.upper())
        if i % 11 == 5:
            w = licence.split()
            w[rng.randrange(len(w))] = "changed"
            parts.append(" ".join(w))
        if i % 9 == 4:
            parts.append(f"{sentence(5)} {items[i % 5]} {sentence(4)}")
        if i % 13 == 7:
            parts.append(rng.choice(rows)[1].split("\n")[0])
        if i % 17 == 3:
            parts = [sentence(9) + " "] * 6
        text = "\n".join(parts)
        if i % 10 == 8:
            text = rng.choice(rows)[1]
        if i % 10 == 9:
            w = rng.choice(rows)[1].split(" ")
            w[len(w) // 2] = "near"
            text = " ".join(w)
        rows.append(("web" if i % 4 else "other", text))
    rows += [("web", licence + "\n" + sentence(3) + f" end{k}") for k in range(6)]       # depleted
    rows += [("web", "too short"), ("web", None), (None, ""), (None, sentence(30) + "\n \n" + sentence(30))]
    return rows, items


@pytest.mark.parametrize("source", ["planted", "/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_quality_rule(spark, source, tmp_path):
    if source == "planted":
        rows, _ = corpus()
    else:
        t = pq.read_table(f"{source}/documents.parquet", columns=["source", "text"])
        rows = list(zip(t["source"].to_pylist(), t["text"].to_pylist()))
        # accents change under lower case alike; other scripts are left to the engine
        rows = [(s, x) for s, x in rows if x is None or x.lower().upper().lower() == x.lower()]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    got = {r.doc_id: (r.kept, r.removed_chars) for r in quality_rules.judge(docs).collect()}
    want = {i: (kept, gone) for i, (kept, _, gone) in enumerate(plain.quality(rows, engine_hashes(spark, rows)))}
    assert got == want
    assert any(not k for k, _ in want.values()) and (source != "planted" or sum(g > 0 for _, g in want.values()) > 20)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rows, items = corpus(2)
    path = tmp_path_factory.mktemp("corpus")
    texts = [t for _, t in rows]
    pq.write_table(pa.table({
        "doc_id": pa.array(range(len(rows)), pa.int64()), "text": pa.array(texts, pa.string()),
        "lang": pa.array(["en"] * len(rows)), "source": pa.array([s for s, _ in rows], pa.string()),
        "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), f"{path}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array(range(len(items)), pa.int64()), "text": pa.array(items)}),
                   f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_rows_of_the_pipeline(spark, folder):
    """``run``: which documents are left, with which texts, in which tokens."""
    import corpus_pipeline
    path, rows, items = folder
    judged = plain.quality(rows, engine_hashes(spark, rows))
    left = [(i, t) for i, (kept, t, _) in enumerate(judged) if kept]
    assert len(left) < len(rows) - 8
    cut = plain.dedup_lines(left)
    assert any(a != b for (_, a), b in zip(left, cut))
    alone = plain.near_duplicates([(i, t) for (i, _), t in zip(left, cut)])
    assert len(alone) < len(left)
    clean = [(i, t) for i, t in alone if not plain.contaminated(t, items)]
    assert 20 < len(clean) < len(alone)
    # the stages one after the other, as the pipeline hands them on
    docs, want = queries.table(spark, path, "documents"), [dict(left), dict(zip(dict(left), cut)), dict(alone), dict(clean)]
    for (name, stage), rest in zip(corpus_pipeline.STAGES, want):
        docs = corpus_pipeline.written(stage(spark, docs, path), f"test-{name}")
        assert {r.doc_id: r.text for r in docs.collect()} == rest, name
    # the rows of the whole
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, path).collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(dict(clean))
    for doc_id, text in clean:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    sequences = defaultdict(list)
    for rs in pieces.values():
        for r in rs:
            sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
