"""Decontamination: the sketches find the candidates, only these are verified, and
a benchmark too large for a bitmap gives the same."""

import dataclasses
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate
from ledgerlake.llm.decontaminate import Containment

WORDS = [f"w{i}" for i in range(300)]


def grams(text, n=5):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    items = [" ".join(rng.choices(WORDS, k=rng.choice([5, 9, 20, 60, 300]))) for _ in range(40)] + [None, "too short", ""]
    items.append(items[0])
    docs = []
    for i in range(160):
        w = rng.choices(WORDS, k=rng.randint(0, 200))
        if i % 2 == 0:
            part = rng.choice(items[:40]).split()
            kept = part[:max(5, int(len(part) * rng.choice([0.08, 0.1, 0.12, 0.3, 0.7, 0.85, 1.0])))]
            at = rng.randint(0, len(w))
            w = w[:at] + kept + w[at:]
        docs.append(" ".join(w))
    docs += [None, "", docs[0]]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, k string")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return d, b, docs, items


def test_candidates_come_from_sketches(spark, tables):
    d, b, docs, items = tables
    how = Containment()
    table = decontaminate.written(decontaminate.item_shingles(b, "item_id", "text", how), "test-shingles")
    pairs = decontaminate.candidates(d, table, "text", how)
    keyed = d.select("doc_id", decontaminate.row_key(d).alias("key"))
    found = {(r.doc_id, r.item_id) for r in pairs.join(keyed, F.col("k") == F.col("key")).select("doc_id", "item_id").collect()}
    want, touched = set(), set()
    for j, item in enumerate(items[:40]):
        s = grams(item)
        for i, t in enumerate(docs):
            share = len(s & grams(t))
            if s and 100 * share >= 80 * len(s):
                want.add((i, j))
            if share:
                touched.add((i, j))
    # none is missed, and pairs that share a little are no candidates
    assert want <= found <= touched and len(found) < len(touched)
    sketched = table.where("sketch").count()
    assert 0 < sketched < 0.5 * table.count()
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained(d, b).collect()}
    assert got == want


def test_without_a_bitmap(spark, tables):
    d, b, *_ = tables
    small = dataclasses.replace(Containment(), max_bitmap_bits=6, key_bits=7)
    assert sorted(decontaminate.contained(d, b, how=small).collect()) == sorted(decontaminate.contained(d, b).collect())
    left = decontaminate.decontaminate(d, b, how=small)
    assert left.columns == d.columns and left.count() == decontaminate.decontaminate(d, b).count() < d.count()
