"""Source mixing: targets against a plain loop, permutations, the draws, and the
whole mix read back; odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import source_mixing
from ledgerlake.llm.source_mixing import Mixing

ROWS = "doc_id long, text string, source string, size int, rank string, n string"
SMALL = Mixing(block=8, shard=16, rounds=8)


def corpus(spark, scale=1):
    rows, n = [], 0
    for source, docs, size in [("b", 60, 9), ("a", 40, 30), ("é", 1, 3), (None, 7, 11), ("hot", 150, 20),
                               ("A", 3, 1), ("none", 4, 0), ("tiny", 1, 1), ("long", 1, 900)]:
        for k in range(docs * scale):
            text = "\t".join(f"{source}{n}.{i}" for i in range(size if k % 3 else 2 * size)) if size else (None, "", " \n")[k % 3]
            rows.append((n, text, source, 0, "x", None))
            n += 1
    rows += [rows[3]] * 3 + [(None, "q r s t", "b", 0, "x", None)] * 2
    return spark.createDataFrame(rows, ROWS)


def plain_targets(sizes, how):
    """Repeats the sharing until no source is above its most."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: how.weights[k % len(how.weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(how.most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        level = left / free if free else 0
        above = {s for s in order if s not in capped and weight[s] * level > how.most * sizes[s]}
        if not above:
            return {s: how.most * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= above


def test_targets_against_a_plain_loop(spark):
    docs = corpus(spark)
    sized = source_mixing.sizes(docs)
    rows = sized.collect()
    assert len(rows) == docs.count() and len({(r.source, r.place) for r in rows}) == len(rows)
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    want = plain_targets(sizes, SMALL)
    got = {r.source: r for r in source_mixing.targets(sized, SMALL).collect()}
    assert set(got) == set(want)
    for s, r in got.items():
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.epochs <= SMALL.most and abs(r.words - r.target) <= 0.5
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert any(r.target == 3 * r.source_size > 0 for r in got.values())


def test_permutations(spark):
    for n in (1, 2, 3, 7, 64, 100):
        out = spark.range(n).select(source_mixing._permuted(
            F.col("id"), F.lit(n).cast("long"), source_mixing._round_keys(F.lit(n).cast("long"), 24, "s", F.lit(n)),
            "s", F.lit(n)).alias("y"))
        image = [r.y for r in out.collect()]
        assert sorted(image) == list(range(n))
        assert n < 50 or image != list(range(n))


def test_the_mix_read_back(spark):
    docs = corpus(spark, 2)
    sized, sources, mixed = source_mixing.mix(docs, SMALL)
    info = {r["rank"]: r for r in sources.collect()}
    out = source_mixing.texts(docs, SMALL).collect()
    # slots are numbered without gaps, shards are full but for the last
    shards = defaultdict(list)
    for r in out:
        shards[r.shard].append(r["at"])
    assert sorted(shards) == list(range(len(shards)))
    for k, at in shards.items():
        assert sorted(at) == list(range(SMALL.shard if k + 1 < len(shards) else len(at)))
    # words taken: those of the targets, none more often than allowed
    taken, words = Counter(), Counter()
    for r in out:
        said = r.text.split()
        assert len(said) <= SMALL.block
        taken[r["rank"]] += len(said)
        words.update(said)
    assert taken == Counter({k: i.words for k, i in info.items() if i.words})
    hot = {w for r in docs.collect() if r.doc_id in (3, None) for w in (r.text or "").split()}
    assert all(n <= SMALL.most for w, n in words.items() if w not in hot)
    # every epoch but the last holds each block once
    parts = mixed.groupBy("rank", "epoch", "block").agg(F.countDistinct("shard", "at").alias("n"))
    assert parts.where("n > 1").count() == 0
    for r in mixed.groupBy("rank", "epoch").agg(F.countDistinct("block").alias("n")).collect():
        assert r.n == info[r["rank"]].blocks or r.epoch == info[r["rank"]].epochs


def test_shards_are_drawn(spark):
    """Counts of a shard add up and vary about their expectation."""
    sources = source_mixing.targets(source_mixing.sizes(corpus(spark, 4)), SMALL)
    counts = source_mixing.draw(sources, SMALL).collect()
    whole = sum(r.slots for r in sources.collect())
    by_shard = Counter()
    for r in counts:
        by_shard[r.shard] += r.n
    assert sum(by_shard.values()) == whole and len(by_shard) == -(-whole // SMALL.shard)
    for s in sources.collect():
        drawn = [r.n for r in counts if r["rank"] == s["rank"]]
        p = s.slots / whole
        assert abs(sum(drawn) - s.slots) <= 5 * (whole * p * (1 - p)) ** 0.5 + 1
        assert s.slots < 200 or len(set(drawn)) > 1


def test_taken(spark):
    docs = corpus(spark)
    got = source_mixing.taken(docs, SMALL).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.taken <= SMALL.most * r.size for r in got)
    by_source = defaultdict(lambda: [0, 0])
    for r in got:
        by_source[r.target, r.source_size][0] += r.taken
    assert sum(v[0] for v in by_source.values()) == pytest.approx(sum(r.size for r in got), abs=9)
    again = source_mixing.taken(docs.repartition(5), SMALL).collect()
    assert Counter(again) == Counter(got)


def test_nothing_to_mix(spark):
    docs = corpus(spark)
    assert source_mixing.taken(docs.limit(0)).count() == 0
    empty = source_mixing.taken(docs.where("source = 'none'")).collect()
    assert len(empty) == 4 and all(tuple(r)[1:] == (0, 0, 0.0, 0) for r in empty)
