"""SimHash near-duplicates over a Gray-ordered hierarchical index.

Fingerprints: a Pandas-free Arrow map hashes the 4-word shingles of a whole
text (XXH64, seed 42) and takes the majority of each bit.

Links (at most ``max_bits`` differing bits, exact): with ``blocks`` bit blocks,
two linked fingerprints agree in at least ``blocks - max_bits`` of them, so
each fingerprint goes to one bucket per combination of so many blocks.  In a
bucket, fingerprints are sorted by Gray rank, so that neighbours differ in few
bits; runs of neighbours form leaves, runs of leaves form upper nodes, and each
node holds the bits that all below it share.  A pair of nodes is pruned when
the shared bits alone differ too often, and joined whole when even the bits
that are not shared cannot exceed the limit.  A bucket yields a spanning
forest, never all its pairs.  Buckets of more than ``chunk`` fingerprints are
cut into chunks, and pairs of chunks are separate tasks.

Components: the alternating large-star/small-star algorithm on DataFrames,
each round written to the shared checkpoint folder.

Defined results: a null or empty text has fingerprint zero and links like any
other; a text of fewer words than a shingle is one shingle; a null id never
becomes a component's id (null if no member has one); repeated rows give
repeated rows; an empty table gives an empty result; other columns are
ignored by ``components`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, written
from .graph import connected_components

SEED = 42
SHINGLES_AT_ONCE = 1 << 16
LEAF = 16
FANOUT = 8
PAIRS_AT_ONCE = 1 << 17


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    whole = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(w))
    starts, ends = starts[: len(w) - size + 1].tolist(), ends[size - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        h = np.array([digest(whole[a:b], SEED) for a, b in
                      zip(starts[k:k + SHINGLES_AT_ONCE], ends[k:k + SHINGLES_AT_ONCE])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle: int = 4) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp holds the 64 bits."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])

    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(rows, f"doc_id {kind}, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each word in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class Forest:
    """Disjoint sets over 0..n-1, joined by arrays of pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                return
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (up := self.root[self.root]).tolist() != self.root.tolist():
                self.root = up


def _levels(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the leaves up: (shared-bit mask, shared bits) of each node."""
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    cuts = np.arange(0, len(x), LEAF)
    ones, any_ = np.bitwise_and.reduceat(x, cuts), np.bitwise_or.reduceat(x, cuts)
    out = [(ones | (any_ ^ every), ones)]
    while len(ones) > 1:
        cuts = np.arange(0, len(ones), FANOUT)
        ones, any_ = np.bitwise_and.reduceat(ones, cuts), np.bitwise_or.reduceat(any_, cuts)
        out.append((ones | (any_ ^ every), ones))
    return out


def link_bucket(x: np.ndarray, max_bits: int) -> Forest:
    """Joins the fingerprints ``x`` (sorted by Gray rank) that differ in at
    most ``max_bits`` bits."""
    forest, levels = Forest(len(x)), _levels(x)
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        mask, bits = levels[level]
        both = mask[a] & mask[b]
        apart = np.bitwise_count((bits[a] ^ bits[b]) & both)
        near = apart <= max_bits
        a, b, both, apart = a[near], b[near], both[near], apart[near]
        whole = apart + np.bitwise_count(~both) <= max_bits
        width = LEAF * FANOUT ** level
        if whole.any():   # every member of a links with every member of b
            for p, q in zip(a[whole].tolist(), b[whole].tolist()):
                for r in {p, q}:
                    members = np.arange(r * width, min(len(x), (r + 1) * width))
                    forest.join(members, np.full(len(members), p * width))
        a, b = a[~whole], b[~whole]
        if not len(a):
            continue
        n, kids = (len(levels[level - 1][0]), FANOUT) if level else (len(x), LEAF)
        i, j = (v.ravel() for v in np.meshgrid(np.arange(kids), np.arange(kids), indexing="ij"))
        for s in range(0, len(a), max(1, PAIRS_AT_ONCE // len(i))):
            e = s + max(1, PAIRS_AT_ONCE // len(i))
            p = (a[s:e, None] * kids + i).ravel()
            q = (b[s:e, None] * kids + j).ravel()
            ok = (p <= q) & (q < n) if level else (p < q) & (q < n)
            p, q = p[ok], q[ok]
            if level:
                if len(p):
                    stack.append((level - 1, p, q))
            else:
                hit = np.bitwise_count(x[p] ^ x[q]) <= max_bits
                forest.join(p[hit], q[hit])
    return forest


def _bucket_links(max_bits: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Input sorted by bucket: buckets are cut out of the batch stream."""
        kept_key, kept_fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            key = np.concatenate((kept_key, b.column(0).to_numpy()))
            fp = np.concatenate((kept_fp, b.column(1).to_numpy().view(np.uint64)))
            if not len(key):
                continue
            last = len(key) - int(np.argmin((key == key[-1])[::-1])) if key[0] != key[-1] else 0
            yield from linked(key[:last], fp[:last])
            kept_key, kept_fp = key[last:], fp[last:]
        yield from linked(kept_key, kept_fp)

    def linked(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key) < 2:
            return
        order = np.lexsort((gray_rank(fp), key))
        key, fp = key[order], fp[order]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        left, right = [], []
        small = np.repeat(sizes <= LEAF, sizes)   # a bucket that is one leaf
        for d in range(1, LEAF):
            near = (small[d:] & (key[d:] == key[:-d])
                    & (np.bitwise_count(fp[d:] ^ fp[:-d]) <= max_bits))
            left.append(fp[d:][near])
            right.append(fp[:-d][near])
        for s, n in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist()):
            x = fp[s:s + n]
            root = link_bucket(x, max_bits).root
            moved = root != np.arange(n)
            left.append(x[moved])
            right.append(x[root[moved]])
        a, b = np.concatenate(left), np.concatenate(right)
        for s in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[s:s + (1 << 16)].view(np.int64)) for v in (a, b)], names=["a", "b"])

    return rows


def links(fps: DataFrame, max_bits: int = 4, blocks: int = 6, chunk: int = 20_000) -> DataFrame:
    """(a, b): enough links between the distinct values ``fp`` of ``fps`` to
    connect all that are linked; at most one per value and bucket."""
    edges_of = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << edges_of[i + 1]) - (1 << edges_of[i])) for i in c)
             for c in combinations(range(blocks), blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("no", "part")
    ).select(F.xxhash64("no", "part").alias("k"), "fp")
    hot = (keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > chunk)
           .select("k", F.ceil(F.col("n") / chunk).cast("int").alias("parts")))
    cut = keyed.join(hot, "k", "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1),
                         lambda o: F.xxhash64(F.col("k"), F.least(o, mine), F.greatest(o, mine)))
    dealt = cut.select(F.explode(F.when(F.col("parts").isNull(), F.array("k"))
                                 .otherwise(others)).alias("k"), "fp")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "k").sortWithinPartitions("k")
            .mapInArrow(_bucket_links(max_bits), "a long, b long").distinct())


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (the smallest id
    that can be reached over links)."""
    all_fps = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    fps = all_fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(fps.select("fp"), max_bits))
    placed = (fps.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.select("fp", "root").join(least, "root").select("fp", "component_id")
    return all_fps.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id and then of
    the least row key; rows without an id stay.  Same columns."""
    key, named = fresh(docs, "_key"), fresh(docs, "_named")
    keyed = docs.withColumn(key, row_key(docs))
    name = F.struct(F.col(f"`{doc_id}`").isNull().alias("unnamed"), F.col(f"`{doc_id}`").alias("id"),
                    F.col(key).alias("key"))
    found = components(keyed.withColumn(named, name), named, text, shingle, max_bits)
    keep = (found.where(~F.col("component_id.unnamed"))
            .select(F.col("component_id.key").alias(key)).distinct())
    one = keyed.join(keep, key, "left_semi").dropDuplicates([key])
    return one.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(
        docs.where(F.col(f"`{doc_id}`").isNull()))
