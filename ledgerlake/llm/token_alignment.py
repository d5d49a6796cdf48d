"""Cross-tokenizer alignment by lockstep vectorised merging.

Two tokenizers A and B cut the same bytes into tokens.  Where tokens of both end
at the same byte, the text is cut into groups; all A and B tokens of a group are
linked.  The operator returns each document's groups and its linked pairs of
ids, and counts over the corpus in how many documents a pair is linked.

Neither tokenizer's tokens reach over a space behind a word (checked in the
vocabularies; else whole texts are encoded), so texts are encoded in parts between
such spaces, each new part once.

Method.  The token ends of all documents of a batch lie in two flat arrays.  A
state vector holds a pointer into A and one into B for each lane; a lane is a
document or, for a long one, the part between two of its A tokens (the B token
it starts in is found by binary search, which is the state a walk from the start
of the document would have there).  Each step emits one link per lane, the two
tokens pointed at, and a cut where both end at the same byte; moves on the
pointer of the token that ends first, or both at a cut; and compacts the vector
when lanes have ended.  The links emitted are the pairs that overlap: in a group
with one token on a side these are all pairs; the other groups are filled up.

Corpus-wide: the batch result is written once, one row per document with its
distinct pairs.  Pairs are counted with map-side combine.  The counts come back
to the documents in two ways: the pairs that most documents hold, at most
``broadcast_pairs`` of them by a threshold found from the counts, are sent to the
tasks; the others, none of which is hot then, by an equi-join.

Defined results: a null or empty text, and one whose tokens do not spell it byte
for byte under both tokenizers, has no tokens, groups and links; strings of
special tokens are plain text; a null id is kept; repeated rows are answered and
counted each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BATCH_BYTES = 1 << 21
ENCODED_AT_ONCE = 4096
KNOWN_PARTS, KNOWN_LENGTH = 400_000, 64
#: a space after a character that no library takes for white space
APART = re.compile("(?<=[^\\s\u180e\u200b\ufeff]) ")
LANE = 512                # A tokens of a lane
FULL_GROUP = 4096         # pairs of a group that are listed before they are counted


@dataclass(frozen=True)
class Tokenizers:
    a: str                          # path of a byte-level ``tokenizers`` JSON file
    b: str                          # path of a ``sentencepiece`` model that puts a space before the text
    broadcast_pairs: int = 500_000  # pairs whose counts are sent to the tasks, 16 bytes each


class Vocabularies:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, how: Tokenizers):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(how.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=how.b)
        # byte-level spelling: printable bytes are themselves, the n-th other
        # byte is the character 256 + n
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in set(plain)]
        byte = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(others)}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # how a group's ids are written: an A id goes on with a comma or ends
        # its side, a B id likewise or ends the text
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.said = [b"%d%s" % (i, end) for n, ends in ((na, (b",", b"|")), (nb, (b",", b";", b"")))
                     for end in ends for i in range(n)]
        self.b_from = 2 * na

        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.apart = self._splits_at_spaces()

    def _splits_at_spaces(self) -> bool:
        """Whether no token of A or B reaches over a space that follows a
        character other than white space."""
        how = json.loads(self.a.to_str())
        by_words = how["normalizer"] is None and how["pre_tokenizer"]["type"] == "ByteLevel" \
            and how["pre_tokenizer"].get("use_regex", True) and not how["pre_tokenizer"]["add_prefix_space"]
        return by_words and not any(" " in x.lstrip(b" ").decode(errors="replace") for x in self.bytes_b)

    def units(self, text: str) -> list[str]:
        """The text in parts that the tokenizers treat independently: each part
        but the first followed a space, which is left out."""
        if not self.apart:
            return [text]
        parts = APART.split(" " + text)
        parts[0] = parts[0][1:]
        if not parts[-1] and len(parts) > 1:      # a space at the end stays with the last part
            del parts[-1]
            parts[-1] += " "
        return parts

    def _learn(self, parts: list[str]) -> None:
        """Ids of both tokenizers, as bytes, of a space and each part; None if
        the tokens do not spell it."""
        for k in range(0, len(parts), ENCODED_AT_ONCE):
            some = parts[k:k + ENCODED_AT_ONCE]
            found_a = self.a.encode_batch_fast([" " + p for p in some], add_special_tokens=False)
            for p, x, y in zip(some, found_a, self.b.encode(some, num_threads=1)):
                whole, x = b" " + p.encode(), x.ids
                same = (b"".join([self.bytes_a[i] for i in x]) == whole
                        and b"".join([self.bytes_b[i] for i in y]) == whole)
                self.known[p] = (array("i", x).tobytes(), array("i", y).tobytes()) if same else None

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text, both empty where they do not spell it.
        Each new part is encoded once; those seen first stay known, up to a bound."""
        split = [self.units(t) if t else [] for t in texts]
        new = list(set().union(*split) - self.known.keys())
        self._learn(new)
        known, out, none = self.known, [], np.empty(0, np.int32)
        for parts in split:
            ids = [known[p] for p in parts]
            if not parts or None in ids:
                out.append((none, none))
            else:
                out.append((np.frombuffer(b"".join([x for x, _ in ids]), np.int32),
                            np.frombuffer(b"".join([y for _, y in ids]), np.int32)))
        room = KNOWN_PARTS - (len(known) - len(new))
        for k, p in enumerate(new):
            if k >= room or len(p) > KNOWN_LENGTH:
                del known[p]
        return out


def vocabularies(how: Tokenizers) -> Vocabularies:
    """One for all tasks of a Python worker."""
    held = sys.modules.setdefault("_vocabularies_of_this_worker",
                                  types.ModuleType("_vocabularies_of_this_worker")).__dict__
    key = f"{how.a} {how.b}"
    if key not in held:
        held[key] = Vocabularies(how)
    return held[key]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, lanes: np.ndarray, stops: np.ndarray,
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (last A token, last B token), each in
    the order of the text.

    ``ends_a`` and ``ends_b`` rise over the whole batch, and every document ends
    at an end of both; lane k covers the A tokens ``lanes[k] .. stops[k] - 1``."""
    before = np.where(lanes > 0, ends_a[lanes - 1], 0) if len(lanes) else lanes
    at_a, at_b = lanes.copy(), np.searchsorted(ends_b, before, "right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(at_a):
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        links_a.append(at_a)
        links_b.append(at_b)
        cut = end_a == end_b
        cuts_a.append(at_a[cut])
        cuts_b.append(at_b[cut])
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        going = at_a < stops
        if not going.all():
            at_a, at_b, stops = at_a[going], at_b[going], stops[going]

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    la, lb = joined(links_a), joined(links_b)
    order = np.argsort(la + lb)      # each link has one place on the way
    return la[order], lb[order], np.sort(joined(cuts_a)), np.sort(joined(cuts_b))


def lanes_of(counts: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """From and to of the lanes, from the documents' numbers of A tokens."""
    first = np.concatenate(([0], np.cumsum(counts)))
    per = -(-counts // lane)
    doc = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    begin = first[doc] + nth * lane
    return begin, np.minimum(begin + lane, first[doc + 1])


def _linked(ids_a: np.ndarray, ids_b: np.ndarray, links: tuple[np.ndarray, np.ndarray],
            cuts: tuple[np.ndarray, np.ndarray], doc_a: np.ndarray, wide: int,
            ) -> tuple[np.ndarray, np.ndarray]:
    """(document * span + A id * wide + B id, number of links), sorted and
    distinct, where span = ids of A * wide."""
    cut_a, cut_b = cuts
    from_a, from_b = np.append(0, cut_a[:-1] + 1), np.append(0, cut_b[:-1] + 1)
    size_a, size_b = cut_a - from_a + 1, cut_b - from_b + 1
    simple = (size_a == 1) | (size_b == 1)
    span = (int(ids_a.max(initial=0)) + 1) * wide
    group = np.repeat(np.arange(len(cut_a)), size_a)      # of each A token
    la, lb = links
    keep = simple[group[la]]
    la, lb = la[keep], lb[keep]
    # the other groups: all pairs, by arithmetic
    rest = np.flatnonzero(~simple & (size_a * size_b <= FULL_GROUP))
    n = size_a[rest] * size_b[rest]
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    each = np.repeat(rest, n)
    la = np.concatenate((la, from_a[each] + nth // size_b[each]))
    lb = np.concatenate((lb, from_b[each] + nth % size_b[each]))
    keys = doc_a[la] * span + ids_a[la].astype(np.int64) * wide + ids_b[lb]
    keys, times = np.unique(keys, return_counts=True)
    for g in np.flatnonzero(~simple & (size_a * size_b > FULL_GROUP)):   # few, and long: ids first
        x, nx = np.unique(ids_a[from_a[g]:cut_a[g] + 1], return_counts=True)
        y, ny = np.unique(ids_b[from_b[g]:cut_b[g] + 1], return_counts=True)
        more = (doc_a[from_a[g]] * span + x.astype(np.int64)[:, None] * wide + y[None, :]).ravel()
        keys, place = np.unique(np.concatenate((keys, more)), return_inverse=True)
        times = np.bincount(place, np.concatenate((times, (nx[:, None] * ny[None, :]).ravel()))).astype(np.int64)
    return keys, times


def align_batch(texts: list[str | None], v: Vocabularies, with_groups: bool = False) -> dict[str, pa.Array]:
    """The columns of ``align`` but for the id and the key."""
    rows = v.encode([t or "" for t in texts])
    count_a = np.array([len(x) for x, _ in rows], np.int64)
    count_b = np.array([len(y) for _, y in rows], np.int64)
    ids_a, ids_b = (np.concatenate([r[k] for r in rows]) if rows else np.empty(0, np.int32) for k in (0, 1))
    wide, docs = len(v.bytes_b), np.arange(len(texts))
    doc_a = np.repeat(docs, count_a)
    la, lb, cut_a, cut_b = lockstep(np.cumsum(v.length_a[ids_a]), np.cumsum(v.length_b[ids_b]), *lanes_of(count_a))
    size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    doc_g = doc_a[cut_a]
    keys, times = (_linked(ids_a, ids_b, (la, lb), (cut_a, cut_b), doc_a, wide)
                   if len(ids_a) else (np.empty(0, np.int64),) * 2)
    span = (int(ids_a.max(initial=0)) + 1) * wide
    code = keys % span
    pairs = (code // wide << 32) | code % wide
    ends = np.searchsorted(keys, (docs + 1) * span)
    offsets = pa.array(np.append(0, ends), pa.int32())

    # the groups as text: A tokens of a group, then its B tokens
    n_a, n_b = np.arange(len(ids_a)), np.arange(len(ids_b))
    group_a, group_b = np.repeat(np.arange(len(cut_a)), size_a), np.repeat(np.arange(len(cut_b)), size_b)
    said = np.empty(len(ids_a) + len(ids_b), np.int64)
    b_before, a_before = np.append(0, cut_b + 1), cut_a + 1
    said[n_a + b_before[group_a]] = ids_a + np.isin(n_a, cut_a, assume_unique=True) * len(v.bytes_a)
    last_b = np.cumsum(count_b)[count_b > 0] - 1
    how_b = np.zeros(len(ids_b), np.int64)
    how_b[cut_b] = 1
    how_b[last_b] = 2
    said[n_b + a_before[group_b]] = v.b_from + ids_b + how_b * wide
    words = v.said
    groups, at, said = [], 0, said.tolist()
    for n in (count_a + count_b).tolist():
        groups.append(b"".join([words[i] for i in said[at:at + n]]))
        at += n
    out = {
        "n_a": pa.array(count_a), "n_b": pa.array(count_b),
        "n_groups": pa.array(np.bincount(doc_g, minlength=len(texts))),
        "n_links": pa.array(np.bincount(doc_g, size_a * size_b, minlength=len(texts)).astype(np.int64)),
        "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups]),
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(pairs, pa.int64())),
        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))}
    if with_groups:
        out["groups"] = pa.array([g.decode() for g in groups], pa.string())
    return out


def align(docs: DataFrame, how: Tokenizers, doc_id: str = "doc_id", text: str = "text",
          with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: k (unique in one run), doc_id, n_a, n_b,
    n_groups, n_links, groups_sha256, pairs (A id * 2^32 + B id, distinct),
    times (links of each pair) and, on demand, groups (``a1,a2|b1;a3|b2``)."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(how)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy())
            at = 0
            while at < len(b):       # a few megabytes of text, or one document
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + BATCH_BYTES, "right")))
                some = b.slice(at, to - at)
                out = align_batch(some.column(1).to_pylist(), v, with_groups)
                keys = pa.array(np.arange(row, row + len(some)))
                yield pa.RecordBatch.from_arrays([keys, some.column(0), *out.values()], names=["k", "doc_id", *out])
                row, at = row + len(some), to

    more = ", groups string" if with_groups else ""
    return given.mapInArrow(aligned, f"k bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, "
                            f"n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>{more}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, n, best): in how many documents each pair of ids is linked, and
    whether no other pair of its A id is linked in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    # an A id has at most as many pairs as B has ids
    top = F.max("n").over(Window.partitionBy("a"))
    return counts.select("pair", "a", "n", (F.col("n") == top).alias("best"))


def _hot_level(counts: DataFrame, most: int) -> int:
    """The least level (log2 of the count) from which on there are at most
    ``most`` pairs."""
    found = counts.groupBy(F.floor(F.log2("n")).alias("level")).count().collect()     # 63 rows at most
    level, total = 64, 0
    for r in sorted(found, key=lambda r: -r["level"]):
        total += r["count"]
        if total > most:
            break
        level = r["level"]
    return level


def corpus_links(docs: DataFrame, how: Tokenizers, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose pair is a best one of its A id), count_sum (the pairs' numbers
    of documents, over links), groups_sha256."""
    aligned = written(align(docs, how, doc_id, text), "aligned")
    counts = written(pair_counts(aligned), "pair-counts")
    level = _hot_level(counts, how.broadcast_pairs)
    is_hot = F.floor(F.log2("n")) >= level
    told = F.struct("n", "best")
    hot = F.broadcast(counts.where(is_hot).select("pair", told.alias("told")))
    links = aligned.select("k", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "k", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    met = links.join(hot, "pair", "left")

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("k").agg(
            F.sum(F.when(F.col("told.best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
            F.sum(F.col("times") * F.col("told.n")).alias("count_sum"))

    sums = summed(met.where(F.col("told").isNotNull()))
    if not counts.where(~is_hot).isEmpty():
        cold = counts.where(~is_hot).select("pair", told.alias("told"))
        sums = sums.unionByName(summed(met.where(F.col("told").isNull()).drop("told").join(cold, "pair")))
        sums = sums.groupBy("k").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return (aligned.drop("pairs", "times").join(sums, "k", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                    F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256"))
