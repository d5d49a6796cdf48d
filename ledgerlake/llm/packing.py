"""Sequence packing: first-fit decreasing in randomised groups of documents.

Texts are tokenised once, inside tasks.  A document's ids are cut into full
sequences plus one rest; pieces are dealt to groups by a hash of their content,
their partition and how many equal ones the partition had before, so a group is
a random sample of all pieces and of bounded size, also if a third of all rows
are equal.  (Equal pieces are interchangeable: a repeated task deals out the same.)
Within a group, rests are packed longest first into the first bin that still
has room; a tournament tree over the bins' free room finds it in
O(log bins).  Bins that stay clearly under-filled are opened again: their
tokens are laid end to end and cut at the sequence length, and what is left
after that is cut at powers of two, which need no padding.

Scale: only token ids are shuffled (two or four bytes each), each once.  The
number of groups follows the corpus, so a group's tokens fit a task at every
size; a very long document spreads over many groups.

Defined results: a null or empty text is the end id alone; a null id is kept;
repeated rows are packed each; ties in length go by id, then start; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import sys
import types
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

CACHED_WORDS = 1_000_000
CACHED_LENGTH = 64
ENCODED_AT_ONCE = 4096
BATCH_CHARS = 1 << 22
CLOSING = ".,;:!?*%#&$|"


@dataclass(frozen=True)
class Packing:
    tokenizer: str                 # path of a ``tokenizers`` JSON file
    length: int = 4096             # tokens of a full sequence
    end_id: int = 2                # follows each document
    group_chars: int = 6_000_000   # mean characters of text per group
    open_below: float = 0.985      # bins filled less are opened and cut anew
    #: white space that the tokenizer drops, whatever stands beside it
    gaps: str = " \n"


class WordIds:
    """Ids of words (stretches without gaps), as little-endian bytes.

    The tokenizer sees each new word once, without its closing marks; the words
    seen first, among them the frequent ones, stay remembered up to a bound."""

    def __init__(self, path: str, gaps: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.gaps = Tokenizer.from_file(path), gaps
        expect_words(self.tokenizer, gaps)
        self.known: dict[str, bytes] = {"": b""}
        #: byte-level spelling: printable bytes are themselves, the n-th other
        #: byte is the character 256 + n
        others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        spell = {b: chr(256 + others.index(b)) if b in others else chr(b) for b in range(256)}
        self.spelled = {c: "".join(spell[b] for b in chr(c).encode()) for c in range(256)}

    def learn(self, words: list[str]) -> None:
        """Words of plain letters go to the BPE model as they are: nothing but
        lower case and the spelling of bytes stands between."""
        model, spelled, other = self.tokenizer.model, self.spelled, []
        for w in words:
            if w.isalpha() and max(w) <= "\xff":
                self.known[w] = array("I", [t.id for t in model.tokenize(w.lower().translate(spelled))]).tobytes()
            else:
                other.append(w)
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self.known[w] = array("I", e.ids).tobytes()

    def of(self, texts: list[str] | pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text.  Arrow splits the texts and numbers their
        different words; only these are looked up, and spread out again."""
        texts = pa.array(texts, pa.string())
        for g in self.gaps[1:]:
            texts = pc.replace_substring(texts, g, self.gaps[0])
        split = pc.split_pattern(texts, self.gaps[0])
        coded = split.flatten().dictionary_encode()
        words, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        found = [known.get(w) for w in words]
        new = [k for k, ids in enumerate(found) if ids is None]
        halves = [self.halves(words[k]) for k in new]
        parts = list({p for pair in halves for p in pair if p not in known})
        for k in range(0, len(parts), ENCODED_AT_ONCE):
            self.learn(parts[k:k + ENCODED_AT_ONCE])
        for k, (head, tail) in zip(new, halves):
            found[k] = known[words[k]] = known[head] + known[tail] if tail else known[head]
        self.forget(dict.fromkeys([words[k] for k in new] + parts))
        each = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        codes = coded.indices.to_numpy()
        sizes = each[codes]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        # of each word: where its ids stand in the pool, less where they go
        shift = (np.cumsum(each) - each)[codes] - ends[:-1]
        ids = pool[np.repeat(shift, sizes) + np.arange(ends[-1])]
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for at, end in zip(bounds[:-1], bounds[1:]):
            yield ids[at:end]

    def forget(self, added: Iterable[str]) -> None:
        """Keeps of the words just added what there is room for."""
        added = list(added)
        room = max(0, CACHED_WORDS - (len(self.known) - len(added)))
        for k, w in enumerate(added):
            if k >= room or len(w) > CACHED_LENGTH:
                del self.known[w]

    @staticmethod
    def halves(word: str) -> tuple[str, str]:
        """A word without its closing marks, and these: the tokenizer never
        joins such a mark with an ASCII letter or digit, or with a Latin letter
        that is lower case already, and ignores ASCII case.  Other words stay
        whole: lower case may add marks to a letter (U+0130) that then join
        what follows."""
        head = word.rstrip(CLOSING)
        last = head[-1:]
        if not (last.isascii() and last.isalnum() or "" < last <= "\u024f" and last.isalpha() and last.lower() == last):
            return word, ""
        return head.lower() if head.isascii() and "<|" not in head else head, word[len(head):]


def expect_words(tokenizer, gaps: str) -> None:
    """Refuses a tokenizer whose pipeline is not the one ``WordIds`` relies on:
    canonical composition, white space to a space, lower case; words apart at
    white space, which is dropped, letters apart from marks; bytes spelled out."""
    how = json.loads(tokenizer.to_str())
    steps = how["normalizer"]["normalizers"] if (how["normalizer"] or {}).get("type") == "Sequence" else []
    cuts = (how["pre_tokenizer"] or {}).get("pretokenizers", [])
    fits = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
            and cuts[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
            and how["model"]["type"] == "BPE" and not how["model"]["dropout"]
            and not any(t["lstrip"] or t["rstrip"] or any(g in t["content"] for g in gaps)
                        for t in how["added_tokens"]))
    if not fits:
        raise ValueError("this tokenizer does not work word by word")


def word_ids(path: str, gaps: str) -> WordIds:
    """One ``WordIds`` for all tasks of a Python worker."""
    held = sys.modules.setdefault("_words_of_this_worker", types.ModuleType("_words_of_this_worker")).__dict__
    key = f"{path} {gaps!r}"
    if key not in held:
        held[key] = WordIds(path, gaps)
    return held[key]


def id_type(how: Packing) -> str:
    """The narrowest type for the ids that are shuffled."""
    from tokenizers import Tokenizer
    most = max(Tokenizer.from_file(how.tokenizer).get_vocab_size() - 1, how.end_id)
    return "<u2" if most < 1 << 16 else "<u4"


class Tournament:
    """A complete binary tree of free room; each node holds its children's
    maximum, so the first bin with enough room is found by one descent."""

    def __init__(self, bins: int, room: int):
        self.size = 1 << max(0, (bins - 1).bit_length())
        self.best = [room] * (2 * self.size)

    def first_with(self, need: int) -> int:
        k, best = 1, self.best
        while k < self.size:
            k *= 2
            if best[k] < need:
                k += 1
        return k - self.size

    def take(self, bin_: int, amount: int) -> None:
        k, best = bin_ + self.size, self.best
        best[k] -= amount
        while k > 1:
            k //= 2
            top = max(best[2 * k], best[2 * k + 1])
            if best[k] == top:
                return
            best[k] = top


def first_fit_decreasing(lengths: list[int], room: int) -> list[int]:
    """The bin of each length; no length exceeds ``room``."""
    tree, out = Tournament(max(1, len(lengths)), room), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        out[i] = tree.first_with(lengths[i])
        tree.take(out[i], lengths[i])
    return out


def powers(n: int) -> list[int]:
    """n as descending powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def lay_out(lengths: list[int], length: int, open_below: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces of a group as (item, from, to, sequence, offset); an item may be
    cut in several.  Sequences are numbered from 0 without gaps."""
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(first_fit_decreasing(lengths, length)):
        bins.setdefault(b, []).append(i)
    out, opened, sequence = [], [], 0
    for b in sorted(bins):
        used = sum(lengths[i] for i in bins[b])
        if used < open_below * length and used & (used - 1):
            opened += bins[b]
            continue
        offset = 0
        for i in bins[b]:
            out.append((i, 0, lengths[i], sequence, offset))
            offset += lengths[i]
        sequence += 1
    total = sum(lengths[i] for i in opened)
    sizes = [length] * (total // length) + powers(total % length)
    left = offset = 0
    for i in opened:
        at = 0
        while at < lengths[i]:
            if not left:
                left, offset = sizes.pop(0), 0
                sequence += 1
            n = min(left, lengths[i] - at)
            out.append((i, at, at + n, sequence - 1, offset))
            at, offset, left = at + n, offset + n, left - n
    return out


def pack(docs: DataFrame, how: Packing, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset."""
    given = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(F.col(f"`{text}`")).alias("t"))
    kind = given.schema["doc_id"].dataType.simpleString()
    chars = given.agg(F.sum(F.length("t") + 1)).first()[0] or 0
    groups = max(1, -(-chars // how.group_chars))
    kept = id_type(how)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(how.tokenizer, how.gaps)
        end = np.array([how.end_id], "<u4")
        salt, before = TaskContext.get().partitionId(), Counter()
        for b in batches:
            at, names = 0, b.column(0).to_pylist()
            chars = np.cumsum(pc.utf8_length(b.column(1)).to_numpy(), dtype=np.int64)
            while at < len(b):       # a few megabytes of text at a time
                before_these = chars[at - 1] if at else 0
                upto = min(len(b), 1 + int(np.searchsorted(chars, before_these + BATCH_CHARS)))
                rows: list[list] = [[], [], [], [], []]
                for d, ids in zip(names[at:upto], known.of(b.column(1).slice(at, upto - at))):
                    ids = np.concatenate((ids, end))
                    for s in range(0, len(ids), how.length):
                        part = ids[s:s + how.length].astype(kept).tobytes()
                        own = zlib.crc32(part, zlib.crc32(f"{d}/{s}".encode()))
                        mark = zlib.crc32(f"{own}/{salt}/{before[own]}".encode())
                        before[own] += 1
                        for col, v in zip(rows, (d, s, part, len(ids), mark * 2654435761 % (1 << 32) % groups)):
                            col.append(v)
                at = upto
                yield batch(rows, b.schema.field(0).type)

    def batch(rows: list[list], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[0], kind), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()),
             pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())],
            names=["doc_id", "start", "part", "doc_tokens", "grp"])

    def packed(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("part", "ascending")])
        parts = group.column("part").to_pylist()
        first = group.column("start").to_numpy()
        lengths = [len(p) // np.dtype(kept).itemsize for p in parts]
        laid = lay_out(lengths, how.length, how.open_below)
        item = np.array([x[0] for x in laid], np.int64)
        ids = [np.frombuffer(parts[i], kept)[a:z].astype("<u4").tobytes()
               for i, a, z, _, _ in laid]
        return pa.table({
            "doc_id": group.column("doc_id").take(pa.array(item)),
            "start": pa.array(first[item] + np.array([x[1] for x in laid], np.int64)),
            "length": pa.array([x[2] - x[1] for x in laid], pa.int64()),
            "ids": pa.array(ids, pa.binary()),
            "doc_tokens": group.column("doc_tokens").take(pa.array(item)),
            "sequence_id": pa.array([(key[0].as_py() << 32) + x[3] for x in laid], pa.int64()),
            "offset": pa.array([x[4] for x in laid], pa.int64())})

    return (given.mapInArrow(pieces, f"doc_id {kind}, start long, part binary, doc_tokens long, grp long")
            .groupBy("grp")
            .applyInArrow(packed, f"doc_id {kind}, start long, length long, ids binary, "
                                  "doc_tokens long, sequence_id long, offset long"))


def with_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of ``ids``."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
