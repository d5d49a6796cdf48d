"""Packing: word-wise ids against the tokenizer on random Unicode, tokenizers that
are refused, and groups of equal rows."""

import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
CLOSING = ".,;:!?*%#&$|"


def ids_of(texts):
    known = packing.WordIds(PATH, " \n")
    return [x.tolist() for x in known.of(texts)]


def test_letters_that_lower_case_adds_marks_to():
    plain = Tokenizer.from_file(PATH)
    texts = [f"{a}İ{b}{c}{d}" for a in ("", "x", "B") for b in ("", "L", "́") for c in CLOSING for d in ("", " VE", "#")]
    texts += ["TÜRKİ.", "BİLGİ, VE", "<|endoftext|>.", "x<|ENDOFTEXT|>y!", "DON'T'S.", "ǅ.", "ﬁ.", "ẞ!", "Ω̈.", "ß.", "µ,"]
    assert ids_of(texts) == [e.ids for e in plain.encode_batch_fast(texts, add_special_tokens=False)]


def test_random_unicode():
    """Strings of letters, marks, digits and white space of many scripts."""
    plain, rng = Tokenizer.from_file(PATH), random.Random(11)
    blocks = [(0x20, 0x7F), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x530), (0x590, 0x700), (0x900, 0x980),
              (0x1E00, 0x2000), (0x2000, 0x2070), (0x2100, 0x2150), (0x3040, 0x3100), (0x1F300, 0x1F320)]
    pool = [chr(c) for lo, hi in blocks for c in range(lo, hi)] + list("İıſK") * 9 + [" ", "\n", "\t"] * 30 + list(CLOSING) * 9
    for _ in range(10):
        texts = ["".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(20_000)]
        want = plain.encode_batch_fast(texts, add_special_tokens=False)
        for t, a, b in zip(texts, ids_of(texts), want):
            assert a == b.ids, repr(t)


def test_a_word_is_looked_up_once_for_many_texts():
    """The different words of a batch are looked up, not each word of each text;
    texts come back whole, also from the middle of an Arrow column."""
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    known = packing.WordIds(PATH, " \n")
    known.known = Counted(known.known)
    texts = ["", "Few words, again\nand  again! " * 500, " ", "again", "Other words."] * 4
    plain = [e.ids for e in Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in known.of(texts)] == plain
    assert known.known.asked < 100
    assert [x.tolist() for x in known.of(pa.array(texts).slice(3, 9))] == plain[3:12]
    assert list(known.of([])) == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="word by word"):
        packing.WordIds(public_tokenizers.path("byte_bpe_50k.json"), " \n")


def test_equal_rows_are_spread(spark):
    """Equal rows, also with null ids, go to many groups, and all come back."""
    rows = [(7, "the same words again " * 40)] * 900 + [(None, "no id " * 30)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    how = packing.Packing(tokenizer=PATH, group_chars=20_000)
    out = packing.pack(docs, how).collect()
    groups = Counter(r.sequence_id >> 32 for r in out)
    assert len(groups) >= 20 and max(groups.values()) < len(out) / 8
    whole = Counter()
    for r in out:
        whole[r.doc_id] += r.length
    per = {r.doc_id: r.doc_tokens for r in out}
    assert whole == {7: 900 * per[7], None: 300 * per[None]}
    again = packing.pack(docs, how).collect()
    assert Counter(map(str, again)) == Counter(map(str, out))
