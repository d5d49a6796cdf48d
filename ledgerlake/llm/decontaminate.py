"""Benchmark decontamination by size-partitioned MinHash containment search
(DataFrame operations only).

An item is contained in a document if the document holds at least
``threshold`` per cent of the item's distinct word shingles, wherever they
stand.  Documents are far larger than items, so resemblance says nothing;
what counts is the share of the *item*.

Search: items are partitioned by size (powers of two).  Each item is reduced
to its MinHash sketch, the shingles with the least hashes, as many as the
partition's upper size needs: of ``q`` shingles at least ``threshold`` per cent
must be present, so at most ``q - ceil(threshold * q)`` can miss, and one more
than that cannot all miss.  A document that holds none of an item's sketch
cannot contain it; the others are candidates (no false negatives).

Verification: candidates are held against the item's whole shingle set by
64-bit hashes.

Scale: a bitmap of the sketches' shingles alone goes to the tasks, 256 bits for
each of them while it stays under ``2 ** max_bitmap_bits`` bits.  Documents are
scanned, never shuffled; the few shingles it lets through are written and met with
the sketches by an equi-join.  The documents of candidate pairs are then read
again (a bitmap of their keys tells them), and only these are held against whole
items.  A benchmark with too many sketches for a bitmap is searched by the
equi-join alone.  A passage that a third of the documents hold is a skewed
equi-join, which AQE splits; equal items are searched once.

Defined results: a null or empty text holds no shingle, and neither does a
text of fewer words than a shingle; such items are never found and such
documents never hit.  Equal item texts are one class, named by the smallest
id; repeated document rows are reported once; empty tables give an empty
result; further columns are ignored by ``contained`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, row_key, text_or_empty, written

#: Words are runs of letters and digits.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Containment:
    shingle: int = 5          # words
    threshold: int = 80       # per cent of the item's shingles
    max_bitmap_bits: int = 27 # log2 of the bits of the sketches' bitmap
    key_bits: int = 21        # the same of the candidate documents' bitmap


def shingles(text: Column, size: int) -> tuple[Column, Column]:
    """Two steps, to be added as columns one after the other: the words of a
    text, and a function from the words' column to the distinct hashes."""
    w = F.array_remove(F.split(F.lower(text), BETWEEN_WORDS), "")

    def hashes(w: str) -> Column:
        return F.when(F.size(w) >= size, F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(w) - (size - 1)),
            lambda i: F.xxhash64(F.slice(F.col(w), i, size)))))

    return w, hashes


def item_shingles(items: DataFrame, item_id: str, text: str, how: Containment) -> DataFrame:
    """(item_id, h, q, sketch): the distinct shingles of each class of items."""
    w, hashes = shingles(text_or_empty(F.col(f"`{text}`")), how.shingle)
    sets = (items.select(F.col(f"`{item_id}`").alias("item_id"), w.alias("w"))
            .withColumn("hs", hashes("w")).where(F.col("hs").isNotNull())
            .select("item_id", F.sort_array("hs").alias("hs")))
    sets = sets.groupBy("hs").agg(F.min("item_id").alias("item_id"))
    q = F.size("hs")
    upper = F.pow(F.lit(2), F.ceil(F.log2(q))).cast("long")       # of the size partition
    kept = F.expr(f"({100 - how.threshold} * upper) div 100 + 1")
    return (sets.withColumns({"q": q.cast("long"), "upper": upper})
            .withColumn("kept", kept)
            .select("item_id", "q", "kept", F.posexplode("hs").alias("rank", "h"))
            .select("item_id", "h", "q", (F.col("rank") < F.col("kept")).alias("sketch")))


def bitmap(hashes: DataFrame, col: str, bits: int) -> DataFrame:
    """One row with one array<bigint> of ``2 ** bits`` bits: bit
    ``col mod 2 ** bits`` is set for each row."""
    place = F.col(col).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    filled = (hashes.select(F.shiftright(place, 6).alias("id"),
                            F.expr("1L").alias("one"), place.bitwiseAND(F.lit(63)).cast("int").alias("s"))
              .select("id", F.call_function("shiftleft", F.col("one"), F.col("s")).alias("bit"))
              .groupBy("id").agg(F.bit_or("bit").alias("word")))
    all_words = hashes.sparkSession.range(1 << (bits - 6)).join(filled, "id", "left")
    return all_words.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word")))),
        lambda x: x["word"]).alias("bits"))


def is_set(bits: Column, h: Column, n: int) -> Column:
    place = h.bitwiseAND(F.lit((1 << n) - 1).cast("long"))
    word = F.get(bits, F.shiftright(place, 6).cast("int"))
    return F.call_function("bit_get", word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def candidates(docs: DataFrame, grams: DataFrame, text: str, how: Containment) -> DataFrame:
    """Pairs (k, item_id) of a document's row key and an item whose sketch it meets."""
    sketch = grams.where("sketch").select("item_id", "h")
    n = sketch.select("h").distinct().count()
    bits = min(how.max_bitmap_bits, max(16, (256 * max(n, 1) - 1).bit_length()))
    w, hashes = shingles(text_or_empty(F.col(f"`{text}`")), how.shingle)
    hits = (docs.select(row_key(docs).alias("k"), w.alias("w")).withColumn("hs", hashes("w"))
            .select("k", F.explode_outer("hs").alias("h")).where(F.col("h").isNotNull()))
    if 16 * n <= 1 << bits:
        hits = hits.where(is_set(bitmap(sketch, "h", bits).scalar(), F.col("h"), bits))
    hits = written(hits, "item-hits")
    return written(hits.join(sketch, "h").select("k", "item_id").distinct(), "item-candidates")


def _contained(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str,
               how: Containment, carry: list[Column]) -> DataFrame:
    grams = written(item_shingles(items, item_id, item_text, how), "item-shingles")
    pairs = candidates(docs, grams, text, how)
    # the candidate documents again, with all their shingles
    w, hashes = shingles(F.col("t"), how.shingle)
    wanted = bitmap(pairs, "k", how.key_bits).scalar()
    held = (docs.select(*carry, row_key(docs).alias("k"), text_or_empty(F.col(f"`{text}`")).alias("t"))
            .where(is_set(wanted, F.col("k"), how.key_bits))
            .select("doc_id", "k", w.alias("w")).withColumn("hs", hashes("w")).select("doc_id", "k", "hs"))
    held = held.join(pairs.select("k").distinct(), "k", "left_semi").dropDuplicates(["k"])
    whole = grams.groupBy("item_id", "q").agg(F.collect_list("h").alias("item"))
    found = pairs.join(held, "k").join(whole, "item_id").select(
        "k", "doc_id", "item_id", "q", F.size(F.array_intersect("hs", "item")).cast("long").alias("n"))
    return found.where(100 * F.col("n") >= how.threshold * F.col("q"))


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text",
              how: Containment = Containment()) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found) of each contained item class."""
    found = _contained(docs, items, text, item_id, item_text, how,
                       [F.col(f"`{doc_id}`").alias("doc_id")])
    return found.select("doc_id", "item_id", F.col("q").alias("n_shingles"), F.col("n").alias("n_found"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  how: Containment = Containment()) -> DataFrame:
    """``docs`` without the rows that contain an item; same columns."""
    found = _contained(docs, items, text, item_id, item_text, how, [F.lit(None).cast("int").alias("doc_id")])
    key = fresh(docs, "_key")
    leaks = found.select(F.col("k").alias(key)).distinct()
    return docs.withColumn(key, row_key(docs)).join(leaks, key, "left_anti").select(*docs.columns)
