"""Line dedup by an exact set-similarity join (DataFrame operations only).

A line is the set of its lower-cased words.  A line goes if an earlier line
(smaller document id, then smaller line number) of the whole table has a
Jaccard similarity of at least ``threshold`` per cent; equal sets included.

1. Lines become sorted arrays of 64-bit word hashes, written once.
2. Words are counted over all lines in hash buckets (a fixed number of them),
   which gives every task the same order of words by rarity.  Any common order
   gives right results; a fine one keeps the lists of rare words short.
3. Equal sets are merged by an aggregation with map-side combine; the first
   line of a set speaks for it.
4. Two similar sets share one of their ``n - ceil(t * n) + 1`` rarest words
   (prefix filter); of the smaller one ``n - ceil(2 * t * n / (1 + t)) + 1`` are
   enough.  The equi-join on a word and a class of sizes also demands a fitting
   length, enough words after the shared one (positional filter), and bitmaps
   of word parity that differ in no more bits than the sets may.
5. What is left is verified on the whole sets.

A large family of variants of one line would still give all its pairs, so the
join runs in two rounds.  First each set is held against the earliest set with
the same key and like size only, and against the one with most lines, a key being
the two least or greatest hashes of its words; what is found there is decided.  A set needs one earlier
match, not all: the second round holds every undecided set against all earlier
ones, decided or not, and nothing against later ones, so no match is lost and a
family costs as many rows as it has members.

Defined results: a null or empty text has no lines; a line without a word is
never removed; lines at the same place of rows with the same id are ordered by
content, and equal rows are treated as one (alike); a null id comes first; an
empty table gives an empty result; further columns are ignored by
``repeated_lines`` and kept by ``deduplicate``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, discard, fresh, row_key, settle, text_or_empty, written
from .decontaminate import bitmap, is_set

RARITY_BITS = 16      # log2 of the number of word buckets, a byte each
MOST = 126            # the highest level
LOOKUP_BITS = 23      # log2 of the bits of the bitmaps of hashes to look up
LARGE = 90            # sets of more words have a second parity bitmap
PASSES = 3            # the words are joined in so many passes, to bound the shuffle


def _shl(value: Column, n: Column) -> Column:
    return F.call_function("shiftleft", value, n)


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Lines with a word: k (row key), doc_id, line_no, set_id, tk (hashes)."""
    given = docs.select(row_key(docs).alias("k"), F.col(f"`{doc_id}`").alias("doc_id"),
                        F.posexplode_outer(F.split(text_or_empty(F.col(f"`{text}`")), "\n"))
                        .alias("line_no", "line"))
    # few lines have white space other than spaces: splitting at one character is cheaper
    odd = F.lit(False)
    for c in "\t\r\v\f":
        odd = odd | F.contains("line", F.lit(c))
    low = F.lower("line")
    parts = F.when(odd, F.split(low, WORD_GAP)).otherwise(F.split(low, " "))
    hashes = F.array_distinct(F.transform(parts, lambda w: F.xxhash64(w)))
    tk = F.sort_array(F.array_remove(hashes, F.xxhash64(F.lit(""))))
    return (given.where(F.ltrim("line", F.lit(" \t\n\v\f\r")) != "")
            .select("k", "doc_id", "line_no", tk.alias("tk"))
            .withColumn("set_id", F.xxhash64("tk")))


def _rarity(lines: DataFrame) -> DataFrame:
    """One row, one array: the level (three steps for each doubling of its count)
    of each bucket of words, in the high byte of a long.  Put together as bytes in two
    steps, so that no task holds more than these and one stretch of them in rows."""
    buckets = 1 << RARITY_BITS
    counts = (lines.select(F.explode_outer("tk").alias("t"))
              .select(F.col("t").bitwiseAND(F.lit(buckets - 1)).alias("id"))
              .groupBy("id").agg(F.count(F.lit(1)).alias("n"))
              .select("id", F.least(F.floor(3 * F.log2("n")), F.lit(MOST)).cast("tinyint").alias("level")))
    every = (lines.sparkSession.range(buckets).join(counts, "id", "left")
             .select("id", F.coalesce("level", F.lit(0).cast("tinyint")).alias("level")))

    def together(df: DataFrame, order: str, value: str, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.transform(
            F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias("levels"))

    parts = together(every.withColumn("part", F.shiftright("id", RARITY_BITS // 2)), "id", "level", "part")
    return together(parts, "part", "levels").select(
        F.transform(F.flatten("levels"), lambda x: _shl(x.cast("long"), F.lit(56))).alias("levels"))


def _sets(lines: DataFrame, threshold: int) -> DataFrame:
    """Per distinct set: set_id, n, its first place ``at``, its number of
    ``lines``, parity bitmaps, its rarest words ``prefix`` in the common order and
    the ``keys`` it is led by.

    ``p1`` has the parity of the words by the low six bits of their hash;
    ``p2``, for large sets, that of the words with a negative hash alone."""
    levels = _rarity(lines).scalar()
    low, one, zero = (1 << 56) - 1, F.lit(1).cast("long"), F.lit(0).cast("long")

    def ranked(t: Column) -> Column:
        # [], unlike get, says that nothing is null: only such arrays are sorted as plain longs
        level = F.col("levels")[t.bitwiseAND(F.lit((1 << RARITY_BITS) - 1)).cast("int")]
        return level.bitwiseOR(t.bitwiseAND(F.lit(low)))

    def flip(a: Column, t: Column) -> Column:
        return a.bitwiseXOR(_shl(one, t.bitwiseAND(F.lit(63)).cast("int")))

    n = F.size("tk")
    like = F.floor(F.log(n.cast("double")) * 4).cast("int")
    keep = n - F.expr(f"({threshold} * size(tk) + 99) div 100").cast("int") + 1
    per_line = (lines.withColumn("levels", levels)
                .select("set_id", n.alias("n"), F.struct("doc_id", "line_no", "set_id").alias("at"),
                        F.struct(F.aggregate("tk", zero, flip).alias("p1"),
                                 F.when(n > LARGE, F.aggregate(F.filter("tk", lambda t: t < 0), zero, flip))
                                 .otherwise(zero).alias("p2"),
                                 F.slice(F.sort_array(F.transform("tk", ranked)), F.lit(1), keep)
                                 .alias("prefix"),
                                 # the two least and the two greatest word hashes, and the size
                                 F.array(F.xxhash64(F.get("tk", F.lit(0)), F.get("tk", F.lit(1)), like),
                                         F.xxhash64(F.get("tk", n - 1), F.get("tk", n - 2), like)).alias("keys"))
                        .alias("sketch")))
    first = per_line.groupBy("set_id", "n").agg(
        F.min("at").alias("at"), F.count(F.lit(1)).alias("lines"), F.first("sketch").alias("sketch"))
    return first.select("set_id", "n", "at", "lines", "sketch.p1", "sketch.p2", "sketch.prefix", "sketch.keys")


def _may_match(na: Column, nb: Column, threshold: int) -> Column:
    """Necessary conditions for sets a and b, from their sizes and bitmaps:
    no more parity bits differ than words may."""
    apart = (100 - threshold) * (na + nb)
    all_words = F.col("a.p1").bitwiseXOR(F.col("b.p1"))
    some = F.col("a.p2").bitwiseXOR(F.col("b.p2"))
    return ((100 * F.least(na, nb) >= threshold * F.greatest(na, nb))
            & ((100 + threshold) * F.bit_count(all_words) <= apart)
            & ((F.least(na, nb) <= LARGE)
               | ((100 + threshold) * (F.bit_count(some) + F.bit_count(some.bitwiseXOR(all_words))) <= apart)))


def _verified(pairs: DataFrame, lines: DataFrame, threshold: int) -> DataFrame:
    """set_id of the later set of every one of the ``pairs`` (x, y) that match."""
    ids = pairs.select(F.explode(F.array("x", "y")).alias("set_id")).distinct()
    wanted = bitmap(ids, "set_id", LOOKUP_BITS).scalar()
    whole = written(lines.select("set_id", "tk", F.struct("doc_id", "line_no", "set_id").alias("at"))
                    .where(is_set(wanted, F.col("set_id"), LOOKUP_BITS))
                    .groupBy("set_id").agg(F.first("tk").alias("tk"), F.min("at").alias("at")), "line-candidates")

    def side(name: str) -> DataFrame:
        return whole.select(F.col("set_id").alias(name), F.col("tk").alias(f"t{name}"), F.col("at").alias(f"at_{name}"))

    held = pairs.join(side("x"), "x").join(side("y"), "y")
    common = F.size(F.array_intersect("tx", "ty"))
    matched = (held.select(F.when(F.col("at_y") < F.col("at_x"), F.col("x")).otherwise(F.col("y")).alias("set_id"),
                           F.size("tx").alias("nx"), F.size("ty").alias("ny"), common.alias("common"))
               .where(100 * F.col("common") >= threshold * (F.col("nx") + F.col("ny") - F.col("common")))
               .select("set_id").distinct())
    out = written(matched, "matched-sets")
    discard(whole, pairs)
    return out


def _by_leaders(sets: DataFrame, lines: DataFrame, threshold: int) -> DataFrame:
    """set_id of the sets that match an earlier leader.  The leaders of a key are the
    earliest set and the one with most lines (the variants of a line often match the
    plain line and not one another).  The keys are of the two least and the two
    greatest hashes of all words and of the size: two variants agree in one of these,
    whichever words were edited, but for one in ten or so."""
    key = F.explode("keys").alias("key")
    shared = sets.select(key).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # most keys are of one set alone; what else passes the bitmap only costs time
    crowded = bitmap(shared, "key", LOOKUP_BITS).scalar()
    heads = written(sets.select("set_id", "n", "at", "lines", "p1", "p2", key)
                    .where(is_set(crowded, F.col("key"), LOOKUP_BITS)), "line-heads")
    lead = F.struct("at", "set_id", "n", "p1", "p2")
    leaders = heads.groupBy("key").agg(
        F.array_distinct(F.array(F.min(lead), F.max(F.struct("lines", lead.alias("x")))["x"])).alias("b")).select(
            "key", F.explode("b").alias("b")).select("key", "b.*")
    met = heads.alias("a").join(
        leaders.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("b.at") < F.col("a.at"))
        & _may_match(F.col("a.n"), F.col("b.n"), threshold))
    # of a set's leaders (four at most) the likeliest: the one whose parity differs least
    apart = F.bit_count(F.col("a.p1").bitwiseXOR(F.col("b.p1")))
    pairs = met.groupBy(F.col("a.set_id").alias("x")).agg(
        F.min(F.struct(apart.alias("apart"), F.col("b.set_id").alias("y"))).alias("best")).select("x", "best.y")
    pairs = written(pairs, "line-pairs")
    discard(heads)
    return _verified(pairs, lines, threshold)


def _matched_sets(sets: DataFrame, lines: DataFrame, threshold: int) -> DataFrame:
    """set_id of every set that matches an earlier, different set, first found by
    leaders, then by the complete join of what is left.  The matches of its first
    pass are decided before the others: most of a family that leaders missed."""
    # a set that cannot match even one more or one fewer word has no partner
    long_enough = sets.where(100 * F.col("n") >= threshold * (F.col("n") + 1))
    decided = _by_leaders(long_enough, lines, threshold)
    for passes in (range(1), range(1, PASSES)):
        more = _by_words(long_enough, lines, decided, passes, threshold)
        decided = decided.unionByName(more).distinct()
    return decided


def _by_words(sets: DataFrame, lines: DataFrame, decided: DataFrame, passes: range, threshold: int) -> DataFrame:
    """set_id of the later sets of all matching pairs that share a word of the
    ``passes`` in their prefixes, but for sets already ``decided``."""
    # Only sets that the bitmap may mean are held against the decided ones.
    maybe = is_set(bitmap(decided, "set_id", LOOKUP_BITS).scalar(), F.col("set_id"), LOOKUP_BITS)
    kept = ["set_id", "at.doc_id", "p1", "p2", "prefix", "n"]
    some = written(sets.select(*kept).where(maybe).join(
        decided.withColumn("done", F.lit(1)), "set_id", "left"), "line-decided")
    every = (sets.select(*kept).where(~maybe).withColumn("done", F.lit(0))
             .unionByName(some.withColumn("done", F.coalesce("done", F.lit(0)))))

    # a is the smaller set of a pair (of like ones that with the lesser id), b the
    # larger one.  With c words in common, a shares one of its first n - c + 1 words and
    # b one of its prefix.  A size's class is a little wider than the ratio of
    # sizes that may match, so b has the class of a or the next one; a word is only met
    # in these, by a with as many words as the least size there asks for.
    width = 100 / threshold * 1.001
    n = F.col("n").cast("long")
    size_class = F.floor(F.log(n.cast("double")) / math.log(width))
    least = F.greatest(n + 1, F.floor(F.pow(F.lit(width), size_class + 1)))

    def first_words(size: Column) -> Column:
        common = F.floor((threshold * (n + size) + 99 + threshold) / (100 + threshold))
        return F.greatest(F.lit(0), n - common + 1).cast("int")

    def tokens(words: Column, k: int, *place: Column) -> DataFrame:
        pos, up = place or (F.col("pos"), F.lit(0))
        npd = _shl(n, F.lit(32)) + pos * 2 + F.col("done")
        key = F.col("rk").bitwiseXOR(_shl(F.col("class") + up, F.lit(40)))
        first = [first_words(n).alias("first")] if place else []
        return (every.select("set_id", "doc_id", "p1", "p2", "n", "done", size_class.alias("class"), *first,
                             F.posexplode(words).alias("pos", "rk"))
                # level 0: a word of one line, which no two sets share
                .where((F.pmod("rk", F.lit(PASSES)) == k) & (F.shiftright("rk", 56) > 0))
                .select(key.alias("key"), "set_id", "doc_id", "p1", "p2", npd.alias("npd")))

    def unpacked(side: str) -> tuple[Column, Column, Column]:
        npd = F.col(f"{side}.npd")
        return (F.shiftright(npd, 32), F.shiftright(npd, 1).bitwiseAND(F.lit((1 << 31) - 1)),
                npd.bitwiseAND(F.lit(1)))

    own_and_next = F.concat(*[F.slice("prefix", F.lit(1), first_words(size)) for size in (n, least)])
    is_next = (F.col("pos") >= F.col("first")).cast("int")
    own_pos = F.col("pos") - F.col("first") * is_next
    (na, pa, da), (nb, pb, db) = unpacked("a"), unpacked("b")
    ida, idb = F.struct("a.doc_id"), F.struct("b.doc_id")
    found = []
    for k in passes:
        smaller, larger = tokens(own_and_next, k, own_pos, is_next), tokens(F.col("prefix"), k)
        both = smaller.alias("a").join(
            larger.alias("b"),
            (F.col("a.key") == F.col("b.key")) & (na <= nb) & _may_match(na, nb, threshold)
            & ((100 + threshold) * F.least(na - pa, nb - pb) >= threshold * (na + nb))
            & ((na < nb) | (F.col("a.set_id") < F.col("b.set_id")))
            # the undecided one may be the later one
            & (((da == 0) & (ida >= idb)) | ((db == 0) & (idb >= ida))))
        found.append(written(both.select(F.col("a.set_id").alias("x"), F.col("b.set_id").alias("y")),
                             f"line-pairs-{k}"))
        settle(sets.sparkSession)
    discard(some)
    pairs = written(reduce(DataFrame.unionByName, found).distinct(), "line-pairs")
    discard(*found)
    return _verified(pairs, lines, threshold)


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   threshold: int = 80) -> DataFrame:
    """(k, doc_id, line_no, set_id, removed): every line with a word; ``k`` is
    the row key, ``line_no`` counts from 0."""
    lines = written(_lines(docs, doc_id, text), "lines", dictionary=False)
    sets = written(_sets(lines, threshold), "line-sets", dictionary=False)
    matched = _matched_sets(sets, lines, threshold).withColumn("matched", F.lit(True))
    # sets of which a line goes; the lines of all others stay as they are
    verdicts = written(sets.where("lines > 1").select("set_id", "at").join(matched, "set_id", "full"), "line-verdicts")
    discard(sets)
    judged = is_set(bitmap(verdicts, "set_id", LOOKUP_BITS).scalar(), F.col("set_id"), LOOKUP_BITS)
    slim = lines.select("k", "doc_id", "line_no", "set_id")
    here = F.struct("doc_id", "line_no", "set_id")
    found = slim.where(judged).join(verdicts, "set_id", "left").select(
        *slim.columns, F.coalesce("matched", here != F.col("at"), F.lit(False)).alias("removed"))
    return slim.where(~judged).withColumn("removed", F.lit(False)).unionByName(found)


def per_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 threshold: int = 80) -> DataFrame:
    """(doc_id, n_lines, removed_lines): per document with a line, the number
    of its lines with a word and the numbers of those removed."""
    lines = repeated_lines(docs, doc_id, text, threshold)
    # equal rows have equal lines: each counts once
    marked = lines.select("k", "doc_id", (F.col("line_no").cast("long") * 2 + F.col("removed").cast("int"))
                          .alias("mark"))
    gone = F.filter("marks", lambda m: m.bitwiseAND(F.lit(1)) == 1)
    return marked.groupBy("k").agg(F.first("doc_id").alias("doc_id"), F.collect_set("mark").alias("marks")).select(
        "doc_id", F.size("marks").cast("long").alias("n_lines"),
        F.sort_array(F.transform(gone, lambda m: F.shiftright(m, 1).cast("int"))).alias("removed_lines"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                threshold: int = 80) -> DataFrame:
    """``docs`` with the removed lines cut from their texts; a document whose
    lines all went is empty.  Same columns."""
    gone = (repeated_lines(docs, doc_id, text, threshold).where("removed")
            .groupBy("k").agg(F.collect_set("line_no").alias("gone")))
    key, cut, parts = (fresh(docs, c) for c in ("_key", "_gone", "_parts"))
    joined = docs.withColumn(key, row_key(docs)).join(
        gone.select(F.col("k").alias(key), F.col("gone").alias(cut)), key, "left")
    joined = joined.withColumn(parts, F.split(F.col(f"`{text}`"), "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(cut))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(parts), i)), "\n")
    return joined.select(*[
        F.when(F.col(cut).isNull(), F.col(f"`{c}`")).otherwise(rest).alias(c) if c == text
        else F.col(f"`{c}`") for c in docs.columns])
