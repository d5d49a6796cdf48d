"""Quality rules with cross-document line frequency (DataFrame operations only).

Two kinds of rules decide about a document:

* base rules on the text alone: too few words, or too many words inside
  8-word windows that the text holds more than once;
* cross-document line frequency: lines are normalised (lower case, white
  space collapsed) and hashed with their host; a line that more than
  ``max_share`` of the distinct documents of one host carry (and more than
  ``max_docs``, which counts on hosts with few) is boilerplate and is
  removed, and a document of which too little is left is depleted.

Documents are counted by content, as the digest of all their normalised lines,
so that exact copies count once.  No block of lines, however long, can make two
documents one that differ elsewhere.

Near copies have a rule of their own, because a group of them shares nearly
*every* line, and dropping copies is the near-duplicate stage's decision: before
documents are digested, each line that is a variant of a line above the limit
(at least ``same_pct`` per cent of their distinct words in common, estimated from
the ``sketch`` least word hashes of each) is replaced by that line.  Near copies
that differ by edited words so become one document.  Those that differ by a line
of their own, by a line cut in two, or by a word in a line too short for
``same_pct`` do not.  Rows play no part: a group of copies adds one document, so it neither
makes a line boilerplate nor keeps one from being it.  Lines are put through this
from a quarter of the share on, counted with the near copies; so near copies hide
a line only if they are some 75 times the other documents of its host.

Scale: lines are written once as hashes and read from there; texts are never
shuffled by ``judge``.  Counts are hash aggregations with map-side combine over
(line, document), so a line in a third of all documents is spread over tasks
first.  Joins are plain equi-joins that AQE can split.

Defined results: a null text is the empty text (no words, base rules reject
it); a null host is a host of its own; repeated rows are judged alike; an
empty table gives an empty result; further columns are ignored by ``judge``
and kept by ``clean``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, fresh, row_key, text_or_empty, words, written

HAS_WORD = r"[^\x20\x09-\x0D]"
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    window: int = 8
    max_repeat_pct: int = 30
    #: a line in more distinct documents of its host than this is removed ...
    max_docs: int = 20
    #: ... if they are also more than this share of the host's distinct documents
    max_share: float = 0.05
    #: lines with this share of words in common are variants ...
    same_pct: int = 80
    #: ... held against each other by so many word hashes
    sketch: int = 16
    #: a document with a smaller share of its line characters left is depleted
    min_rest: float = 0.3


def _base(df: DataFrame, text: str, rules: Rules) -> DataFrame:
    """Adds the base columns to ``df``; ``text`` is a non-null column."""
    n = rules.window
    df = df.withColumn("_w", words(F.col(text)))
    df = df.withColumn("_win", F.when(
        F.size("_w") >= n,
        F.transform(F.sequence(F.lit(1), F.size("_w") - (n - 1)),
                    lambda i: F.xxhash64(F.slice(F.col("_w"), i, n)))
    ).otherwise(F.array().cast("array<long>")))
    df = df.withColumn("_rep", F.size(F.array_distinct("_win")) < F.size("_win"))
    df = df.withColumn("_placed", F.when(F.col("_rep"), F.sort_array(
        F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def twice(x, k):
        return (F.get("_placed", k - 1)["h"].eqNullSafe(x["h"])
                | F.get("_placed", k + 1)["h"].eqNullSafe(x["h"]))

    df = df.withColumn("_at", F.array_sort(F.transform(
        F.filter("_placed", twice), lambda x: x["i"])))
    covered = F.transform("_at", lambda p, k: F.least(
        F.lit(n), F.coalesce(F.get("_at", k + 1) - p, F.lit(n))))
    repeat = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    bare, no_symbols = F.col(text), F.col(text)
    for c in " \t\n\x0b\f\r":
        bare = F.replace(bare, F.lit(c), F.lit(""))
    for c in SYMBOLS:
        no_symbols = F.replace(no_symbols, F.lit(c), F.lit(""))
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(HAS_WORD))
    df = df.withColumn("_lines", lines)
    return (df
            .withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.length(bare).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(no_symbols)).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(F.when(F.col("_rep"), repeat), F.lit(0)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < rules.min_words)
                        | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, WORD_GAP, " ")))


def _lines(docs: DataFrame, text: str, host: str, rules: Rules) -> DataFrame:
    """Per line with a word, written: ``_id`` (row key), ``h`` (host), ``d``
    (digest of the document's normalised lines), ``k`` (hash of host and
    normalised line), ``n`` (code points), ``i`` (number), ``sk`` (least word hashes)."""
    df = docs.select(
        row_key(docs).alias("_id"),
        F.xxhash64(F.col(f"`{host}`").isNull().cast("int"), F.col(f"`{host}`")).alias("h"),
        F.split(text_or_empty(F.col(f"`{text}`")), "\n").alias("_l"))
    df = df.withColumn("_norm", F.transform("_l", lambda x: F.when(x.rlike(HAS_WORD), normalised(x))))

    def sketch(line):
        hashes = F.transform(F.split(line, " "), lambda w: F.hash(F.col("h"), w))
        return F.slice(F.sort_array(F.array_distinct(hashes)), 1, rules.sketch)

    rows = F.transform(F.arrays_zip("_norm", "_l"), lambda x, i: F.struct(
        F.when(x["_norm"].isNotNull(), F.xxhash64(F.col("h"), x["_norm"])).alias("k"),
        F.length(x["_l"]).alias("n"), i.alias("i"), sketch(x["_norm"]).alias("sk")))
    df = df.select("_id", "h", F.xxhash64("h", "_norm").alias("d"), F.explode_outer(rows).alias("x"))
    return written(df.select("_id", "h", "d", "x.k", "x.n", "x.i", "x.sk").where(F.col("k").isNotNull()),
                   "quality-lines")


def _keyed(df: DataFrame) -> DataFrame:
    """Adds ``key``, a row for any three of the four least hashes of ``sk``: one
    edited word leaves one key at least."""
    least = [F.get("sk", F.lit(i)) for i in range(4)]
    keys = F.array(*[F.xxhash64(*[x for x in least if x is not skipped]) for skipped in least])
    return df.where(F.size("sk") > 4).withColumn("key", F.explode(keys))


def _variants(lines: DataFrame, common: DataFrame, rules: Rules) -> DataFrame:
    """(k, as): the lines that are variants of one of ``common``, and the least
    such.  Hosts stay apart by their hashes.  Only hashes of lines that share a key
    with a common line are joined; common lines are few, by the limit."""
    known = written(lines.select("k", "sk").join(common, "k", "left_semi").distinct(), "quality-known")
    keys = written(_keyed(known).select("key").distinct(), "quality-keys")
    near = written(_keyed(lines.select("k", "sk")).select("k", "key").join(keys, "key", "left_semi")
                   .select("k").distinct().join(common, "k", "left_anti"), "quality-near")
    ours = lines.select("k", "sk").join(near, "k", "left_semi").distinct()
    theirs = _keyed(known).select(F.col("k").alias("as"), F.col("sk").alias("with"), F.col("key").alias("as_key"))
    least = F.slice(F.array_sort(F.array_union("sk", "with")), 1, rules.sketch)
    both = F.size(F.array_intersect(F.array_intersect("sk", "with"), least))
    return (_keyed(ours).join(theirs, (F.col("key") == F.col("as_key"))
                              & (100 * both >= rules.same_pct * F.size(least)))
            .groupBy("k").agg(F.min("as").alias("as")))


def _contents(lines: DataFrame, common: DataFrame, rules: Rules) -> DataFrame:
    """(h, d, content) of the documents: the digest of their lines, with variants
    of common lines replaced."""
    variants = written(_variants(lines, common, rules), "quality-variants")
    found = lines.select("h", "d", "k").join(variants, "k", "left").groupBy("h", "d").agg(
        F.xxhash64(F.sort_array(F.collect_set(F.coalesce("as", "k")))).alias("content"))
    return written(found, "quality-contents")


def _above(per_line: DataFrame, per_host: DataFrame, share: float, rules: Rules) -> DataFrame:
    """(k) of (k, h, n) above both limits; ``per_host`` is (h, docs)."""
    many = per_line.where(F.col("n") > rules.max_docs)
    return many.join(per_host, "h").where(F.col("n") > share * F.col("docs")).select("k")


def _frequent(lines: DataFrame, rules: Rules) -> DataFrame:
    """One row ``k`` per line of ``_lines`` above the limits."""
    texts = lines.select("h", "d").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("docs"))
    held = lines.select("k", "h", "d").distinct().groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"))
    common = written(_above(held, texts, rules.max_share / 4, rules), "quality-common")
    contents = _contents(lines, common, rules)
    per_host = contents.groupBy("h").agg(F.count_distinct("content").alias("docs"))
    carriers = lines.select("k", "h", "d").join(common, "k", "left_semi").distinct()
    per_line = carriers.join(contents.select("d", "content"), "d").groupBy("k", "h").agg(
        F.count_distinct("content").alias("n"))
    return _above(per_line, per_host, rules.max_share, rules)


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source",
                   rules: Rules = Rules()) -> DataFrame:
    """One row ``k`` per (host, normalised line) above the limits."""
    return _frequent(_lines(docs, text, host, rules), rules)


def _removed(docs: DataFrame, text: str, host: str, rules: Rules) -> DataFrame:
    """Per row key with removed lines: their code points and their numbers."""
    lines = _lines(docs, text, host, rules)
    hits = (lines.select("_id", "k", "n", "i").join(_frequent(lines, rules), "k")
            .dropDuplicates(["_id", "i"]))
    return hits.groupBy("_id").agg(F.sum("n").alias("_gone"), F.collect_set("i").alias("_cut"))


def _depleted(gone: Column, total: Column, rules: Rules) -> Column:
    return gone > (1 - rules.min_rest) * total


def _verdicts(docs: DataFrame, doc_id: str, text: str, host: str, rules: Rules) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``_cut`` (numbers of its removed lines) and
    the columns of ``judge``."""
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key(docs).alias("_id"),
                       text_or_empty(F.col(f"`{text}`")).alias("_text"))
    base = _base(base, "_text", rules)
    base = base.withColumn("_total", F.aggregate(
        "_lines", F.lit(0).cast("long"), lambda a, x: a + F.length(x)))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
            "n_repeat_words", "base_failed"]
    out = base.select("_id", "_total", *cols).join(_removed(docs, text, host, rules), "_id", "left")
    gone = F.coalesce("_gone", F.lit(0)).cast("long")
    depleted = _depleted(gone, F.col("_total"), rules)
    return out.select("_id", "_cut", *cols, (~F.col("base_failed") & ~depleted).alias("kept"),
                      gone.alias("removed_chars"), depleted.alias("depleted"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base columns,
    ``removed_chars`` (code points of removed lines), ``depleted``, ``kept``."""
    return _verdicts(docs, doc_id, text, host, rules).drop("_id", "_cut")


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """``docs`` without rejected rows, the boilerplate lines cut from the
    texts of the others (blank lines stay); same columns, same order.

    The verdicts are written first: as a filter of the same plan they would be
    pushed below the steps that compute them, and be computed over and over."""
    verdicts = written(_verdicts(docs, doc_id, text, host, rules).select("_id", "_cut", "kept"),
                       "quality-verdicts").dropDuplicates(["_id"])
    key, cut, lines = (fresh(docs, c) for c in ("_id", "_cut", "_l"))
    df = docs.withColumn(key, row_key(docs)).join(
        verdicts.where("kept").select(F.col("_id").alias(key), F.col("_cut").alias(cut)), key)
    df = df.withColumn(lines, F.split(text_or_empty(F.col(f"`{text}`")), "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(cut))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")
    return df.select(*[
        F.when(F.col(cut).isNull(), F.col(f"`{c}`")).otherwise(rest).alias(c)
        if c == text else F.col(f"`{c}`") for c in docs.columns])
