"""Mixing sources to target weights (DataFrame operations only).

Sources in code point order, null last, have weights that repeat; the corpus'
words are shared among them by weight, but no source gives more than ``most``
times its words, and what it cannot give is shared again by weight.

1. A source's documents are laid end to end, in the order of a digest of id and
   text, and cut to blocks of ``block`` words (the last one shorter).
2. A source's target is so many slots: whole epochs over all its blocks, and the
   first slots of one more epoch, the last slot cut to the word.
3. All slots are dealt to output shards of ``shard`` slots.  Each shard draws its
   counts of slots by source from a multinomial distribution (independent draws
   by a hash of the slot, in proportion to the targets).  Summed over the shards
   the draws miss the targets by about a root; so the slots beyond a source's
   target are handed to the sources that lack some, in order.
4. The n-th slot of a source is place ``n mod blocks`` of epoch ``n div blocks``,
   mapped through a pseudorandom permutation of the source's block indexes, one
   for each source and epoch (swap-or-not: exact for any number of blocks, and
   computed for each index alone).
5. Slots and blocks are joined by source and block index.

Scale: texts are read once, for their words and digest.  A source with a third of
all documents is laid out in buckets of the digest, and the sums before a bucket,
a shard or a source come from sums of sums; no window holds more than a bucket,
a chunk of shards or one shard.  A block takes part in ``most`` slots at most, so
no join is skewed.  The draws know no loop over sources; sources are looked up
by an equi-join on bins of the cumulated targets.

Defined results: a null or empty text has no words and is taken 0 times; a null
source is a source, the last; a null id is kept; repeated rows are mixed each;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, words, written

BUCKET_ROWS = 10_000      # documents of a bucket of a source, about
CHUNK_SHARDS = 4096


@dataclass(frozen=True)
class Mixing:
    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3          # times a source may be taken
    block: int = 256       # words
    shard: int = 4096      # slots
    rounds: int = 24       # of a permutation
    seed: str = "mix"


def _long(x: Column | int) -> Column:
    return (F.lit(x) if isinstance(x, int) else x).cast("long")


def _div(a: Column, b: Column | int) -> Column:
    """Whole part of a / b for numbers that are not negative."""
    return F.call_function("div", _long(a), _long(b))


def _hash(*parts: Column | str) -> Column:
    """60 bits of the MD5 of the parts, joined by colons."""
    said = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")


def _mark(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text))


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size (words), mark (digest of id and
    text), place (likewise, but another one for each repeated row)."""
    t = text_or_empty(F.col(f"`{text}`"))
    given = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        _mark(F.col(f"`{doc_id}`"), t).alias("mark"))
    rows = given.groupBy("doc_id", "source", "size", "mark").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("doc_id", "source", "size", "mark", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"))
    return rows.select("doc_id", "source", "size", "mark", F.when(F.col("nth") == 1, F.col("mark")).otherwise(
        F.md5(F.concat_ws(":", "mark", F.col("nth").cast("string")))).alias("place"))


def _before(df: DataFrame, value: str, chunk: str, order: str, name: str, group: str | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over earlier rows (by ``chunk``, then
    ``order``) of the same group: within chunks, and over the chunks' sums."""
    keys = [group] if group else []
    sums = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_chunk"))
    over = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(chunk)
    sums = sums.select(*keys, chunk, (F.sum("_chunk").over(over) - F.col("_chunk")).alias("_chunk"))
    within = F.sum(value).over(Window.partitionBy(*keys, chunk).orderBy(order)
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.withColumn(name, within - F.col(value)).join(sums, [*keys, chunk])
            .withColumn(name, F.col(name) + F.col("_chunk")).drop("_chunk"))


def targets(sized: DataFrame, how: Mixing = Mixing()) -> DataFrame:
    """One row per source: rank (its place in code point order), source,
    source_size, weight, target, and how it is taken: blocks, epochs (whole),
    slots, words (of the target)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # a global sort, written: the running number tells partition and place
    ordered = written(totals.orderBy(F.col("source").asc_nulls_last())
                      .withColumn("id", F.monotonically_increasing_id()), "mix-sources")
    ordered = ordered.withColumns({"part": F.shiftright("id", 33), "one": F.lit(1).cast("long")})
    ranked = _before(ordered, "one", "part", "id", "rank").drop("one")
    weight = F.element_at(F.array(*map(F.lit, how.weights)), (F.col("rank") % len(how.weights)).cast("int") + 1)
    ranked = written(ranked.withColumn("weight", weight.cast("long")), "mix-ranks")
    # the level L of water: target = least(most * size, weight * L)
    most = how.most * F.col("source_size")
    whole, weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    full, level = 0, whole / weights if weights else 0.0
    while weights:
        over = F.col("weight") * F.lit(level) > most
        n, given, free = ranked.agg(F.count_if(over), F.sum(F.when(over, most).otherwise(0)),
                                    F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if n == full or not free:
            break
        full, level = n, (whole - given) / free
    target = F.least(most.cast("double"), F.col("weight") * F.lit(level))
    blocks = _div(F.col("source_size") + (how.block - 1), how.block)
    words = F.floor(F.col("target") + 0.5)
    size = F.greatest("source_size", F.lit(1).cast("long"))
    return (ranked.withColumns({"target": target, "blocks": blocks})
            .withColumn("words", words).withColumn("epochs", _div(F.col("words"), size))
            .withColumn("slots", F.col("epochs") * F.col("blocks")
                        + _div(F.col("words") - F.col("epochs") * size + (how.block - 1), how.block))
            .drop("id"))


def draw(sources: DataFrame, how: Mixing = Mixing()) -> DataFrame:
    """(shard, rank, n, first): the multinomial counts of each output shard,
    and the place in the shard at which the source's slots begin."""
    spark = sources.sparkSession
    n, kinds = sources.agg(F.sum("slots"), F.count(F.lit(1))).first()
    n, kinds = n or 0, kinds or 0
    width = max(1, -(-n // (4 * kinds + 64)))
    ranges = _before(sources, "slots", "part", "rank", "low").where(F.col("slots") > 0)
    ranges = ranges.select("rank", "low", (F.col("low") + F.col("slots")).alias("high"), F.explode(F.sequence(
        _div(F.col("low"), width), _div(F.col("low") + F.col("slots") - 1, width))).alias("bin"))
    drawn = F.pmod(_hash(how.seed, "draw", F.col("id")), F.lit(max(1, n)))
    draws = (spark.range(n).select(_div(F.col("id"), how.shard).alias("shard"), drawn.alias("v"))
             .withColumn("bin", _div(F.col("v"), width)))
    met = draws.join(ranges, "bin").where((F.col("low") <= F.col("v")) & (F.col("v") < F.col("high")))
    counts = met.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("shard").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))


def _permuted(x: Column, n: Column, keys: Column, *tweak: Column | str) -> Column:
    """The image of x under a permutation of 0 .. n - 1, by swap-or-not: in each
    round x and its mirror image under the round's key either swap or stay."""
    def step(x: Column, key: Column) -> Column:
        other = F.pmod(key["key"] - x, n)
        swap = _hash(*tweak, key["round"], F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.when(n > 1, F.aggregate(keys, x, step)).otherwise(x)


def _round_keys(n: Column, rounds: int, *tweak: Column | str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(rounds - 1)), lambda r: F.struct(
        r.alias("round"), F.pmod(_hash(*tweak, "key", r), F.greatest(n, _long(1))).alias("key")))


def slots(sources: DataFrame, how: Mixing = Mixing()) -> DataFrame:
    """(shard, at, turn, rank, epoch, block, words): every slot of every output
    shard, the block of a source it takes and the words it takes of it at most.
    ``at`` runs by source; in the order of ``turn`` a shard is shuffled."""
    counts = written(draw(sources, how).withColumn("chunk", _div(F.col("shard"), CHUNK_SHARDS)), "mix-draws")
    numbered = _before(counts, "n", "chunk", "shard", "before", "rank")
    every = numbered.select("shard", "rank", "first", "before", F.explode(
        F.sequence(_long(0), F.col("n") - 1)).alias("i")).select(
            "shard", "rank", (F.col("first") + F.col("i")).alias("at"), (F.col("before") + F.col("i")).alias("number"))
    # slots beyond a source's target go to the sources that lack some
    drawn = counts.groupBy("rank").agg(F.sum("n").alias("drawn"))
    held = sources.join(drawn, "rank", "left").withColumn("drawn", F.coalesce("drawn", _long(0)))
    zero = _long(0)
    held = held.withColumns({"over": F.greatest(F.col("drawn") - F.col("slots"), zero),
                             "lack": F.greatest(F.col("slots") - F.col("drawn"), zero)})
    held = _before(_before(held, "over", "part", "rank", "over_before"), "lack", "part", "rank", "lack_before")
    held = written(held.select("rank", "slots", "drawn", "over_before", "lack", "lack_before", "blocks", "epochs",
                               "words", "source_size"), "mix-balance")
    every = every.join(held.select("rank", "slots", "over_before"), "rank")
    right = every.where(F.col("number") < F.col("slots")).select("shard", "at", "rank", "number")
    spare = every.where(F.col("number") >= F.col("slots")).select(
        "shard", "at", (F.col("over_before") + F.col("number") - F.col("slots")).alias("nth"))
    wanted = held.where(F.col("lack") > 0).select("rank", "drawn", "lack_before", F.explode(
        F.sequence(_long(0), F.col("lack") - 1)).alias("i")).select(
            "rank", (F.col("drawn") + F.col("i")).alias("number"), (F.col("lack_before") + F.col("i")).alias("nth"))
    dealt = right.unionByName(spare.join(wanted, "nth").select("shard", "at", "rank", "number"))
    # numbers become blocks; an epoch's last place is the shorter last block
    n = F.col("blocks") - 1
    epochs = held.select("rank", "blocks", "epochs", "slots", "words", "source_size",
                         F.explode(F.sequence(_long(0), _long(how.most))).alias("epoch"))
    epochs = epochs.withColumn("keys", _round_keys(n, how.rounds, how.seed, F.col("rank"), F.col("epoch")))
    dealt = dealt.join(held.select("rank", F.col("blocks").alias("_b")), "rank").withColumns({
        "epoch": _div(F.col("number"), F.col("_b")), "place": F.pmod("number", "_b")}).drop("_b")
    met = dealt.join(epochs, ["rank", "epoch"])
    block = F.when(F.col("place") == n, n).otherwise(
        _permuted(F.col("place"), n, F.col("keys"), how.seed, F.col("rank"), F.col("epoch")))
    left = F.col("words") - F.col("epochs") * F.col("source_size") - F.col("place") * how.block
    return met.select(
        "shard", "at", _hash(how.seed, "turn", F.col("shard"), F.col("at")).alias("turn"), "rank", "epoch",
        block.alias("block"),
        F.when(F.col("epoch") < F.col("epochs"), _long(how.block)).otherwise(
            F.least(left, _long(how.block))).alias("words"))


def pieces(sized: DataFrame, sources: DataFrame, how: Mixing = Mixing()) -> DataFrame:
    """(rank, block, place, from_word, n_words, offset): the parts of documents
    that make up each block."""
    rows = sized.count()
    buckets = max(1, rows // BUCKET_ROWS)
    bucket = _div(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * buckets, 1 << 32)
    laid = sized.where(F.col("size") > 0).join(
        sources.select(F.col("source").alias("s"), "rank"), F.col("source").eqNullSafe(F.col("s"))).select(
            "rank", "place", "size", bucket.alias("bucket"))
    laid = _before(laid, "size", "bucket", "place", "start", "rank")
    cut = laid.select("rank", "place", "size", "start", F.explode(F.sequence(
        _div(F.col("start"), how.block), _div(F.col("start") + F.col("size") - 1, how.block))).alias("block"))
    begin = F.col("block") * how.block
    low, high = F.greatest("start", begin), F.least(F.col("start") + F.col("size"), begin + how.block)
    return cut.select("rank", "block", "place", (low - F.col("start")).alias("from_word"),
                      (high - low).alias("n_words"), (low - begin).alias("offset"))


def mix(docs: DataFrame, how: Mixing = Mixing(), doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized, sources, mixed).  ``mixed`` tells the output: one row per part of
    a document in a slot: shard, at (the slot in the shard), turn, epoch, rank,
    block, place (of the document, see ``sizes``), from_word, n_words, offset
    (in the slot)."""
    sized = written(sizes(docs, doc_id, text, source), "mix-sizes")
    sources = written(targets(sized, how), "mix-targets")
    met = slots(sources, how).join(pieces(sized, sources, how), ["rank", "block"])
    n = F.least("n_words", F.col("words") - F.col("offset"))
    mixed = met.select("shard", "at", "turn", "epoch", "rank", "block", "place", "from_word",
                       n.alias("n_words"), "offset")
    return sized, sources, mixed.where(F.col("n_words") > 0)


def texts(docs: DataFrame, how: Mixing = Mixing(), doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """The mix itself, one row per slot: shard, at, turn, rank, epoch, block,
    text (the words of the slot, joined by one space)."""
    sized, sources, mixed = mix(docs, how, doc_id, text, source)
    t, s = text_or_empty(F.col(f"`{text}`")), F.col(f"`{source}`")
    given = docs.select(_mark(F.col(f"`{doc_id}`"), t).alias("mark"), s.alias("source"), t.alias("t"))
    given = given.dropDuplicates(["mark", "source"])
    places = sized.join(sources.select(F.col("source").alias("s"), "rank"),
                        F.col("source").eqNullSafe(F.col("s"))).select("rank", "place", "mark", "source")
    met = mixed.join(places, ["rank", "place"]).alias("m").join(
        given.alias("g"), (F.col("m.mark") == F.col("g.mark")) & F.col("m.source").eqNullSafe(F.col("g.source")))
    part = F.slice(words(F.col("t")), (F.col("from_word") + 1).cast("int"), F.col("n_words").cast("int"))
    parts = met.select("shard", "at", "turn", "rank", "epoch", "block",
                       F.struct("offset", F.array_join(part, " ").alias("said")).alias("part"))
    return parts.groupBy("shard", "at", "turn", "rank", "epoch", "block").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("part")), lambda x: x["said"]), " ").alias("text"))


def taken(docs: DataFrame, how: Mixing = Mixing(), doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    sized, sources, mixed = mix(docs, how, doc_id, text, source)
    sums = mixed.groupBy("rank", "place").agg(F.sum("n_words").alias("taken"))
    told = sized.join(sources.select(F.col("source").alias("s"), "rank", "source_size", "target"),
                      F.col("source").eqNullSafe(F.col("s")))
    return told.join(sums, ["rank", "place"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", _long(0)).alias("taken"))
