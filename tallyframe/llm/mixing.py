"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source's documents lie in a shuffled order on a line of words that repeats when it ends. The line is cut into
blocks of ``block_words``. Slot ``i`` of the schedule has the point ``frac(i * golden ratio)``, taken as an integer
lattice of 2^31 points; the point falls into one source's share of the cumulative targets, and the k-th slot of a source
takes its k-th block. Slots that a source misses because the schedule is finite follow at the schedule's end, so
every source yields its target exactly (rounded, the last block is cut).

Defined results: null and empty texts have size 0 and are never taken; null sources are one source, last in order;
repeated rows are rows of their own; tables without a word give no slot. Only ``doc_id``, ``text`` and ``source`` are
read, whatever else the table holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, packed, parts, saved

#: Points of the lattice and the multiplier nearest to 2^31 / golden ratio that is odd.
POINTS = 1 << 31
GOLDEN = 1327217885
CHUNK = 1 << 16


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3) -> DataFrame:
    """Sources with ``source_size``, ``target`` and the cumulative shares ``below`` and ``upto``.

    Sources by code point, null last, get the weights in turn. A target stops at ``most`` times the source's size and
    the excess goes to the others by weight until none is above: with sources ordered by size over weight, the first
    ``i`` are at their limit for the smallest ``i`` whose rest, shared by weight, leaves the next one below its limit.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    limit = F.lit(float(most)) * F.col("source_size")
    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = left / weights_left
    shares = (
        by_source.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("level", level)
        .withColumn("place", F.row_number().over(filled))
        .withColumn("fits", F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("place")))
        .withColumn("level", F.min_by("level", "fits").over(every))
        .withColumn("target", F.least("limit", F.coalesce(F.col("level") * F.col("weight"), "limit")))
        .withColumn("words", F.least(F.round("target").cast("long"), F.lit(int(most)) * F.col("source_size")))
    )
    upto = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    edge = (F.sum("words").over(upto).cast("double") / F.sum("words").over(every) * POINTS).cast("long")
    return shares.withColumn("upto", edge).withColumn(
        "below", F.coalesce(F.lag("upto").over(order), F.lit(0).cast("long"))
    ).select("source", "source_size", "weight", "target", "words", "below", "upto")


def shuffled_lines(sizes: DataFrame, seed: int, n_docs: int) -> DataFrame:
    """``start``: the words of the source before the document in a shuffled order, summed by bucket and then inside it."""
    buckets = parts(n_docs, 2000)
    mixed = F.xxhash64(F.lit(seed), "doc_id", "row_hash", "copy")
    dealt = sizes.withColumn("mixed", mixed).withColumn("bucket", F.pmod(F.col("mixed"), F.lit(buckets)))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sums = sums.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(run), F.lit(0)).alias("base"))
    sums = sums.withColumnsRenamed({"source": "base_source", "bucket": "base_bucket"})
    inside = Window.partitionBy("source", "bucket").orderBy("mixed", "doc_id", "row_hash", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("base_source")) & (F.col("bucket") == F.col("base_bucket"))
    return placed.join(sums, same).select(
        "doc_id", "row_hash", "copy", "source", "size", (F.col("base") + F.col("inside")).cast("long").alias("start")
    )


def schedule(targets: DataFrame, block_words: int, n_sources: int, total: int) -> DataFrame:
    """Slots ``slot, source, block``: ``block`` counts a source's slots from 0."""
    spark = targets.sparkSession
    grid = 1
    while grid < n_sources:
        grid *= 2
    width = POINTS // min(grid, POINTS)
    owners = targets.where("upto > below").select(
        "source", "below", "upto", F.explode(F.sequence((F.col("below") / width).cast("long"), ((F.col("upto") - 1) / width).cast("long"))).alias("cell")
    )
    slots = spark.range(-(-total // block_words)).withColumnRenamed("id", "slot")
    slots = slots.withColumn("point", F.pmod(F.pmod(F.col("slot"), F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS)))
    slots = slots.withColumn("cell", (F.col("point") / width).cast("long"))
    given = slots.join(owners, "cell").where("point >= below AND point < upto").select(
        "slot", "source", F.floor(F.col("slot") / CHUNK).alias("chunk")
    )
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = given.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    bases = counts.select(
        F.col("source").alias("b_source"), F.col("chunk").alias("b_chunk"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    rank = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    ranked = given.withColumn("rank", rank).join(
        bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("chunk") == F.col("b_chunk"))
    ).select("slot", "source", (F.col("base") + F.col("rank")).alias("block"))
    need = targets.select("source", "words", F.ceil(F.col("words") / block_words).cast("long").alias("need"))
    had = counts.groupBy(F.col("source").alias("h_source")).agg(F.sum("n").alias("had"))
    short = need.join(had, F.col("source").eqNullSafe(F.col("h_source")), "left").withColumn("had", F.coalesce("had", F.lit(0)))
    more = short.where("had < need").select("source", F.explode(F.sequence("had", F.col("need") - 1)).alias("block"))
    last = -(-total // block_words)
    more = more.select((F.lit(last) + F.row_number().over(Window.orderBy("block", F.col("source").asc_nulls_last())) - 1).alias("slot"), "source", "block")
    limits = need.select(F.col("source").alias("n_source"), "need")
    kept = ranked.join(limits, F.col("source").eqNullSafe(F.col("n_source"))).where("block < need")
    return kept.select("slot", "source", "block").unionByName(more.select(F.col("slot").cast("long"), "source", F.col("block").cast("long")))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block_words: int = 256, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The mix as pieces ``slot, doc_id, row_hash, copy, epoch, from_word, n_words, size``, and every document with its totals.

    ``most`` is a whole number. The driver learns three numbers only: documents, sources and words.
    """
    sizes = saved(_numbered(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _row_hash().alias("row_hash"))))
    n_docs, n_sources, total = sizes.agg(
        F.count(F.lit(1)), F.count_distinct("source") + F.max(F.col("source").isNull().cast("long")), F.sum("size")
    ).first()
    total = total or 0
    targets = source_targets(sizes, weights, most)
    lines = shuffled_lines(sizes, seed, n_docs)
    slots = schedule(targets, block_words, n_sources or 1, total)
    known = targets.select(F.col("source").alias("t_source"), "source_size", "target", "words")
    held = lines.join(known, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    # A document's stretches on the repeating line, and the blocks they meet.
    stretch = held.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    low = F.col("epoch") * F.col("source_size") + F.col("start")
    stretch = stretch.withColumn("low", low).withColumn("high", F.least(F.col("low") + F.col("size"), F.col("words"))).where("high > low")
    first, last = (F.col("low") / block_words).cast("long"), ((F.col("high") - 1) / block_words).cast("long")
    met = stretch.withColumn("block", F.explode(F.sequence(first, last)))
    same = F.col("source").eqNullSafe(F.col("s_source")) & (F.col("block") == F.col("s_block"))
    begin = F.greatest("low", F.col("block") * block_words)
    end = F.least("high", (F.col("block") + 1) * block_words)
    pieces = met.join(slots.select("slot", F.col("source").alias("s_source"), F.col("block").alias("s_block")), same).select(
        "slot", "doc_id", "row_hash", "copy", "epoch", (begin - F.col("low")).alias("from_word"), (end - begin).alias("n_words"), "size"
    )
    return pieces, held.select("doc_id", "row_hash", "copy", "source", "size", "source_size", "target")


def _row_hash() -> Column:
    """Hash of text and source that tells a null of one from a null of the other."""
    return F.xxhash64("text", F.col("text").isNull(), "source", F.col("source").isNull())


def _numbered(sizes: DataFrame) -> DataFrame:
    """Equal rows told apart by ``copy``; counted first, so that many of them don't meet in one task."""
    same = sizes.groupBy("doc_id", "source", "row_hash", "size").agg(F.count(F.lit(1)).alias("n"))
    return same.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n")


def _taken(docs: DataFrame, keys: list[str], **options) -> DataFrame:
    pieces, totals = mix(docs, **options)
    sums = pieces.groupBy(*[F.col(k).alias(f"p_{k}") for k in keys]).agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"))
    same = [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in keys]
    return totals.join(sums, same, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted, and its first slot in the schedule (null: not taken)."""
    return _taken(docs, ["doc_id", "row_hash", "copy"], **options).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents in the order of the schedule: a row for every time that one is taken, the last of a source cut behind its last word."""
    pieces, _ = mix(docs, **options)
    runs = pieces.groupBy(F.col("doc_id").alias("m_id"), F.col("row_hash").alias("m_hash"), "copy", "epoch").agg(
        F.min("slot").alias("slot"), F.sum("n_words").cast("int").alias("taken"), F.max("size").alias("size")
    )
    held = packed(docs, id_=F.col("doc_id"), hash_=_row_hash()).dropDuplicates(["id_", "hash_"])
    same = F.col("id_").eqNullSafe(F.col("m_id")) & (F.col("hash_") == F.col("m_hash"))
    # Cut behind each word: every part is a word with the white space before it.
    parts_ = F.split(F.col("row_.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("taken") >= F.col("size"), F.col("row_.text")).otherwise(F.array_join(F.slice(parts_, F.lit(1), F.col("taken")), ""))
    row = F.col("row_").withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length(text).cast("long"))
    rows = held.join(runs, same).select(row.alias("row_"), "slot", "id_", "epoch", "copy")
    return rows.orderBy("slot", "id_", "epoch", "copy").select("row_.*")
