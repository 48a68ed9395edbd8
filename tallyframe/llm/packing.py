"""Bulk-synchronous best-fit packing of token sequences.

Documents become pieces of at most ``size`` ids. Pieces of one length can stand for one another, so the rounds work on
length classes, of which there are at most ``size``, whatever the number of documents: pieces and gaps are sorted by size, a
sweep from the largest down gives every piece its successor (the smallest gap left that takes it), the k-th piece of a
class takes the k-th gap of the matched class (conflicts are resolved by rank), gaps shrink, and the next round follows.
When no gap takes a piece, new sequences are opened for the largest ones: one for each piece over half the size, else as many as the
remaining ids need. Spark ranks the pieces inside their classes, in buckets, and joins each with its class's run of sequences.

Defined results: null and empty texts are a piece of the end id alone; null ids stay null; repeated rows are packed as
rows of their own; an empty table gives no piece. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, saved
from .tokens import encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
FIT = "length long, first long, last long, sequence long, offset long"


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, slice_bytes: int = 8 << 20) -> DataFrame:
    """One row per piece of each document's ids, ``end_id`` behind them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids_of = batch.column("doc_id").to_pylist()
            begin = 0
            while begin < len(texts):
                stop, held = begin, 0
                while stop < len(texts) and (stop == begin or held < slice_bytes):
                    held += len(texts[stop] or "")
                    stop += 1
                got, ends = encode.batch([t or "" for t in texts[begin:stop]])
                rows: list[tuple] = []
                last = 0
                for doc, upto in zip(ids_of[begin:stop], ends.tolist()):
                    whole = np.append(got[last:upto], np.uint32(end_id)).astype("<u4")
                    last = upto
                    for k, at in enumerate(range(0, len(whole), size)):
                        piece = whole[at : at + size]
                        rows.append((doc, k, at, len(piece), zlib.crc32(piece.tobytes())))
                begin = stop
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE)


def sweep(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds over length classes: runs ``(length, first rank, last rank, first sequence, offset)``, last exclusive.

    The state is a number of pieces for each length and, for each size of gap, runs of consecutive sequences.
    """
    left = {n: c for n, c in counts.items() if c}
    rank: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[list[int]]] = defaultdict(list)
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(length: int, gap: int, run: list[int]) -> None:
        first, n = run
        out.append((length, rank[length], rank[length] + n, first, size - gap))
        rank[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]
        if gap > length:
            fresh[gap - length].append([first, n])

    while left:
        fresh: dict[int, list[list[int]]] = defaultdict(list)
        matched = False
        stack: list[tuple[int, list[int]]] = []
        values = sorted({*left, *gaps}, reverse=True)
        for v in values:  # from the largest down: gaps go on the stack, pieces take the smallest ones that are on it
            stack.extend((v, run) for run in gaps.get(v, ()))
            while v in left and stack:
                gap, run = stack.pop()
                n = min(run[1], left[v])
                place(v, gap, [run[0], n])
                matched = True
                if run[1] > n:
                    stack.append((gap, [run[0] + n, run[1] - n]))
        for gap, run in stack:
            fresh[gap].append(run)
        if not matched:
            ids = sum(n * c for n, c in left.items())
            room = -(-ids // size)
            for v in sorted(left, reverse=True):
                n = left[v] if 2 * v > size else min(left[v], room)
                if n <= 0:
                    break
                place(v, size, [opened, n])
                opened += n
                room -= n
        smallest = min(left, default=size + 1)
        gaps = defaultdict(list, {g: _joined(r) for g, r in fresh.items() if g >= smallest})
    return out


def _joined(runs: list[list[int]]) -> list[list[int]]:
    """Neighbouring runs as one."""
    out: list[list[int]] = []
    for first, n in sorted(runs):
        if out and out[-1][0] + out[-1][1] == first:
            out[-1][1] += n
        else:
            out.append([first, n])
    return out


def pack(docs: DataFrame, tokenizer: str, *, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Every piece with ``sequence_id`` and its ``offset`` there. The driver holds the counts of at most ``size`` lengths."""
    spark = docs.sparkSession
    held = saved(pieces(docs, tokenizer, size, end_id))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = parts(sum(counts.values()), 5000)
    runs = spark.createDataFrame(sweep(counts, size), FIT)
    dealt = held.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    met = bases.join(runs, "length").where("first < base + n AND last > base").withColumnsRenamed({"length": "r_length", "bucket": "r_bucket"}).drop("n")
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("inside", inside)
    place = F.col("base") + F.col("inside")
    same = (F.col("length") == F.col("r_length")) & (F.col("bucket") == F.col("r_bucket")) & (place >= F.col("first")) & (place < F.col("last"))
    return ranked.join(met, same).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + place - F.col("first")).alias("sequence_id"), "offset"
    )
