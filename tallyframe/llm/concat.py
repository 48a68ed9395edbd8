"""Concatenate and cut: all token ids in one line, cut into windows of equal size.

Two passes of prefix sums give every document its place on the line. Pass one encodes the documents of each partition
and sums their ids as it goes, so a row knows how many ids of its partition lie before it; the partitions' totals, one row
each, are summed in order and give each partition's base. Pass two cuts each document at the window borders. Windows
hold ``size`` ids. Padding is needed only where a sequence's length is no power of two, so the ids behind the last whole
window are cut into windows of the powers of two that make up their number: nothing is padded at all.

``sequences`` puts the windows together: those that lie inside one task are whole at once; what a task holds of a window
that others share is a boundary record, and only these are shuffled.

Defined results: null and empty texts are the end id alone; null ids stay null; repeated rows are rows of their own; an
empty table gives no piece. Only ``doc_id`` and ``text`` are read. A document's ids are one value of a row, as its text is.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_tokens import byte_encoder
from .common import saved

LINE = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])
RECORD = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("whole", pa.bool_()), ("ids", pa.binary())])


def _columns(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def line(docs: DataFrame, tokenizer: str, end_id: int = 0, slice_bytes: int = 8 << 20) -> DataFrame:
    """Each document's ids (unsigned 32 bits, little-endian) with the number of ids of its partition before it."""
    end = end_id.to_bytes(4, "little")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, before = byte_encoder(tokenizer).ids, TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = ids_of(text.as_py() or "") + end
                rows.append((part, before, doc, len(ids) // 4, ids))
                before += len(ids) // 4
                held += len(ids)
                if held > slice_bytes:
                    yield _batch(rows, LINE)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, LINE)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encoded, _columns(LINE))


def last_windows(total: int, size: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the windows behind the whole ones: the powers of two that make up what is left, largest first."""
    rest = total % size
    lengths = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return list(zip(accumulate(lengths, initial=total - rest), lengths))


def _cutter(total: int, size: int, with_ids: bool):
    whole = total // size
    last = last_windows(total, size)
    starts = [a for a, _ in last]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            columns = [batch.column(c).to_pylist() for c in ("base", "before", "doc_id", "doc_tokens")]
            for base, before, doc, n, value in zip(*columns, batch.column("ids")):
                ids, at = value.as_py(), 0
                while at < n:
                    place = base + before + at
                    if place < whole * size:
                        sequence, offset = divmod(place, size)
                        room = size - offset
                    else:
                        k = bisect_right(starts, place) - 1
                        sequence, offset = whole + k, place - starts[k]
                        room = last[k][1] - offset
                    take = min(room, n - at)
                    piece = ids[4 * at : 4 * (at + take)]
                    rows.append((doc, at, take, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None))
                    at += take
                held += len(ids)
                if held > 16 << 20:
                    yield _batch(rows, PIECE)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, PIECE)

    return pieces


def pack(docs: DataFrame, tokenizer: str, *, size: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset`` there, its ids too if asked for. The driver holds one total a partition."""
    spark = docs.sparkSession
    held = saved(line(docs, tokenizer, end_id))
    totals = sorted(held.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect())
    bases = list(accumulate((r["n"] for r in totals), initial=0))
    placed = held.join(F.broadcast(spark.createDataFrame([(r["part"], b) for r, b in zip(totals, bases)], "part int, base long")), "part")
    cut = placed.mapInArrow(_cutter(bases[-1], size, with_ids), _columns(PIECE))
    return cut if with_ids else cut.drop("ids")


def _joiner(total: int, size: int):
    """Neighbouring pieces of a task as records, each a window or what the task holds of it."""
    whole, last = total // size, last_windows(total, size)

    def record(sequence: int, offset: int, ids: list[bytes]) -> tuple:
        raw = b"".join(ids)
        room = size if sequence < whole else last[sequence - whole][1]
        return sequence, offset, len(raw) // 4, len(raw) == 4 * room, raw

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, offset, upto, ids = None, 0, 0, []
        for batch in batches:
            rows = []
            for s, o, n, value in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "offset", "length")), batch.column("ids")):
                if (s, o) != (sequence, upto):
                    if ids:
                        rows.append(record(sequence, offset, ids))
                    sequence, offset, upto, ids = s, o, o, []
                ids.append(value.as_py())
                upto += n
            if rows:
                yield _batch(rows, RECORD)
        if ids:
            yield _batch([record(sequence, offset, ids)], RECORD)

    return records


def sequences(pieces: DataFrame, *, size: int = 1024) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids`` of all windows of pieces that carry their ids. ``padding`` is what a batch of ``size`` adds: none at a power of two."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    records = saved(pieces.select("sequence_id", "offset", "length", "ids").mapInArrow(_joiner(total, size), _columns(RECORD)))
    shared = records.where("NOT whole").groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    glued = F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    every = records.where("whole").select("sequence_id", "ids").unionByName(shared.select("sequence_id", glued.alias("ids")))
    n = (F.octet_length("ids") / 4).cast("long")
    return every.select("sequence_id", n.alias("length"), F.when(F.bit_count(n) == 1, 0).otherwise(size - n).cast("long").alias("padding"), "ids")
