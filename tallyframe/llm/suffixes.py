"""Removal of byte strings that repeat across documents, by a sparse suffix array built in sorted ranges.

Every string of ``length`` bytes (a window) has an anchor: the suffix, starting in it, whose first ``GRAM`` bytes have the
smallest hash there. Equal windows have equal anchors at equal places, so only anchored suffixes are sorted, about one in 16.

1. Documents are dealt to buckets. A bucket sends each of its anchors' keys once; where a key comes from two buckets, or
   two documents of one, the buckets that sent it are told. Anchors nobody else has go no further.
2. Buckets send the others with their surroundings (the windows they anchor). Surroundings that are equal within a bucket are sent for
   the smallest document only; the others' windows are settled there. Splitters sampled from the suffixes' leading eight bytes
   deal them to ranges. Equal leading bytes never straddle a boundary, so no comparison across boundaries is left.
3. A range is sorted by multikey quicksort: by one eight-byte token after another, only what is still equal going on. Equal
   surroundings settle all windows of all but the smallest document; where one anchor has different surroundings, their windows are
   sorted in the same way. A window is removed where a document with a smaller id has it.
4. Buckets gather the removed windows and cut the bytes.

A text is shuffled once, to its bucket; all steps use that shuffle. No task holds more than a bucket, a range or the senders of some keys; a
text that all documents share counts once a bucket.

Defined results: null texts are empty; texts shorter than ``length`` keep all; a null id counts as larger than any other and is not
smaller than itself; rows with equal ids are judged alike and never against one another. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, parts

GRAM = 20
CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
KEY_BITS = np.uint64((1 << 40) - 1)


class Texts:
    """Documents of a bucket as one run of bytes."""

    def __init__(self, table: pa.Table):
        held = table["text"].combine_chunks().cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
        data = held.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(held) else np.zeros(0, np.uint8)
        self.ends = offsets[1:] - offsets[0]
        self.starts = offsets[:-1] - offsets[0]
        self.order = table["doc_id"].fill_null(LAST_ID).to_numpy()
        self.row = table["row_id"].to_numpy()


def _hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (16 + 4) bytes from each place on, by doubling."""
    power = lambda k: np.uint64(pow(int(BASE), k, 1 << 64))
    h, held = (data.astype(np.uint64) + np.uint64(1)) * MIX, {}
    for size in (1, 2, 4, 8):
        h = h[:-size] * power(size) + h[size:]
        held[2 * size] = h
    h = h[: len(h) - 4] * power(4) + held[4][16 : 16 + len(h) - 4]
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


def anchors(texts: Texts, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``first, last, at, doc, key``: windows from ``first`` to ``last`` of a document have their anchor at ``at``."""
    span = length - GRAM + 1
    low = np.uint64(0xFFFFFFFF)
    for begin in range(0, max(0, len(texts.data) - length + 1), CHUNK):
        stop = min(begin + CHUNK, len(texts.data) - length + 1)
        h = _hashes(texts.data[begin : stop + length - 1])
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < span:
            least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
        at = (least & low).astype(np.int64)[: stop - begin]
        window = np.arange(begin, stop)
        doc = np.searchsorted(texts.ends, window, side="right")
        inside = window + length <= texts.ends[np.minimum(doc, len(texts.ends) - 1)]
        window, at, doc = window[inside], at[inside], doc[inside]
        if not len(window):
            continue
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (window[1:] != window[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(window)]]) - 1
        yield window[first], window[last], at[first] + begin, doc[first], h[at[first]] & KEY_BITS


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and each sorted row's group of equal rows: token by token, only ties go on."""
    n = len(words)
    order, group = np.arange(n), np.zeros(n, np.int64)
    active = np.arange(n)
    for d in range(words.shape[1]):
        if not len(active):
            break
        token = words[order[active], d]
        by = np.lexsort((token, group[active]))
        order[active] = order[active][by]
        token, held = token[by], group[active]
        new = np.concatenate([[True], (held[1:] != held[:-1]) | (token[1:] != token[:-1])])
        group[active] = active[np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))]
        held = group[active]
        same = held[1:] == held[:-1]
        tied = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        active = active[tied]
    return order, group


def _tokens(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Bytes from each start on as big-endian eight-byte tokens, zeros behind each size."""
    width = -(-width // 8) * 8
    cells = np.arange(width)
    place = np.minimum(starts[:, None] + cells, max(0, len(data) - 1))
    held = np.where(cells < sizes[:, None], data[place], 0).astype(np.uint8)
    return held.view(">u8").astype(np.uint64)


def _leading(texts: Texts, at: np.ndarray) -> np.ndarray:
    return _tokens(texts.data, at, np.full(len(at), 8), 8)[:, 0]


def _raw(x: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(part[rows[0]]), rows


SENT = "part int, bucket long, keys binary, twice binary"
TOLD = "bucket long, keys binary"
AROUND = "part int, bucket long, around binary, sizes binary, lead binary, windows binary, first binary, doc binary, row binary, done binary"
CUTS = "bucket long, doc binary, row binary, first binary, last binary"


def _sender(length: int, key_parts: int):
    def send(table: pa.Table) -> pa.Table:
        texts = Texts(table)
        keys, docs = [], []
        for _, _, _, doc, key in anchors(texts, length):
            keys.append(key)
            docs.append(doc)
        bucket = table["bucket"][0].as_py()
        out: list[tuple] = []
        if keys:
            key, doc = np.concatenate(keys), np.concatenate(docs)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            final = np.concatenate([first[1:], [len(key)]]) - 1
            twice, key = doc[first] != doc[final], key[first]
            for part, rows in _by_part((key % np.uint64(key_parts)).astype(np.int64)):
                five = key[rows].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                out.append((part, bucket, _raw(five, "u1"), _raw(twice[rows], "u1")))
        return _table(out, SENT)

    return send


def _keys(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that several documents sent, for each bucket that sent them."""
    keys, twice, bucket = [], [], []
    for b in batches:
        for of, k, t in zip(b.column("bucket").to_pylist(), b.column("keys").to_pylist(), b.column("twice").to_pylist()):
            keys.append(_keys(k))
            twice.append(np.frombuffer(t, np.uint8))
            bucket.append(np.full(len(keys[-1]), of))
    if not keys:
        return
    key, two, of = np.concatenate(keys), np.concatenate(twice), np.concatenate(bucket)
    order = np.argsort(key, kind="stable")
    key, two, of = key[order], two[order], of[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.cumsum(first) - 1
    shared = ((np.bincount(group) > 1) | (np.bincount(group, two) > 0))[group]
    rows = [(b, _raw(key[shared][at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5], "u1")) for b, at in _by_part(of[shared])]
    yield from _table(rows, TOLD).to_batches()


def _surrounder(length: int, splitters: np.ndarray):
    def surround(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([], AROUND)
        texts = Texts(left)
        known = np.unique(_keys(b"".join(right["keys"].to_pylist())))
        held = []
        for first, last, at, doc, key in anchors(texts, length):
            there = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
            held.append([x[there] for x in (first, last, at, doc)])
        first, last, at, doc = (np.concatenate(x) for x in zip(*held))
        if not len(first):
            return _table([], AROUND)
        sizes = last - first + length
        # Equal surroundings within the bucket: the smallest document stands for all, the others are settled.
        words = np.concatenate([(at - first).astype(np.uint64)[:, None], sizes.astype(np.uint64)[:, None], _tokens(texts.data, first, sizes, 2 * length)], axis=1)
        order, group = multikey_sort(words)
        del words
        least = np.full(len(order), LAST_ID)
        np.minimum.at(least, group, texts.order[doc[order]])
        settled = np.zeros(len(order), bool)
        settled[order] = texts.order[doc[order]] > least[group]
        part = np.searchsorted(splitters, _leading(texts, at), side="right")
        bucket = left["bucket"][0].as_py()
        out = []
        for p, rows in _by_part(part):
            done = rows[settled[rows]]
            rows = rows[~settled[rows]]
            n = sizes[rows]
            flat = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            d = np.concatenate([doc[rows], doc[done]])
            begin = np.concatenate([first[rows], first[done]]) - texts.starts[d]
            count = np.concatenate([last[rows] - first[rows], last[done] - first[done]]) + 1
            out.append((p, bucket, texts.data[flat].tobytes(), _raw(n, "<u2"), _raw(at[rows] - first[rows], "<u2"), _raw(count, "<u2"), _raw(begin, "<i8"), _raw(texts.order[d], "<i8"), _raw(texts.row[d], "<i8"), _raw([len(rows)], "<i8")))
        return _table(out, AROUND)

    return surround


def _judge(length: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One range after another."""
        by_part: dict[int, list[dict]] = {}
        for b in batches:
            for row in b.to_pylist():
                by_part.setdefault(row["part"], []).append(row)
        for part in sorted(by_part):
            yield from _judged(by_part.pop(part), length).to_batches()

    return judge


def _judged(rows: list[dict], length: int) -> pa.Table:
    get = lambda name, kind: [np.frombuffer(r[name], kind) for r in rows]
    join = lambda name, kind: np.concatenate(get(name, kind)).astype(np.int64)
    open_ = np.concatenate([np.arange(len(d)) < n[0] for d, n in zip(get("doc", "<i8"), get("done", "<i8"))])
    bucket = np.concatenate([np.full(len(d), r["bucket"]) for d, r in zip(get("doc", "<i8"), rows)])
    doc, row, begin, count = (join(n, k) for n, k in (("doc", "<i8"), ("row", "<i8"), ("first", "<i8"), ("windows", "<u2")))
    sizes, lead = join("sizes", "<u2"), join("lead", "<u2")
    data = np.concatenate(get("around", np.uint8))
    starts = np.cumsum(sizes) - sizes
    cut_at, cut_first, cut_last = [np.flatnonzero(~open_)], [begin[~open_]], [(begin + count - 1)[~open_]]
    at = np.flatnonzero(open_)
    if len(at):
        # Suffixes from the anchor on, then what stands before it.
        suffix = _tokens(data, starts + lead, sizes - lead, 2 * length)
        before = _tokens(data, starts, lead, length)
        words = np.concatenate([suffix, before, lead[:, None].astype(np.uint64), sizes[:, None].astype(np.uint64)], axis=1)
        order, group = multikey_sort(words)
        least = np.full(len(order), LAST_ID)
        np.minimum.at(least, group, doc[at[order]])
        least = least[group]
        later = doc[at[order]] > least
        hit = at[order[later]]
        cut_at.append(hit)
        cut_first.append(begin[hit])
        cut_last.append(begin[hit] + count[hit] - 1)
        # One of each kind of surroundings stands for its smallest document; anchors with several kinds are compared window by window.
        heads = np.flatnonzero(group == np.arange(len(group)))
        grams = words[order[heads]][:, : GRAM // 8 + 1].copy()
        grams[:, -1] >>= np.uint64(8 * (8 - GRAM % 8))
        new = np.concatenate([[True], (grams[1:] != grams[:-1]).any(1)])
        kind = np.cumsum(new) - 1
        several = (np.bincount(kind) > 1)[kind]
        heads = heads[several]
        if len(heads):
            cut = _windows(data, starts[order[heads]], count[at[order[heads]]], lead[order[heads]], kind[several], least[heads], length)
            if len(cut[0]):
                # All rows of the kind that belong to its smallest document get its cuts.
                of_group = np.full(len(group), -1)
                of_group[heads] = np.arange(len(heads))
                mine = np.flatnonzero(~later & (of_group[group] >= 0))
                slot = of_group[group[mine]]
                by = np.argsort(slot, kind="stable")
                mine, slot = mine[by], slot[by]
                low, high = np.searchsorted(slot, cut[0], "left"), np.searchsorted(slot, cut[0], "right")
                n = high - low
                pick = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                hit = at[order[mine[pick]]]
                cut_at.append(hit)
                cut_first.append(begin[hit] + np.repeat(cut[1], n))
                cut_last.append(begin[hit] + np.repeat(cut[2], n))
    hit, first, last = np.concatenate(cut_at), np.concatenate(cut_first), np.concatenate(cut_last)
    out = [(b, _raw(doc[hit[i]], "<i8"), _raw(row[hit[i]], "<i8"), _raw(first[i], "<i8"), _raw(last[i], "<i8")) for b, i in _by_part(bucket[hit])]
    return _table(out, CUTS)


def _windows(data, starts, counts, lead, kind, doc, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of removed windows: place in the input, first and last window. Some anchors at a time."""
    found = []
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(kind)) + 1, [len(kind)]])
    total = np.concatenate([[0], np.cumsum(counts)])
    a = 0
    while a < len(bounds) - 1:
        b = max(a + 1, int(np.searchsorted(total[bounds], total[bounds[a]] + 200_000, "right")) - 1)
        rows = np.arange(bounds[a], bounds[b])
        n = counts[rows]
        of = np.repeat(rows, n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = (lead[of] - step).astype(np.uint64)  # of the anchor in the window
        words = np.concatenate([kind[of].astype(np.uint64)[:, None], place[:, None], _tokens(data, starts[of] + step, np.full(len(of), length), length)], axis=1)
        order, group = multikey_sort(words)
        least = np.full(len(order), LAST_ID)
        np.minimum.at(least, group, doc[of[order]])
        gone = np.zeros(len(order), bool)
        gone[order] = doc[of[order]] > least[group]
        at = np.flatnonzero(gone)
        if len(at):
            new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(at)]]) - 1
            found.append((of[at[first]], step[at[first]], step[at[last]]))
        a = b
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 3


def _cutter(length: int):
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = Texts(left) if left.num_rows else None
        raw = {c: b"".join(right[c].to_pylist()) for c in ("doc", "row", "first", "last")}
        doc, row, first, last = (np.frombuffer(raw[c], "<i8") for c in ("doc", "row", "first", "last"))
        by = np.lexsort((first, row))
        doc, row, first, last = doc[by], row[by], first[by], last[by]
        out: list[tuple] = []
        for i in range(left.num_rows):
            whole = texts.data[texts.starts[i] : texts.ends[i]]
            low, high = np.searchsorted(row, [texts.row[i]], "left")[0], np.searchsorted(row, [texts.row[i]], "right")[0]
            mine = np.arange(low, high)[doc[low:high] == texts.order[i]]
            edges = np.zeros(len(whole) + 1, np.int32)
            np.add.at(edges, first[mine], 1)
            np.add.at(edges, last[mine] + length, -1)
            gone = np.cumsum(edges)[:-1] > 0
            change = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
            begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            out.append((len(whole), whole[~gone].tobytes(), begin.tolist(), (end - begin).tolist()))
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.table([left["doc_id"].combine_chunks() if left.num_rows else pa.array([], pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "n_bytes", "kept", "span_starts", "span_lengths"])

    return cut


def remove_repeats(docs: DataFrame, *, length: int = 50, bucket_bytes: int = 6 << 20, bucket_docs: int = 4000, range_bytes: int = 8 << 20, sample_docs: int = 1000) -> DataFrame:
    """``doc_id, n_bytes, kept`` (bytes), ``span_starts, span_lengths`` for every document. The driver holds two numbers and the splitters."""
    held = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n, size = held.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(parts(size, bucket_bytes), parts(n, bucket_docs))
    ranges = parts(size, range_bytes)
    key_parts = parts(size, 16 << 20)
    row_id = F.xxhash64("doc_id", "text")
    dealt = held.withColumn("row_id", row_id).withColumn("bucket", F.pmod(F.col("row_id"), F.lit(buckets)).cast("long"))
    share = int(min(1.0, sample_docs / max(1, n)) * (1 << 30))
    some = dealt.where(F.pmod(F.shiftright("row_id", 20), F.lit(1 << 30)) <= share).select("doc_id", "row_id", "text").limit(2 * sample_docs)
    splitters = _splitters(some, length, ranges)
    by_bucket = dealt.groupBy("bucket")
    told = by_bucket.applyInArrow(_sender(length, key_parts), SENT).repartition(key_parts, "part").mapInArrow(_tell, TOLD)
    around = by_bucket.cogroup(told.groupBy("bucket")).applyInArrow(_surrounder(length, splitters), AROUND)
    cuts = around.repartition(ranges, "part").mapInArrow(_judge(length), CUTS)
    out = "doc_id long, n_bytes long, kept binary, span_starts array<long>, span_lengths array<long>"
    return by_bucket.cogroup(cuts.groupBy("bucket")).applyInArrow(_cutter(length), out)


def _splitters(some: DataFrame, length: int, ranges: int) -> np.ndarray:
    """Quantiles of the leading bytes of suffixes sampled from a bounded number of documents; they steer the ranges' sizes only."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                texts = Texts(pa.Table.from_batches([b]))
                for _, _, at, _, _ in anchors(texts, length):
                    yield pa.RecordBatch.from_arrays([pa.array(_leading(texts, at[::16]).view(np.int64))], names=["lead"])

    found = np.sort(some.mapInArrow(lead, "lead long").toArrow()["lead"].to_numpy().view(np.uint64))
    if ranges < 2 or not len(found):
        return np.zeros(0, np.uint64)
    return np.unique(found[np.linspace(0, len(found) - 1, ranges + 1).astype(int)[1:-1]])
