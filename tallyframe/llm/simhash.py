"""SimHash near-duplicates found by meet-in-the-middle ball hashing.

A fingerprint is linked to another at ``radius`` (3) or fewer differing bits. The 64 bits are cut into four blocks; at
least one differing bit lies in some block, so without that block two linked fingerprints differ in at most two bits, and
both have a common variant one bit away (half the radius that is left). Every distinct fingerprint emits, for each block left out,
itself and all variants of one bit: 196 keys. Keys are shuffled; inside a key, fingerprints are compared. Up to ``few`` of them
are compared directly; a larger group is linked exactly through stars of variants, at a cost in proportion to
its size: see ``_large_groups``. Copies share a fingerprint and are counted once. Links of a task are reduced to stars, and
components follow by alternating large and small stars.

Defined results: null and empty texts have the fingerprint zero and are linked like any other; null ids form
a component's smallest id only if there is no other; repeated rows have equal fingerprints. Only ``doc_id`` and ``text`` are read.

``one_of_each``, the pipeline's stage, keeps one document of each component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, packed, parts, saved, words
from .components import components

BLOCKS = 4
WIDTH = 64 // BLOCKS
KEYS = BLOCKS * (1 + 64 - WIDTH)
KEPT = np.uint64((1 << (64 - WIDTH)) - 1)


def shingle_hashes(text: Column, n: int = 3) -> Column:
    """XXH64 (seed 42) of every shingle of ``n`` lower-cased words, repeats included; of the whole sequence if there are fewer."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    several = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
    )
    whole = lambda w: F.array(F.xxhash64(F.array_join(w, " ")))
    none = F.array().cast("array<bigint>")
    return F.get(F.transform(F.array(words(low)), lambda w: F.when(F.size(w) >= n, several(w)).when(F.size(w) > 0, whole(w)).otherwise(none)), F.lit(0))


def _majority(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits set in over half of a document's hashes."""
    for batch in batches:
        lists = batch.column("hashes")
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        out = np.zeros(len(lists), np.uint64)
        begin = 0
        while begin < len(lists):  # some documents at a time: their hashes' bits take 64 bytes each
            stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + 200_000, "right")) - 1)
            stop = min(stop, len(lists))
            part = flat[ends[begin] : ends[stop]]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sizes = np.diff(ends[begin : stop + 1])
            full = np.flatnonzero(sizes)
            if len(full):
                ones = np.add.reduceat(bits, (ends[begin:stop] - ends[begin])[full], axis=0, dtype=np.int64)
                set_ = np.packbits(2 * ones > sizes[full, None], axis=1, bitorder="little")
                out[begin + full] = np.ascontiguousarray(set_).view(np.uint64)[:, 0]
            begin = stop
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "hashes"), pa.array(out.view(np.int64))], names=[*(c for c in batch.schema.names if c != "hashes"), "fp"])


def majority(rows: DataFrame, hashes: str, *keys: str) -> DataFrame:
    """``keys`` and ``fp``: bits set in over half of the column ``hashes``, as a signed long; zero for none. The same as ``_majority``,
    without Python workers: the hashes are exploded and their bits summed by a grouping of each row, so that every bit is counted
    by compiled code once per hash; two bits' counts share a long (low and high 32 bits), since no text has 2**32 shingles."""
    one = F.lit(1).cast("long")
    bit = lambda b: F.shiftrightunsigned("h_", b).bitwiseAND(one)
    sums = [F.sum(bit(b).bitwiseOR(F.shiftleft(bit(b + 32), 32))).alias(f"s{b}_") for b in range(32)]
    numbered = rows.select(F.monotonically_increasing_id().alias("row_"), *keys, hashes)  # apart from the explode, or each hash gets an id
    each = numbered.select("row_", *keys, F.explode_outer(hashes).alias("h_"))
    counted = each.groupBy("row_", *keys).agg(F.count("h_").alias("n_"), *sums)
    fp = F.lit(0).cast("long")
    for b in range(32):
        s_ = F.coalesce(F.col(f"s{b}_"), F.lit(0).cast("long"))
        for at, count in ((b, s_.bitwiseAND(F.lit(0xFFFFFFFF))), (b + 32, F.shiftrightunsigned(s_, 32))):
            fp = fp.bitwiseOR(F.when(2 * count > F.col("n_"), F.shiftleft(one, at)).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, fp.alias("fp"))


def fingerprints(docs: DataFrame, n: int = 3) -> DataFrame:
    """``doc_id``, ``text_hash`` and the 64-bit fingerprint ``fp`` as a signed long; the majority is taken in the JVM, so that no Python worker holds the hashes."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), shingle_hashes(F.col("text"), n).alias("hashes"))
    return majority(rows, "hashes", "doc_id", "text_hash")


def _turned(fp: np.ndarray, block: int) -> np.ndarray:
    """The bits rotated so that ``block`` comes to the top."""
    by = WIDTH * (block + 1) % 64
    return (fp >> np.uint64(by)) | (fp << np.uint64(64 - by)) if by else fp


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each fingerprint: the block's number above the bits outside the block, as they are and with one flipped."""
    flips = np.array([0] + [1 << i for i in range(64 - WIDTH)], np.uint64)[:, None]
    for batch in batches:
        every = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for begin in range(0, len(every), 2000):
            fp = every[begin : begin + 2000]
            keys = [(_turned(fp, b) & KEPT | np.uint64(b << (64 - WIDTH)))[None, :] ^ flips for b in range(BLOCKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).ravel().view(np.int64)), pa.array(np.tile(fp, KEYS).view(np.int64))], names=["key", "fp"]
            )


def _star(keys: np.ndarray, fp: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every fingerprint to the smallest centre of its key; a key without a centre gives none."""
    order = np.lexsort((fp, ~centre, keys))
    keys, fp, centre = keys[order], fp[order], centre[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    head = np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))
    linked = centre[head] & (fp != fp[head])
    return fp[linked], fp[head][linked]


def _large_groups(group: np.ndarray, key: np.ndarray, fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """All links within groups of one key, as stars whose edges are links themselves.

    Members have at most one bit outside the block that differs from the key, so two of them differ there in two at most;
    their contents of the block differ in ``d``. d <= 1: star on each content of those that hold it and those one bit from
    it. d = 2: one of the two is the key itself outside the block; it is the centre on contents within one bit.
    d = 3: both are; contents within one bit are centres, those two bits away join.
    """
    turned = np.zeros_like(fp)
    for b in range(BLOCKS):
        of = key >> np.uint64(64 - WIDTH) == b
        turned[of] = _turned(fp[of], b)
    content = turned >> np.uint64(64 - WIDTH)
    exact = (turned & KEPT) == (key & KEPT)
    base = group.astype(np.uint64) << np.uint64(WIDTH)
    ones = np.array([1 << i for i in range(WIDTH)], np.uint64)
    twos = np.array([1 << i | 1 << j for i in range(WIDTH) for j in range(i)], np.uint64)

    def keyed(rows: np.ndarray, near: np.ndarray) -> np.ndarray:
        return (base[rows, None] | (content[rows, None] ^ near[None, :])).ravel()

    every = np.arange(len(fp))
    within = np.concatenate([np.zeros(1, np.uint64), ones])
    found = []
    n = len(within)
    found.append(_star(keyed(every, within), np.repeat(fp, n), np.tile(np.arange(n) == 0, len(fp))))
    found.append(_star(keyed(every, within), np.repeat(fp, n), np.repeat(exact, n)))
    held = np.flatnonzero(exact)
    far = np.concatenate([within, twos])
    found.append(_star(keyed(held, far), np.repeat(fp[held], len(far)), np.tile(np.arange(len(far)) < n, len(held))))
    return found


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges of a task as stars around the smallest fingerprint of each connected part."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, root[u], least)
        np.minimum.at(new, root[v], least)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]]


def _linker(few: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compares the fingerprints of each key; the task holds its own keys only."""
        got = [(b.column("key").to_numpy(zero_copy_only=False), b.column("fp").to_numpy(zero_copy_only=False)) for b in batches]
        if not got:
            return
        key = np.concatenate([k for k, _ in got]).view(np.uint64)
        fp = np.concatenate([f for _, f in got]).view(np.uint64)
        del got
        order = np.argsort(key)
        key, fp = key[order], fp[order]
        same = key[1:] == key[:-1]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        key, fp = key[several], fp[several]
        if not len(key):
            return
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(first) - 1
        sizes = np.bincount(group)
        small = sizes[group] <= few
        pairs = []
        k, f = key[small], fp[small]
        for o in range(1, few):
            i = np.flatnonzero(k[o:] == k[:-o])
            if not len(i):
                break
            i = i[np.bitwise_count(f[i] ^ f[i + o]) <= 3]
            pairs.append((f[i], f[i + o]))
        big = np.flatnonzero(~small)
        if len(big):
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes[group[big]] * 0 + 1) // 200_000)) + 1
            starts = np.unique(np.concatenate([[0], [int(np.searchsorted(group[big], group[big][c])) for c in cuts], [len(big)]])).astype(int)
            for a, b in zip(starts[:-1], starts[1:]):
                rows = big[a:b]
                pairs += _large_groups(group[rows], key[rows], fp[rows])
        a, b = (np.concatenate(x) for x in zip(*pairs))
        if len(a):
            a, b = _forest(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return links


def _grouped(docs: DataFrame, shingle: int, few: int, rows_a_task: int) -> tuple[DataFrame, DataFrame]:
    """Documents' fingerprints, and for each fingerprint ``n_fp`` its component's smallest id and first row."""
    found = saved(fingerprints(docs, shingle))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.col("text_hash").alias("hash")))
    distinct = saved(found.groupBy("fp").agg(F.min("doc_id").alias("least_id"), first.alias("first_row")))
    tasks = parts(distinct.count() * KEYS, rows_a_task)
    keys = distinct.select("fp").mapInArrow(_emit, "key long, fp long")
    edges = keys.repartition(tasks, "key").mapInArrow(_linker(few), "a long, b long")
    roots = components(edges)
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy(F.col("root").alias("of")).agg(F.min("least_id").alias("component_id"), F.min("first_row").alias("component_row"))
    return found, named.join(least, named["root"] == least["of"]).select(F.col("fp").alias("n_fp"), "component_id", "component_row")


def near_groups(docs: DataFrame, *, shingle: int = 3, few: int = 32, rows_a_task: int = 1_500_000) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest id that links lead to."""
    found, by_fp = _grouped(docs, shingle, few, rows_a_task)
    return found.join(by_fp, found["fp"] == by_fp["n_fp"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, *, shingle: int = 3, few: int = 32, rows_a_task: int = 1_500_000) -> DataFrame:
    """``docs`` with one row of each component of ``near_groups``: the smallest id's, of rows with that id the smallest text hash's."""
    _, by_fp = _grouped(docs, shingle, few, rows_a_task)
    stay = saved(by_fp.select(F.col("component_row.id").alias("stay_id"), F.col("component_row.hash").alias("stay_hash")).distinct())
    held = packed(docs, id_=F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), hash_=F.xxhash64("text"))
    same = (F.col("id_") == F.col("stay_id")) & (F.col("hash_") == F.col("stay_hash"))
    return held.join(stay, same, "left_semi").dropDuplicates(["id_", "hash_"]).select("row_.*")
