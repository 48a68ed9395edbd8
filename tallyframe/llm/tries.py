"""Prefix trie of conversations: one row for each distinct sequence of first turns.

A turn is 128 bits of its role and text, a conversation the list of its turns (a path). Paths are range-partitioned in
lexicographic order into shards, equal ones by id, so every node is a run of neighbouring rows. A shard makes dense turn ids,
sorts its padded id matrix with numpy's lexsort, a block of columns at a time and only rows that still tie, and compares
neighbours: a node of depth d starts at a row that differs from the one before in its first d columns (change masks, OR-accumulated over the
columns). At each depth, reduceat over the runs gives members, smallest id, children, leaves and saved tokens. All of these are
sums over rows once each node is counted at its first row and each leaf at its last, subtrees included. A shard knows the last path before
it and the first one behind it, so runs that go on in other shards are counted there without repeats: their parts (boundary nodes) are
recombined by a sum, everything else is final in its shard.

Defined results: rows without a conversation id belong to none and are left out; null role and text are empty, null turns come first;
turns with equal numbers are ordered by their 128 bits; repeated rows are turns of their own; a conversation without turns is a member of
the root; an empty table gives no node. A path takes 20 bytes a turn and is one value of a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_words, parts, saved

WIDTH = 32
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = pa.schema([
    ("shard", pa.int32()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("shared", pa.bool_()),
    ("hi", pa.int64()), ("lo", pa.int64()), ("parent_hi", pa.int64()), ("parent_lo", pa.int64()), ("ends", pa.string()),
])
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_paths(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, the list of structs ``turn, hi, lo, words`` in order, of rows ``conv_id, turn, role, text``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hi, lo = (F.xxhash64(F.lit(seed), role, text) for seed in (1, 2))
    turn = F.struct("turn", hi.alias("hi"), lo.alias("lo"), n_words(text).cast("int").alias("words"))
    known = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    return known.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_heads(paths: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % ``every``; h = crc32(decimal c) % (``most`` + 1)."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = paths.where(c % every == 0).select(c.alias("base"), F.slice("turns", 1, most).alias("head"))
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), h)).otherwise(F.slice("turns", 1, 0))
    own = F.slice("turns", h + 1, F.size("turns"))
    return paths.join(heads, F.col("base") == c - c % every, "left").select("conv_id", F.concat(head, own).alias("turns"))


def _block(ids: np.ndarray, starts: np.ndarray, lens: np.ndarray, at: int) -> np.ndarray:
    """``WIDTH`` columns of the padded matrix from column ``at`` on; 0 behind a path's end."""
    column = at + np.arange(WIDTH)
    inside = column[None, :] < lens[:, None]
    return np.where(inside, ids[np.where(inside, starts[:, None] + column[None, :], 0)], 0) if len(ids) else np.zeros(inside.shape, np.int64)


def _runs(first: np.ndarray) -> np.ndarray:
    """For each row the place where its run starts."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def path_order(ids: np.ndarray, starts: np.ndarray, lens: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows in the order of their paths, equal ones by ``conv``."""
    rank = np.zeros(len(lens), np.int64)
    rows, at = np.arange(len(lens)), 0
    while len(rows):
        cells = _block(ids, starts[rows], lens[rows], at)
        by = np.lexsort((*cells.T[::-1], rank[rows]))
        rows, cells = rows[by], cells[by]
        old = np.concatenate([[True], rank[rows][1:] != rank[rows][:-1]])
        first = old.copy()
        first[1:] |= np.logical_or.accumulate(cells[1:] != cells[:-1], axis=1)[:, -1]
        place = rank[rows] + np.arange(len(rows)) - _runs(old)
        rank[rows] = place[_runs(first)]
        run = np.cumsum(first) - 1
        longer = np.bincount(run, lens[rows] > at + WIDTH) > 0
        rows = rows[(longer & (np.bincount(run) > 1))[run]]
        at += WIDTH
    return np.lexsort((conv, rank))


def shared_length(ids: np.ndarray, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of equal first turns of the paths ``a`` and ``b``, each given by starts and lengths."""
    out = np.zeros(len(a[0]), np.int64)
    rows, at = np.arange(len(out)), 0
    while len(rows):
        x, y = (_block(ids, s[rows], n[rows], at) for s, n in (a, b))
        changed = np.logical_or.accumulate((x != y) | (x == 0), axis=1)
        same = WIDTH - changed.sum(1)
        out[rows] += same
        rows = rows[same == WIDTH]
        at += WIDTH
    return out


def _digests(path: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the first 0 to ``depth`` turns of a path."""
    state, out = hashlib.blake2b(digest_size=16), []
    for k in range(depth + 1):
        out.append(state.digest())
        if k < depth:
            state.update(path[k].tobytes())
    both = np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def shard_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one shard. Rows of ``side`` 0 are its conversations, -1 the last path before it and 1 the first one behind it."""
    side, conv = (pc.fill_null(table.column(c), 0).to_numpy() for c in ("side", "conv_id"))
    keys, offsets = _lists(table.column("keys"))
    words = _lists(table.column("words"))[0]
    turns = keys.reshape(-1, 2)
    by = np.lexsort((turns[:, 1], turns[:, 0]))
    new = np.concatenate([[True], (turns[by][1:] != turns[by][:-1]).any(1)])[: len(by)]
    ids = np.zeros(len(by), np.int64)
    ids[by] = np.cumsum(new)
    starts, lens = offsets[:-1] // 2, np.diff(offsets) // 2
    # Marks carry no words; their turns' places count as none.
    weight = np.zeros(len(ids), np.int64)
    own = np.flatnonzero(side == 0)
    weight[_spread(starts[own], lens[own])] = words
    before, behind = (np.flatnonzero(side == s) for s in (-1, 1))

    order = own[path_order(ids, starts[own], lens[own], conv[own])]
    row, start, length = conv[order], starts[order], lens[order]
    chain = np.concatenate([before, order, behind])
    common = shared_length(ids, (starts[chain[:-1]], lens[chain[:-1]]), (starts[chain[1:]], lens[chain[1:]]))
    like = np.concatenate([[-1] * (not len(before)), common, [-1] * (not len(behind))]).astype(np.int64)
    pre, post = like[:-1], like[1:]

    # What a row saves: words of its turns that an earlier row has in the same place, from each column to the end.
    cells = _spread(start, length)
    ends = np.cumsum(length)
    column = np.arange(len(cells)) - np.repeat(ends - length, length)
    saving = np.concatenate([[0], np.cumsum(weight[cells] * (column < np.repeat(pre, length)))])
    leaf = post < length

    left = _digests(turns[start[0] :], max(pre[0], 0))
    right = _digests(turns[start[-1] :], max(post[-1], 0))
    parent, parent_kind = np.zeros(len(row), np.int64), np.zeros(len(row), np.int8)
    out = []
    for d in range(int(length.max()) + 1):
        at = np.flatnonzero(length >= d)
        first = d > pre[at]
        first[0] = True
        heads = np.flatnonzero(first)
        total = lambda x: np.add.reduceat(x, heads)
        least = np.minimum.reduceat(row[at], heads)
        sizes = np.diff(np.append(heads, len(at)))
        done = total((length[at] == d).astype(np.int64))
        # 1: the run began before this shard, 2: it only goes on behind it.
        kind = np.zeros(len(heads), np.int8)
        if at[-1] == len(row) - 1 and post[-1] >= d:
            kind[-1] = 2
        if at[0] == 0 and pre[0] >= d:
            kind[0] = 1
        texts = {k: ",".join(map(str, row[at[heads[k]] : at[heads[k]] + done[k]].tolist())) for k in np.flatnonzero(done).tolist()}
        digest = lambda kinds, depth: [np.where(kinds == 1, l[min(depth, len(l) - 1)], r[min(depth, len(r) - 1)]) for l, r in zip(left, right)]  # noqa: E731, E741
        hi, lo = digest(kind, d)
        up, up_kind = parent[at[heads]], parent_kind[at[heads]]
        up_hi, up_lo = digest(up_kind, max(d - 1, 0))
        suffix = saving[ends[at]] - saving[ends[at] - length[at] + max(d - 1, 0)]
        none, alone = np.full(len(heads), d == 0), kind == 0
        out.append(pa.Table.from_arrays([
            pa.array(np.full(len(heads), table.column("shard")[0].as_py(), np.int32)), pa.array(np.full(len(heads), d, np.int64)), pa.array(least),
            pa.array(up, mask=none | (up_kind > 0)), pa.array(sizes.astype(np.int64)), pa.array(total(((length[at] > d) & (pre[at] <= d)).astype(np.int64))),
            pa.array(total(leaf[at].astype(np.int64))), pa.array(total(suffix)),
            pa.array([(hashlib.sha256(texts[k].encode()).hexdigest() if k in texts else EMPTY) if a else None for k, a in enumerate(alone)], pa.string()),
            pa.array(~alone), pa.array(hi, mask=alone), pa.array(lo, mask=alone), pa.array(up_hi, mask=none | (up_kind == 0)), pa.array(up_lo, mask=none | (up_kind == 0)),
            pa.array([None if a else texts.get(k) for k, a in enumerate(alone)], pa.string()),
        ], schema=NODE))
        parent[at], parent_kind[at] = np.repeat(least, sizes), np.repeat(kind, sizes)
    return pa.concat_tables(out)


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """All places of the ranges."""
    upto = np.cumsum(lens)
    return np.repeat(starts - upto + lens, lens) + np.arange(upto[-1] if len(upto) else 0)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the lists of each node, which arrive in order."""
    node, state = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["hi", "lo", "ends_sha256"])

    for batch in batches:
        for hi, lo, ends in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ends"))):
            if (hi, lo) != node:
                if node:
                    yield out()
                node, state = (hi, lo), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ends.encode())
    if node:
        yield out()


def trie(paths: DataFrame, *, cells_a_shard: int = 200_000) -> DataFrame:
    """The nodes of conversations ``conv_id, turns``: see ``RESULT`` and the module's text. The driver holds the shards' numbers only."""
    spark = paths.sparkSession
    keys = F.flatten(F.transform("turns", lambda t: F.array(t["hi"], t["lo"]))).alias("keys")
    held = saved(paths.select("conv_id", keys, F.transform("turns", lambda t: t["words"].cast("long")).alias("words")))
    cells = held.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    dealt = held.repartitionByRange(parts(cells, cells_a_shard), "keys", "conv_id").withColumn("shard", F.spark_partition_id())
    dealt = saved(dealt)
    bounds = saved(dealt.groupBy("shard").agg(F.min("keys").alias("first"), F.max("keys").alias("last")))
    shards = sorted(r["shard"] for r in bounds.select("shard").collect())
    next_to = [(a, b, s) for x, y in zip(shards, shards[1:]) for a, b, s in ((x, y, 1), (y, x, -1))]
    near = spark.createDataFrame(next_to, "shard int, other int, side int").join(bounds.withColumnRenamed("shard", "other"), "other")
    none = F.lit(None)
    marks = near.select("shard", "side", none.cast("long").alias("conv_id"), F.when(F.col("side") < 0, F.col("last")).otherwise(F.col("first")).alias("keys"), none.cast("array<long>").alias("words"))
    rows = dealt.select("shard", F.lit(0).alias("side"), "conv_id", "keys", "words").unionByName(marks)
    names = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}
    nodes = saved(rows.groupBy("shard").applyInArrow(shard_nodes, ", ".join(f"{f.name} {names[f.type]}" for f in NODE)))

    # Boundary nodes: parts of several shards.
    split = nodes.where("shared")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = saved(split.groupBy("hi", "lo").agg(F.min("conv_id").alias("conv_id"), *[F.first(c).alias(c) for c in ("depth", "parent_hi", "parent_lo")], *sums))
    ends = split.where("ends IS NOT NULL").select("hi", "lo", "shard", "ends").repartition("hi", "lo").sortWithinPartitions("hi", "lo", "shard")
    ended = merged.join(ends.mapInArrow(_ends, "hi long, lo long, ends_sha256 string"), ["hi", "lo"], "left")
    name = merged.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("parent_conv_id"))
    shared = ended.join(name, ["parent_hi", "parent_lo"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    # Nodes of a shard below one of its boundary nodes: its name is joined by shard, so no key is shared by more than a shard's nodes.
    named = split.select("shard", F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo")).join(name, ["parent_hi", "parent_lo"])
    below = nodes.where("NOT shared AND parent_hi IS NOT NULL").drop("parent_conv_id").join(named, ["shard", "parent_hi", "parent_lo"])
    inner = nodes.where("NOT shared AND parent_hi IS NULL")
    return shared.select(*RESULT).unionByName(below.select(*RESULT)).unionByName(inner.select(*RESULT))
