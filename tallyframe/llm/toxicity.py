"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

Words, with a mark at both ends, are read in windows of ``WINDOW`` characters at every place. The kernel of two windows adds up their common
subsequences of ``ORDER`` characters, each weighted by ``DECAY`` to the length it spans in both, is scaled to 1 for equal
windows and raised to ``POWER``: insults with inserted, dropped or changed characters or new endings stay near, other words
don't. It is taken as 0 where fewer than half of the landmark's pairs of characters (neighbours, or one apart) are in the window.
A word is also read without what is put between its letters (punctuation, or one and the same character after each), with
digits and signs as the letters they stand for, and with repeated letters once; runs of words of at most two letters are read as
one word as well. So ``n.u.m.b``, ``n u m b``, ``nxuxmxb`` and ``nuummb`` have the windows of ``numb``, though no training text spells it so.
Landmarks are the windows that speak most for the label in a training sample, none too near to another. A document's kernel
with a landmark is the largest of its windows'; Nyström's root of the landmarks' kernel turns it into features, a
linear machine with squared hinge loss and Platt's sigmoid into the score.

The machine is fitted on at most ``sample_rows`` labelled documents of each class; its parameters are a few kilobytes.

Defined results: null and empty texts have no words and get the score of a document without any near word; labels repeated for a
document are toxic if any says so; without a label of either class every score is the share of toxic labels, 0 if
there are none; a null id is not held out and has no label. Repeated rows get equal scores. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER, DECAY, WINDOW, POWER = 3, 0.6, 6, 4
PAIR_CELLS = 1024
#: Letters that digits and signs stand for.
SPELLED = str.maketrans("013457@$!", "oieastasi")
#: What another reading may take away: signs and digits, a letter twice, a character between letters.
OTHERWISE = re.compile(r"[\W\d_]|(.)\1|^.?(.)(?:.\2){3}")
EDGES = ".,:;!?\"()[]{}<>|#*$%&'-_=+/\\"


def _codes(words: list[str]) -> np.ndarray:
    """Code points of windows of at most ``WINDOW`` characters, 0 behind them."""
    flat = "".join(w.ljust(WINDOW, "\0") for w in words)
    return np.frombuffer(flat.encode("utf-32-le", "replace"), np.uint32).reshape(-1, WINDOW)


def _pairs(codes: np.ndarray) -> np.ndarray:
    """Which cells of letter pairs, next to each other or one apart, a word has."""
    out = np.zeros((len(codes), PAIR_CELLS), np.float32)
    for gap in (1, 2):
        a, b = codes[:, :-gap].astype(np.int64), codes[:, gap:].astype(np.int64)
        row, col = np.nonzero((a > 0) & (b > 0))
        out[row, (a[row, col] * 31 + b[row, col] * 7) % PAIR_CELLS] = 1
    return out


def _raw(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Subsequence kernel of the words in each row of ``a`` with those of ``b`` (equally many rows)."""
    n, width = a.shape
    same = [(b == a[:, i : i + 1]) & (b > 0) for i in range(width)]
    before = np.ones((width + 1, n, width + 1))
    for _ in range(ORDER - 1):
        now = np.zeros((width + 1, n, width + 1))
        for i in range(1, width + 1):
            run = np.zeros(n)
            for j in range(1, width + 1):
                run = DECAY * run + np.where(same[i - 1][:, j - 1], DECAY * DECAY * before[i - 1, :, j - 1], 0.0)
                now[i, :, j] = DECAY * now[i - 1, :, j] + run
        before = now
    total = np.zeros(n)
    for i in range(1, width + 1):
        total += (np.where(same[i - 1], before[i - 1, :, :-1], 0.0) * DECAY * DECAY).sum(1)
    return total


def kernel(words: np.ndarray, landmarks: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """Scaled kernel matrix of coded words and coded landmarks; only pairs that pass the letter pair test are computed."""
    out = np.zeros((len(words), len(landmarks)))
    if not len(words) or not len(landmarks):
        return out
    marks = _pairs(landmarks)
    row, col = np.nonzero(_pairs(words) @ marks.T >= np.maximum(1, 0.5 * marks.sum(1)))
    mine = _self(landmarks) if own is None else own
    used, at = np.unique(row, return_inverse=True)
    theirs = _self(words[used])
    for k in range(0, len(row), 4096):
        i, j = row[k : k + 4096], col[k : k + 4096]
        w = int(max((words[i] > 0).sum(1).max(), (landmarks[j] > 0).sum(1).max()))
        scale = np.sqrt(theirs[at[k : k + 4096]] * mine[j])
        out[i, j] = np.where(scale > 0, _raw(words[i][:, :w], landmarks[j][:, :w]) / np.where(scale > 0, scale, 1), 0) ** POWER
    return out


def _self(words: np.ndarray) -> np.ndarray:
    return np.concatenate([_raw(words[k : k + 4096], words[k : k + 4096]) for k in range(0, len(words), 4096)]) if len(words) else np.zeros(0)


def split_words(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words without punctuation at their edges; each text's words as places in them, and where texts end."""
    low = pc.utf8_lower(pa.array([t or "" for t in texts], pa.large_string()))
    split = pc.utf8_split_whitespace(low)
    coded = pc.utf8_trim(split.flatten(), EDGES).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), split.offsets.to_numpy()


@dataclass
class Machine:
    words: list[str]
    codes: np.ndarray
    own: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, kernels: np.ndarray) -> np.ndarray:
        margin = kernels @ self.weights + self.bias
        return 1 / (1 + np.exp(np.clip(self.slope * margin + self.shift, -700, 700)))


def windows(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[k : k + WINDOW] for k in range(max(1, len(marked) - WINDOW + 1))]


def readings(word: str) -> list[str]:
    """The word and what it may stand for, each once."""
    if not OTHERWISE.search(word):
        return [word]
    out = {word: None}
    for own, between in ((word[::2], word[1::2]), (word[1::2], word[::2])):
        if len(between) > 3 and len(set(between)) == 1:
            out[own] = None
    for x in list(out):
        for y in (x, x.translate(SPELLED)):
            letters = "".join(c for c in y if c.isalnum())
            out[letters] = None
            out["".join(c for c, before in zip(letters, " " + letters) if c != before)] = None
    return [x for x in out if x]


def spelled_out(words: list[str], at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Runs of words of at most two letters as one word each: the text it stands in, and the word, if that has four letters."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    short = (sizes[at] <= 2) if len(at) else np.zeros(0, bool)
    starts = short & np.concatenate([[True], ~short[:-1] | (doc[1:] != doc[:-1])])[: len(short)]
    first = np.flatnonzero(starts)
    run = np.cumsum(starts)[short] - 1
    length = np.bincount(run, minlength=len(first))
    found, where = [], []
    for i in np.flatnonzero(length > 2).tolist():
        joined = "".join([words[j] for j in at[first[i] : first[i] + length[i]].tolist()])
        if len(joined) >= 4:
            found.append(joined)
            where.append(doc[first[i]])
    return np.array(where, np.int64), found


class Reader:
    """Largest kernels of documents' windows with the landmarks; keeps what it knows of up to ``most`` words."""

    def __init__(self, codes: np.ndarray, own: np.ndarray, most: int = 300_000):
        self.codes, self.own, self.most = codes, own, most
        self.known: dict[str, int] = {}
        self.seen: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def _learn(self, words: list[str]) -> None:
        for begin in range(0, len(words), 5000):
            some = [(w, [x for r in readings(w) for x in windows(r)]) for w in words[begin : begin + 5000]]
            new = list({x for _, parts in some for x in parts if x not in self.seen})
            for k in range(0, len(new), 10_000):
                part = new[k : k + 10_000]
                values = kernel(_codes(part), self.codes, self.own)
                self.seen.update(dict.fromkeys(part, -1))
                for i in np.flatnonzero(values.max(1) > 0).tolist():
                    self.seen[part[i]] = len(self.rows)
                    self.rows.append(values[i].astype(np.float32))
            for w, parts in some:
                hits = {r for x in parts if (r := self.seen[x]) >= 0}
                if len(hits) > 1:
                    self.known[w] = len(self.rows)
                    self.rows.append(np.max([self.rows[r] for r in hits], axis=0))
                else:
                    self.known[w] = hits.pop() if hits else -1

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        words, at, ends = split_words(texts)
        in_doc, joined = spelled_out(words, at, ends)
        if len(self.known) > self.most:
            self.known.clear()
            self.seen.clear()
            self.rows.clear()
        self._learn(list(dict.fromkeys(w for w in [*words, *joined] if w not in self.known)))
        place = np.array([self.known[w] for w in words] or [0], np.int64)
        row_of = place[at] if len(at) else np.zeros(0, np.int64)
        row_of = np.concatenate([row_of, np.array([self.known[w] for w in joined], np.int64)])
        doc = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(ends)), in_doc])
        near = np.flatnonzero(row_of >= 0)
        out = np.zeros((len(texts), len(self.codes)))
        if len(near):
            pairs = np.unique(np.stack([doc[near], row_of[near]]), axis=1)
            for k in range(0, pairs.shape[1], 20_000):
                d, r = pairs[:, k : k + 20_000]
                first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                best = np.maximum.reduceat(np.stack([self.rows[x] for x in r.tolist()]), first)
                out[d[first]] = np.maximum(out[d[first]], best)
        return out


def choose_landmarks(texts: list[str | None], toxic: np.ndarray, most: int = 128, apart: float = 0.5) -> list[str]:
    """Windows by the two-proportion statistic of their documents with and without the label, skipping those near to a chosen one."""
    found: dict[str, list[int]] = {}
    for begin in range(0, len(texts), 200):
        words, at, ends = split_words(texts[begin : begin + 200])
        parts = [windows(w) if w else [] for w in words]
        for i in range(len(ends) - 1):
            kind = int(toxic[begin + i])
            for x in {x for j in np.unique(at[ends[i] : ends[i + 1]]).tolist() for x in parts[j]}:
                found.setdefault(x, [0, 0])[kind] += 1
    names = [x for x, n in found.items() if n[1] >= 2]
    if not names:
        return []
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    in0, in1 = (np.array([found[x][k] for x in names], float) for k in (0, 1))
    pooled = (in1 + in0) / (n1 + n0)
    z = (in1 / n1 - in0 / n0) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n1 + 1 / n0))
    order = [i for i in np.lexsort((np.array(names), -z)).tolist() if z[i] > 3.5][: 8 * most]
    codes = _codes([names[i] for i in order])
    near = kernel(codes, codes) if order else np.zeros((0, 0))
    chosen: list[int] = []
    for k in range(len(order)):
        if len(chosen) < most and all(near[k, c] < apart for c in chosen):
            chosen.append(k)
    return [names[order[k]] for k in chosen]


def train(texts: list[str | None], toxic: np.ndarray, cost: float = 10.0) -> Machine | float:
    """The fitted machine, or the constant score where there is nothing to tell apart."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    marks = choose_landmarks(texts, toxic) if 0 < toxic.sum() < len(toxic) else []
    if not marks:
        return share
    codes = _codes(marks)
    own = _self(codes)
    reader = Reader(codes, own)
    x = np.concatenate([reader(texts[k : k + 500]) for k in range(0, len(texts), 500)])
    values, vectors = np.linalg.eigh((lambda k: (k + k.T) / 2)(kernel(codes, codes, own)))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    z = np.concatenate([x @ root, np.ones((len(x), 1))], axis=1)
    y = np.where(toxic, 1.0, -1.0)
    balance = np.where(toxic, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) * cost / len(y)
    w = np.zeros(z.shape[1])
    ridge = np.eye(len(w)) * 1e-3
    ridge[-1, -1] = 1e-6
    for _ in range(50):  # Newton's steps on the squared hinge
        active = 1 - y * (z @ w) > 0
        za, ba = z[active], balance[active]
        new = np.linalg.solve(ridge + 2 * (za * ba[:, None]).T @ za, 2 * za.T @ (ba * y[active]))
        if np.allclose(new, w, atol=1e-10):
            break
        w = new
    slope, shift = _platt(z @ w, toxic)
    return Machine(marks, codes, own, root @ w[:-1], float(w[-1]), slope, shift)


def _platt(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Sigmoid 1 / (1 + exp(a * margin + b)) by Newton's method on Platt's smoothed targets."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = -2.0, math.log((n0 + 1) / (n1 + 1))
    design = np.stack([margin, np.ones_like(margin)])
    for _ in range(100):
        p = 1 / (1 + np.exp(np.clip(a * margin + b, -700, 700)))
        gradient = design @ (target - p)
        hessian = (design * (p * (1 - p))) @ design.T + np.eye(2) * 1e-6
        step = np.linalg.solve(hessian, gradient)
        size = min(1.0, 2 / max(1e-12, np.abs(step).max()))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


_readers: dict[int, tuple[bytes, Reader]] = {}


def _reader(machine: Machine) -> Reader:
    key = hash(machine.codes.tobytes())
    if key not in _readers:
        _readers.clear()
        _readers[key] = Reader(machine.codes, machine.own)
    return _readers[key]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, sample_rows: int = 2000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; learns from labels of documents that aren't held out."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("l_id")))
    mixed = F.xxhash64("l_id")
    some = [marks.where(F.col("toxic") == t).orderBy(mixed, "l_id").limit(sample_rows) for t in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # at most twice sample_rows ids
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "toxic")
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * sample_rows).collect()
    machine = train([r["text"] for r in picked], np.array([r["toxic"] == 1 for r in picked], bool))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            if isinstance(machine, float):
                found = np.full(len(texts), machine)
            else:
                reader = _reader(machine)
                found = np.concatenate([machine.probability(reader(texts[k : k + 1000])) for k in range(0, len(texts), 1000)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    asked = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return asked.mapInArrow(judge, "doc_id long, held_out boolean, score double, predicted int")
