"""Quality classifier: interpolated modified Kneser-Ney n-grams of characters, trained on trusted text.

Grams of ``ORDER`` code points (16 bits each, runs of white space as one blank, three marks before a text and one behind it)
are counted in all trusted documents; lower orders count the different symbols before a gram. Counts, totals of contexts and
discounts are tables that Spark shards by gram and joins; the grams asked for are those of all documents, each once. Per
document, the mean logarithm over all of its grams gives the perplexity, and documents above their language's limit are
rejected: the ``quantile`` of perplexities of trusted documents of that language that were kept out of the training, times
``slack``.

The scored grams go to the tasks as a broadcast up to ``broadcast_grams`` rows; beyond, documents and the grams that a bucket
of them asks for meet by bucket. Both ways give the same numbers. Labels work alike (``broadcast_labels``).

Defined results: null and empty texts are a text of no symbols; a null language is a language of its own; a language without kept-out
trusted documents has no limit and rejects none; labels repeated for a document are trusted only if all say so; no
trusted text at all: every document is kept with a null perplexity. Repeated rows are scored alike. Columns other than
``doc_id``, ``text`` and ``lang`` pass through ``kept_documents`` untouched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, parts, saved

ORDER = 4
START, END = "\x02", "\x03"
BLANKS = re.compile(r"\s+")
GRID = 1000


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of all texts, and where each text's end."""
    padded = [START * (ORDER - 1) + BLANKS.sub(" ", t or "") + END for t in texts]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) & np.uint64(0xFFFF)
    packed = points[: len(points) - ORDER + 1].copy() if len(points) >= ORDER else np.zeros(0, np.uint64)
    for k in range(1, ORDER):
        packed = packed << np.uint64(16) | points[k : len(points) - ORDER + 1 + k]
    ends = np.cumsum(sizes)
    inside = np.ones(len(packed) + ORDER - 1, bool)
    for k in range(1, ORDER):
        inside[ends - k] = False  # grams that would reach into the next text
    return packed[inside[: len(packed)]].view(np.int64), np.cumsum(sizes - ORDER + 1)


def _slices(texts: list[str | None], most: int = 500_000) -> Iterator[tuple[int, int]]:
    begin = 0
    while begin < len(texts):
        stop, held = begin, 0
        while stop < len(texts) and (stop == begin or held < most):
            held += len(texts[stop] or "")
            stop += 1
        yield begin, stop
        begin = stop


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams of some documents at a time with their counts."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in _slices(texts):
            codes, unique = pd.factorize(_grams(texts[a:b])[0])
            held.append((unique, np.bincount(codes, minlength=len(unique))))
        if held:
            codes, unique = pd.factorize(np.concatenate([u for u, _ in held]))
            counts = np.bincount(codes, np.concatenate([n for _, n in held]), len(unique)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(unique), pa.array(counts)], names=["g", "c"])


def gram_counts(docs: DataFrame) -> DataFrame:
    return docs.select("text").mapInArrow(_counter, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """Three discounts from the numbers of grams seen once to four times.

    Small tables may lack one of these or give a discount that isn't positive, which would leave unseen grams no probability: they get fixed ones.
    """
    n = counts.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first()
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] and n[i] else 0.0 for i in (1, 2, 3)]
    return found if min(found) > 0 else [0.5, 1.0, 1.5]


def _low(symbols: int) -> Column:
    return F.lit((1 << (16 * symbols)) - 1)


def model(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 up: ``g, p`` of the grams seen and ``ctx, back`` of the contexts seen."""
    tables = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = saved(tables[k + 1].groupBy(F.col("g").bitwiseAND(_low(k)).alias("g")).agg(F.count(F.lit(1)).alias("c")))
    out: list[tuple[DataFrame, DataFrame]] = []
    lower = None
    for k in range(1, ORDER + 1):
        d = _discounts(tables[k])
        context = F.shiftrightunsigned("g", 16) if k > 1 else F.lit(0).cast("long")
        cut = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        seen = tables[k].select("g", context.alias("ctx"), F.col("c").cast("double").alias("c"), cut.alias("cut"))
        totals = seen.groupBy("ctx").agg(F.sum("c").alias("total"), (F.sum(F.least("c", "cut")) / F.sum("c")).alias("back"))
        both = seen.join(totals, "ctx")
        if lower is None:
            symbols = max(1, tables[k].count())
            rest = F.lit(1.0 / (symbols + 1))
        else:
            both = both.join(lower.select(F.col("g").alias("low"), F.col("p").alias("rest")), F.col("g").bitwiseAND(_low(k - 1)) == F.col("low"))
            rest = F.col("rest")
        lower = saved(both.select("g", (F.greatest(F.col("c") - F.col("cut"), F.lit(0.0)) / F.col("total") + F.col("back") * rest).alias("p")))
        out.append((lower, totals.select("ctx", "back")))
    return out


def log_probabilities(asked: DataFrame, orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``g, logp`` for each gram ``g`` of ``asked``, by joins with the orders' tables."""
    symbols = max(1, orders[0][0].count())
    rows, p = asked.select("g"), None
    for k in range(1, ORDER + 1):
        seen, contexts = orders[k - 1]
        own = F.col("g").bitwiseAND(_low(k)) if k < ORDER else F.col("g")
        rows = rows.join(seen.select(F.col("g").alias(f"g{k}"), F.col("p").alias(f"p{k}")), own == F.col(f"g{k}"), "left").drop(f"g{k}")
        if k == 1:
            back = contexts.first()  # one row
            p = F.coalesce("p1", F.lit((back["back"] if back else 1.0) / (symbols + 1)))
        else:
            rows = rows.join(contexts.select(F.col("ctx").alias(f"x{k}"), F.col("back").alias(f"b{k}")), F.shiftrightunsigned(own, 16) == F.col(f"x{k}"), "left").drop(f"x{k}")
            p = F.coalesce(F.col(f"p{k}"), F.coalesce(F.col(f"b{k}"), F.lit(1.0)) * p)
    return rows.select("g", F.ln(p).alias("logp"))


def _sums(texts: list[str | None], known: np.ndarray, logp: np.ndarray) -> tuple[list[int], list[float]]:
    """Numbers of grams and mean logarithms; ``known`` is sorted and holds every gram."""
    sizes: list[int] = []
    means: list[float] = []
    for a, b in _slices(texts):
        grams, ends = _grams(texts[a:b])
        codes, unique = pd.factorize(grams)
        values = logp[np.searchsorted(known, unique)][codes]
        n = np.diff(ends, prepend=0)
        sizes += n.tolist()
        means += (np.add.reduceat(values, ends - n) / n).tolist()
    return sizes, means


SCORED = "doc_id long, lang string, text_hash long, n_grams long, mean_logp double"


def _scored(docs: DataFrame, grams: DataFrame, broadcast_grams: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))
    n = grams.count()

    def rows(t: pa.RecordBatch | pa.Table, known: np.ndarray, logp: np.ndarray) -> list[pa.Array]:
        sizes, means = _sums(t.column("text").to_pylist(), known, logp)
        return [t.column("doc_id"), t.column("lang"), t.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(means, pa.float64())]

    names = ["doc_id", "lang", "text_hash", "n_grams", "mean_logp"]
    if n <= broadcast_grams:
        table = grams.toArrow().sort_by("g")
        held = docs.sparkSession.sparkContext.broadcast((table["g"].to_numpy(), table["logp"].to_numpy()))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays(rows(b, *held.value), names=names)

        return texts.mapInArrow(score, SCORED)

    buckets = parts(docs.count(), 2000)
    dealt = texts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))

    def ask(_: tuple, t: pa.Table) -> pa.Table:
        texts = t["text"].to_pylist()
        found = [pd.unique(_grams(texts[a:b])[0]) for a, b in _slices(texts)]
        unique = pd.unique(np.concatenate(found))
        return pa.table({"bucket": pa.array(np.full(len(unique), t["bucket"][0].as_py())), "g": pa.array(unique)})

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("g")
        return pa.table(dict(zip(names, rows(left, right["g"].to_numpy(), right["logp"].to_numpy())))) if left.num_rows else pa.table({n: [] for n in names})

    asked = dealt.groupBy("bucket").applyInArrow(ask, "bucket long, g long").join(grams, "g")
    return dealt.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(meet, SCORED)


def limits(scores: DataFrame, quantile: float, slack: float) -> DataFrame:
    """``of_lang, limit``: the quantile of each language on a grid of logarithms, exact on that grid; no group is gathered."""
    cell = F.floor(-F.col("mean_logp") * GRID)
    counts = scores.groupBy("lang", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    every = F.sum("n").over(Window.partitionBy("lang"))
    reached = counts.withColumn("upto", upto).withColumn("every", every).where(F.col("upto") >= F.ceil(F.col("every") * quantile))
    return reached.groupBy(F.col("lang").alias("of_lang")).agg((F.exp((F.min("cell") + 1) / GRID) * slack).alias("limit"))


def classify(
    docs: DataFrame, labels: DataFrame, *, quantile: float = 0.99, slack: float = 1.25, broadcast_grams: int = 2_000_000, broadcast_labels: int = 1_000_000
) -> DataFrame:
    """``doc_id, lang, text_hash, n_grams, perplexity, limit, kept`` for every document."""
    docs = docs.select("doc_id", "text", "lang")
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(F.min("quality").alias("q")).where("q = 1").select("l_id")
    small = marks.count() <= broadcast_labels
    marks = F.broadcast(marks) if small else marks
    trusted = docs.where("doc_id IS NOT NULL").join(marks, F.col("doc_id") == F.col("l_id"), "left_semi")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    counts = saved(gram_counts(trusted.where(~held_out)))
    none = F.lit(None).cast("double")
    if counts.isEmpty():
        return docs.select(F.col("doc_id").cast("long"), "lang", F.xxhash64("text").alias("text_hash"), F.lit(None).cast("long").alias("n_grams"), none.alias("perplexity"), none.alias("limit"), F.lit(True).alias("kept"))
    asked = docs.select("text").mapInArrow(_counter, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    grams = saved(log_probabilities(asked, model(counts)))
    scores = saved(_scored(docs, grams, broadcast_grams))
    known = scores.where(held_out).join(marks, F.col("doc_id") == F.col("l_id"), "left_semi")
    limit = limits(known, quantile, slack)
    judged = scores.join(limit, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    perplexity = F.exp(-F.col("mean_logp"))
    return judged.select("doc_id", "lang", "text_hash", "n_grams", perplexity.alias("perplexity"), "limit", (F.col("limit").isNull() | (perplexity <= F.col("limit"))).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that stay, with their columns. Those that go are looked up by id and a hash of their text."""
    gone = classify(docs, labels, **options).where("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    held = packed(docs, id_=F.col("doc_id").cast("long"), hash_=F.xxhash64("text"))
    return held.join(gone, F.col("id_").eqNullSafe(F.col("gone_id")) & (F.col("hash_") == F.col("gone_hash")), "left_anti").select("row_.*")
