"""Quality rules with risk-controlled thresholds, in built-in functions only.

Rules count what a whole text holds. Their cutoffs form one path from loose to strict, fixed beforehand: each step
tightens one rule by one place of its grid, and rules take turns so that all get strict together. On labelled good documents of
a stratum (its language) a step is allowed if the exact binomial test rejects "its cutoffs together fail more than ``risk`` of the good
ones": the chance of so few false rejections at that risk is at most ``error`` divided by the number of strata (Bonferroni). Steps are
tested in their order and the last one before the first that isn't allowed is taken; tested so, the steps need no further
correction. With confidence ``1 - error`` no stratum loses more than ``risk`` of its good documents. A stratum
with too few labelled documents (with five strata and no false rejection, some 460) allows no step and rejects by the base rule only.

Defined results: null and empty texts have no words and fail the base rule; a null language is a stratum of its own;
labels repeated for a document count once (good only if all say so); repeated documents are judged alike; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, words

SYMBOLS = r"[#*$%&|<>]+"
#: Rules as measures whose large values speak against a document, with their grids of cutoffs.
GRIDS = {
    "symbol_ratio": [x / 100 for x in (2, 5, 10, 20, 30, 50, 75, 100, 150, 200)],
    "shout_ratio": [x / 100 for x in (10, 20, 30, 40, 50, 60, 70, 80, 90)],
    "dup_line_ratio": [x / 100 for x in (10, 20, 30, 40, 50, 60, 70, 80, 90)],
    "repeat_ratio": [x / 100 for x in (2, 5, 8, 10, 12, 15, 18)],
    "word_length": [8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0],
}


def repeated_words(w: Column, n: int = 5) -> Column:
    """Words in windows of ``n`` words that occur at least twice in the array ``w``, the first included.

    Works inside a row: windows are compared by two levels of 64-bit hashes; sorted with their places, equal ones are neighbours.
    """
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    count = F.size(w) - (n - 1)

    def marked(h: Column) -> Column:
        at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))

    def places(windows: Column) -> Column:
        held = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, k: F.coalesce(F.get(s, k)["h"], F.lit(None))
        twice = _let(held, lambda s: F.filter(s, lambda x, k: (same(s, k - 1) == x["h"]) | F.coalesce(same(s, k + 1) == x["h"], F.lit(False))))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    zero = F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last"))
    covered = lambda p: F.aggregate(
        p, zero, lambda a, i: F.struct((a["n"] + F.least(F.lit(n), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"]
    )
    return _let(hashes, lambda h: _let(marked(h), lambda m: F.when(F.size(F.array_distinct(m)) == F.size(m), 0).otherwise(covered(places(m)))))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` and the counts of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    shouted = F.size(F.filter("w_", lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.char_length(x) > 2)))
    return (
        docs.withColumns({"w_": words(F.col("text")), "l_": lines})
        .withColumns(
            {
                "n_words": F.size("w_").cast("long"),
                "word_chars": F.char_length(F.array_join("w_", "")).cast("long"),
                "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
                "n_dup_lines": (F.size("l_") - F.size(F.array_distinct("l_"))).cast("long"),
                "n_lines": F.size("l_").cast("long"),
                "n_shouted": shouted.cast("long"),
                "n_repeat_words": repeated_words(F.col("w_")).cast("long"),
            }
        )
        .drop("w_", "l_")
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    )


def rule_values() -> dict[str, Column]:
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbol_ratio": over("n_symbols", "n_words"),
        "shout_ratio": over("n_shouted", "n_words"),
        "dup_line_ratio": over("n_dup_lines", "n_lines"),
        "repeat_ratio": over("n_repeat_words", "n_words"),
        "word_length": over("word_chars", "n_words"),
    }


def log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series from n + 8 downwards; exact to about 1e-12."""
    z = n.cast("double") + 9.0
    series = (z - 0.5) * F.ln(z) - z + 0.5 * F.ln(2 * F.pi()) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    for k in range(1, 9):
        series = series - F.ln(n + F.lit(float(k)))
    return series


def binomial_tail(k: Column, n: Column, p: Column | float) -> Column:
    """P(X <= k) for X of the binomial distribution; terms too small to count (60 deviations below k) are left out."""
    p = p if isinstance(p, Column) else F.lit(p)
    span = F.ceil(60 * F.sqrt(n * p * (1 - p)) + 60).cast("long")
    terms = F.sequence(F.greatest(F.lit(0).cast("long"), k - span), k)
    of_n = log_factorial(n)
    term = lambda i: F.exp(of_n - log_factorial(i) - log_factorial(n - i) + i * F.ln(p) + (n - i) * F.ln(1 - p))
    return F.aggregate(terms, F.lit(0.0), lambda a, i: a + term(i))


def path(grids: dict[str, list[float]] = GRIDS) -> list[dict[str, float]]:
    """The cutoffs of each step, from loose to strict; rules that a step doesn't limit yet are left out."""
    moves = sorted(((place + 1) / len(grid), rule, cutoff) for rule, grid in grids.items() for place, cutoff in enumerate(sorted(grid, reverse=True)))
    steps: list[dict[str, float]] = []
    for _, rule, cutoff in moves:
        steps.append((steps[-1] if steps else {}) | {rule: float(cutoff)})
    return steps


def thresholds(good: DataFrame, risk: float, error: float, grids: dict[str, list[float]] = GRIDS) -> DataFrame:
    """One row per stratum: ``stratum`` and a column per rule, null where it has no cutoff. ``good``: ``stratum`` and the measures.

    The result has a row for each stratum and is aggregated in one pass over the labelled good documents.
    """
    values, steps = rule_values(), path(grids)
    # A document fails from some step on, so it's enough to count by the first step that it fails.
    places = {(rule, step[rule]): j for j, step in reversed(list(enumerate(steps))) for rule in step}
    fails_at = [F.when(values[rule] > cutoff, F.lit(j)) for (rule, cutoff), j in places.items()]
    first = good.select("stratum", F.coalesce(F.least(*fails_at), F.lit(len(steps))).alias("first"))
    counted = first.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("first") <= j).alias(f"k{j}") for j in range(len(steps))])
    tests = F.count(F.lit(1)).over(Window.partitionBy())
    ks = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"k{j}").alias("k")) for j in range(len(steps))])
    each = counted.withColumn("tests", tests).select("stratum", "n", "tests", F.explode(ks).alias("x"))
    allowed = (F.col("x.k") <= F.col("n") * risk) & (binomial_tail(F.col("x.k"), F.col("n"), risk) <= error / F.col("tests"))
    taken = each.groupBy("stratum").agg(F.coalesce(F.min(F.when(~allowed, F.col("x.j"))), F.lit(len(steps))).alias("stop"))
    cut = F.array(*[F.struct(*[F.lit(step.get(r)).cast("double").alias(f"max_{r}") for r in grids]) for step in [{}, *steps]])
    return taken.select("stratum", F.get(cut, F.col("stop")).alias("c")).select("stratum", "c.*")


def judge(docs: DataFrame, labels: DataFrame, *, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """Per document: ``doc_id``, ``lang``, the measures, ``base_failed``, the stratum's cutoffs and ``kept``.

    Texts are read once; the measures, a few numbers a document, are kept in the shared folder, as both the choice of
    the cutoffs and the verdicts need them. Good labelled documents of each stratum that pass the base rule are the holdout.
    """
    held = saved(measures(docs.select("doc_id", "lang", "text")).drop("text"))
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good_"))
    good = held.where("NOT base_failed").join(marks.where("good_ = 1"), "doc_id", "left_semi").withColumn("stratum", F.col("lang"))
    cut = thresholds(good, risk, error).withColumnRenamed("stratum", "stratum_")
    judged = held.join(cut, F.col("lang").eqNullSafe(F.col("stratum_")), "left").drop("stratum_")
    passed = F.lit(True)
    for rule, value in rule_values().items():
        passed = passed & F.coalesce(value <= F.col(f"max_{rule}"), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & passed)
