"""Which words set a source apart from the other sources of its language, and from the language as a whole.

Terms are runs of ASCII letters (A-Z lower-cased) and characters from U+0080 up. A language keeps the terms that stand in at
least ``least_docs`` of its documents, V in number. Group and language give each kept term the smoothed share p = 1 + floor(SCALE *
(count + 1) / (N + V)); the divergence of p from q is f = floor((p - q)^2 / q). All of it is exact integer arithmetic.

``term`` part: terms of a group with the same group and language counts have the same f, so f is computed once per cell of
counts, cells are ranked by f with the running total of their terms before them, equal values are merged, and only
values that begin within the first ``top`` ranks are expanded to terms, in UTF-8 order.

``pair`` part: a sum over all V terms of a language for each two of its sources, without laying out the zero counts. With z a
group's share of a term it lacks, f(a, b) summed over the terms is V f(z_a, z_b), plus f(a, z_b) - f(z_a, z_b) over the terms of a, the same for
b, and over the terms of both what those two miss of f(a, b). The terms of one group enter as cells (share, number of terms), the
common ones as distinct lists of shares with their number.

Defined results: null text, lang and source read as empty strings; documents without terms make their group occur; every row
is a document, repeated ones too; a language without kept terms has pairs of value 0 and no term rows; an empty table gives none. Only ``text``, ``lang``
and ``source`` are read. Sums hold in 64 bits: shares of a group add up to at most SCALE + V, so those of f to some 4e18.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SCALE = 1_000_000_000
#: Bytes of UTF-8 texts with A-Z lower-cased and all other ASCII but a-z blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
COUNT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
GROUP = ["lang", "source"]


def _counted(most_terms: int = 300_000, most_bytes: int = 32 << 20):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Occurrences and documents by group and term, handed on when so many terms or bytes have been read."""
        held: dict[tuple, tuple[Counter, Counter]] = {}
        read = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                terms = list(n)
                for k in range(0, len(terms), 100_000):
                    some = terms[k : k + 100_000]
                    columns = [[lang] * len(some), [source] * len(some), some, [n[t] for t in some], [docs[t] for t in some]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNT)], schema=COUNT)
            held.clear()

        for batch in batches:
            for lang, source, value in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                text = value.as_py()
                terms = text.translate(TABLE).split()
                if terms:
                    n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                    n.update(terms)
                    docs.update(set(terms))
                read += len(text)
                if read >= most_bytes or read >= 1 << 20 and sum(len(n) for n, _ in held.values()) >= most_terms:
                    yield from out()
                    read = 0
        yield from out()

    return counts


def _div(num: Column, den: Column) -> Column:
    """Whole-number quotient of non-negative 64-bit numbers or decimals, null for a zero divisor."""
    return F.call_function("div", num, F.when(den != 0, den))


def share(n: Column, total: Column, terms: Column) -> Column:
    """p of a term that occurs ``n`` times among ``total`` in a vocabulary of ``terms``; null without terms."""
    num = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    return 1 + _div(num, F.when(terms > 0, total + terms).otherwise(0).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term of a group."""
    none = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), none).alias(c) for c in GROUP], F.coalesce(F.col("text").cast("string"), none).cast("binary").alias("text"))
    counted = rows.mapInArrow(_counted(), "lang string, source string, term binary, n long, docs long")
    return counted.groupBy(*GROUP, F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(docs: DataFrame, least_docs: int = 3) -> tuple[DataFrame, DataFrame]:
    """The kept terms that occur in a group with the group's share ``p`` and the language's ``q``; each group's totals."""
    one = Window.partitionBy("lang", "term")
    kept = term_counts(docs).select("*", F.sum("docs").over(one).alias("lang_docs"), F.sum("n").over(one).alias("lang_n"), F.row_number().over(one.orderBy("source")).alias("k"))
    kept = saved(kept.where(F.col("lang_docs") >= least_docs).select(*GROUP, "term", "n", "lang_n", (F.col("k") == 1).cast("long").alias("new")))
    found = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP]).distinct()
    sums = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.sum("new").alias("new"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("new").alias("terms"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = saved(found.join(sums, GROUP, "left").join(langs, "lang", "left").select(*GROUP, zero("total"), zero("lang_total"), zero("terms")))
    groups = groups.withColumn("z", share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    return saved(kept.join(groups, GROUP).select(*GROUP, "term", "n", "lang_n", p.alias("p"), q.alias("q"), "z")), groups


def telling_terms(kept: DataFrame, top: int = 200) -> DataFrame:
    """``lang, source, item, value, rank``: of each group the ``top`` terms that it uses more than its language."""
    cell = [*GROUP, "n", "lang_n"]
    cells = kept.where("p > q").groupBy(*cell).agg(F.count(F.lit(1)).alias("terms"), F.first("p").alias("p"), F.first("q").alias("q"))
    cells = saved(cells.withColumn("value", divergence(F.col("p"), F.col("q"))))
    above = Window.partitionBy(*GROUP).orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    values = cells.groupBy(*GROUP, "value").agg(F.sum("terms").alias("terms")).withColumn("before", F.coalesce(F.sum("terms").over(above), F.lit(0)))
    chosen = cells.join(values.where(F.col("before") < top).drop("terms"), [*GROUP, "value"]).select(*cell, "value", "before")
    inside = F.row_number().over(Window.partitionBy(*GROUP, "value", "before").orderBy("term"))
    expanded = kept.join(chosen, cell).withColumn("inside", inside).where(F.col("inside") <= top)
    rank = (F.col("before") + F.col("inside")).cast("int")
    return expanded.where(rank <= top).select(*GROUP, F.col("term").alias("item"), "value", rank.alias("rank"))


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank``: of each group the other sources of its language by divergence over all kept terms."""
    a, b = (groups.select("lang", F.col("source").alias(s), F.col("z").alias(f"{s}_z"), "terms") for s in ("a", "b"))
    pairs = saved(a.join(b.drop("terms"), "lang").where("a <> b"))
    base = pairs.select("lang", "a", "b", F.coalesce(F.col("terms") * divergence(F.col("a_z"), F.col("b_z")), F.lit(0)).alias("value"))

    # Terms of one group against the share that the other gives a term it lacks, in both directions.
    cells = kept.groupBy(*GROUP, "p").agg(F.count(F.lit(1)).alias("n"))
    met = pairs.join(cells.withColumnRenamed("source", "a"), ["lang", "a"])
    p, n, z, other = F.col("p"), F.col("n"), F.col("a_z"), F.col("b_z")
    sums = met.groupBy("lang", "a", "b").agg(
        F.sum(n * (divergence(p, other) - divergence(z, other))).alias("ab"), F.sum(n * (divergence(other, p) - divergence(other, z))).alias("ba")
    )

    # Terms of both, as distinct lists of their groups' shares.
    lists = kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "z"))).alias("of"))
    lists = lists.where(F.size("of") > 1).groupBy("lang", "of").agg(F.count(F.lit(1)).alias("n"))
    left = lists.select("lang", "n", "of", F.explode("of").alias("x"))
    both = left.select("lang", "n", "x", F.explode(F.filter("of", lambda y: y["source"] > F.col("x.source"))).alias("y"))
    f = lambda x, y: divergence(x["p"], y["p"]) - divergence(x["p"], y["z"]) - divergence(x["z"], y["p"]) + divergence(x["z"], y["z"])
    x, y = F.col("x"), F.col("y")
    common = both.groupBy("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b")).agg(F.sum(n * f(x, y)).alias("ab"), F.sum(n * f(y, x)).alias("ba"))

    each = sums.unionByName(common)
    ways = base.unionByName(each.select("lang", "a", "b", F.col("ab").alias("value"))).unionByName(each.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("ba").alias("value")))
    total = ways.groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    return total.select(*GROUP, "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, *, least_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` of both parts."""
    kept, groups = shares(docs, least_docs)
    parts = {"pair": pair_sums(kept, groups), "term": telling_terms(kept, top)}
    named = [rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", "rank") for part, rows in parts.items()]
    return named[0].unionByName(named[1])
