"""Counts and medians kept as additive state per load, so that a new load costs that load only.

Three tables below one folder, each partitioned by load:

``counts``   load, digest, subset, n               one row per condition and subset, zeros included
``values``   load, octave, digest, subset, bucket, x, n   one row per median condition, subset and distinct value
``buckets``  load, digest, subset, bucket, n       the same summed over the values of a bucket

Counts are summed over loads. A median's middle buckets come from the small ``buckets`` table; of ``values``, which is also
partitioned by octave (1,024 buckets), only the octaves that hold them are read. A digest stands for a condition with its
window, value column and rule for subsets, so state of another window is never mixed in. Saving a load again replaces it.

``buckets`` is written last, from the ``values`` that were written: a load whose writing was interrupted is saved again.
Defined results: a row without a load belongs to the load ``''``; unlisted subsets are NULL and count for the nation only;
a condition that some load holds no state of can't be summed, and ``KeyError`` names it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.counts import group_counts, lenient, quoted, wrapped
from tallyframe.operators.medians import median_levels, middle_buckets, middle_values, value_bucket

SCHEMAS = {
    "counts": "digest string, subset string, n long, load string",
    "values": "digest string, subset string, bucket long, x float, n long, load string, octave int",
    "buckets": "digest string, subset string, bucket long, n long, load string",
}


def digest(condition: str, rule: object = None, value: str | None = None) -> str:
    """Name of a condition's state: its text, the rule for subsets and the value column of a median."""
    return hashlib.sha256(json.dumps([condition, rule, value]).encode()).hexdigest()


def count_state(
    data: DataFrame,
    conditions: Mapping[str, str],
    subset: Column,
    load: Column,
    grouped: Callable[[DataFrame, Mapping[str, str], Column], DataFrame] = group_counts,
) -> DataFrame:
    """``counts`` rows of conditions by digest, all loads of ``data`` from one scan."""
    names = {f"n{i}": name for i, name in enumerate(conditions)}
    wide = grouped(data, {c: conditions[n] for c, n in names.items()}, F.struct(F.coalesce(load.cast("string"), F.lit("")).alias("load"), subset.alias("subset")))
    long = wide.select("subset.load", F.col("subset.subset").alias("code"), *[F.col(c).alias(n) for c, n in names.items()])
    return long.unpivot(["load", "code"], [quoted(n) for n in names.values()], "digest", "n").select("digest", F.col("code").alias("subset"), "n", "load")


def median_state(data: DataFrame, conditions: Mapping[str, str], value: str, subset: Column, load: Column) -> DataFrame:
    """``values`` rows of median conditions of one value column by digest."""
    names = {f"n{i}": name for i, name in enumerate(conditions)}
    x = F.col(value).try_cast("float")
    with lenient(data.sparkSession):
        flags = {c: F.expr(wrapped(conditions[n])) for c, n in names.items()}
        wanted = F.expr(" OR ".join(wrapped(t) for t in conditions.values()))
        kept = data.where(wanted & F.col(value).isNotNull() & x.isNotNull())
        wide = kept.groupBy(F.coalesce(load.cast("string"), F.lit("")).alias("load"), subset.alias("subset"), x.alias("x")).agg(
            *[F.count_if(flag).alias(c) for c, flag in flags.items()]
        )
    rows = wide.select("load", "subset", "x", *[F.col(c).alias(n) for c, n in names.items()])
    rows = rows.unpivot(["load", "subset", "x"], [quoted(n) for n in names.values()], "digest", "n").where("n > 0").withColumn("bucket", value_bucket(F.col("x")))
    return rows.select("digest", "subset", "bucket", "x", "n", "load", F.shiftright("bucket", 10).cast("int").alias("octave"))


@dataclass(frozen=True)
class State:
    """The state tables below ``path``."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        """A state table as it is now; without rows where nothing was saved."""
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def _replace(self, name: str, rows: DataFrame, *by: str) -> None:
        """Only the partitions that ``rows`` has are replaced; a large one is dealt over several tasks."""
        spread = rows.hint("rebalance", *[F.col(c) for c in by])
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.path}/{name}")

    def save(self, counts: DataFrame, values: DataFrame | None = None) -> None:
        """Keeps the state of the loads in ``counts`` in place of what was kept of them."""
        counts = counts.persist()  # one row per load, subset and condition
        try:
            self._replace("counts", counts, "load")
            loads = counts.select("load").distinct()
            if values is not None:
                # an octave that a load no longer has would stay: a row without a count replaces it
                old = self.table("values").select("load", "octave").distinct().join(loads, "load", "left_semi")
                nothing = [F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("subset"), F.lit(0).cast("long").alias("bucket")]
                nothing += [F.lit(None).cast("float").alias("x"), F.lit(0).cast("long").alias("n")]
                self._replace("values", values.unionByName(old.select(*nothing, "load", "octave")), "load", "octave")
                kept = self.table("values").join(loads, "load", "left_semi")
                self._replace("buckets", kept.groupBy("digest", "subset", "bucket", "load").agg(F.sum("n").alias("n")), "load")
        finally:
            counts.unpersist()

    def require(self, names: Mapping[str, str]) -> None:
        """Raises ``KeyError`` unless every load has state of every digest; ``names`` says what each stands for."""
        counts = self.table("counts")
        loads = counts.agg(F.count_distinct("load")).first()[0]
        held = {r["digest"]: r["n"] for r in counts.where(F.col("digest").isin(list(names))).groupBy("digest").agg(F.count_distinct("load").alias("n")).collect()}
        lacking = sorted({text for d, text in names.items() if held.get(d, 0) < loads})
        if lacking:
            raise KeyError(f"some of {loads} loads have no state of {', '.join(lacking)}")

    def grouped(self, digests: Mapping[str, str], by_subset: bool = True) -> DataFrame:
        """The sums over loads as ``group_counts`` gives them: one row per subset, one column per digest of ``digests``."""
        rows = self.table("counts").where(F.col("digest").isin(list(digests.values())))
        sums = [F.coalesce(F.sum(F.when(F.col("digest") == d, F.col("n"))), F.lit(0).cast("long")).alias(c) for c, d in digests.items()]
        return rows.groupBy("subset").agg(*sums) if by_subset else rows.agg(*sums)

    def medians(self, digests: Mapping[str, str], national: bool = True, by_subset: bool = True) -> DataFrame:
        """``cell, national, subset, median`` over all loads, exact, as ``exact_medians`` gives them."""
        cells = F.create_map(*[F.lit(x) for c, d in digests.items() for x in (d, c)])
        own = lambda t: self.table(t).where(F.col("digest").isin(list(digests.values()))).withColumn("cell", cells[F.col("digest")])
        held = own("buckets").select("cell", "subset", "bucket", "n")
        values = own("values").select("cell", "subset", "bucket", "x", "n", "octave")
        if not national:
            held, values = held.where("subset IS NOT NULL"), values.where("subset IS NOT NULL")
        picked = middle_buckets(median_levels(held, national, by_subset))
        octaves = picked.select(F.shiftright("bucket", 10).cast("int").alias("octave")).distinct()
        # at most about 1,100 octaves exist, so this side is small whatever the data
        near = values.join(F.broadcast(octaves), "octave", "left_semi").drop("octave")
        return middle_values(median_levels(near, national, by_subset), picked)
