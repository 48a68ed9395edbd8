"""Secret scan: candidates by pattern, false positives removed by a random forest, in built-in functions and Spark's own trees.

Candidates are values assigned to a telling name and runs of 12 or more key characters with a digit. Features: length, shares of
digits, capitals and distinct characters, changes between character classes, vowels, coverage by dictionary words, marks of paths,
addresses and hosts, and what stands before and after (telling words, assignment, quotes, digits). The forest is trained on at most
``sample_rows`` labelled findings of each class (``candidate, before, after, label``). Texts are cut at the candidates, so contexts come from a text
once, however many candidates it has.

Defined results: null and empty texts have no candidate; repeated rows get equal findings; labelled findings of one class only:
every candidate is of that class; none at all: every candidate is a secret. Only ``doc_id`` and ``text`` are read;
``redacted`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, saved

NAMES = r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|access[_-]?key|credentials?"
RUN = r"[A-Za-z0-9+/_.@~-]"
CANDIDATE = rf"(?i:{NAMES})[\x22']?[ \t]{{0,2}}[:=][ \t]{{0,2}}[\x22']?[^\s\x22',;]{{6,}}|(?<!{RUN})(?=[A-Za-z+/_.@~-]*[0-9]){RUN}{{12,}}"
ASSIGNED = rf"^(?i:{NAMES})[\x22']?[ \t]*[:=][ \t]*[\x22']?"
#: Words of ordinary text and of placeholders.
DICTIONARY = (
    "the and for with that this from are was not you your have will has can all one our out new use used user name example sample test demo dummy "
    "placeholder change default public private password secret token key value file data page index home site mail host server local version license"
).split()
FEATURES = 18


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, candidate, before, after``: one row per candidate; ``start`` counts code points from 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("c"), text.alias("t")).where(F.size("c") > 0)
    between = cut.withColumn("p", F.split("t", CANDIDATE)).drop("t")
    each = between.select("doc_id", "text_hash", F.transform("p", lambda x: F.char_length(x)).alias("sizes"), "c", F.posexplode(F.transform("c", lambda x, i: F.struct(
        x.alias("candidate"), F.right(F.get("p", i), F.lit(40)).alias("before"), F.left(F.get("p", i + 1), F.lit(12)).alias("after")))).alias("i", "x"))
    shift = F.aggregate(F.slice("sizes", F.lit(1), F.col("i") + 1), F.lit(0), lambda a, n: a + n) + F.aggregate(F.slice("c", F.lit(1), F.col("i")), F.lit(0), lambda a, s: a + F.char_length(s))
    return each.select("doc_id", "text_hash", shift.cast("long").alias("start"), "x.candidate", "x.before", "x.after")


def value(candidate: Column) -> Column:
    """What of the candidate would be the secret: the assigned value, else all of it."""
    return F.regexp_replace(candidate, ASSIGNED, "")


def features(candidate: Column, before: Column, after: Column) -> Column:
    v = value(candidate)
    n = F.greatest(F.char_length(v), F.lit(1)).cast("double")
    count = lambda pattern, x=v: F.regexp_count(x, F.lit(pattern)).cast("double")
    changes = count("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")
    uncovered = F.char_length(F.regexp_replace(F.lower(v), "|".join(DICTIONARY), "")).cast("double")
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return F.array(
        n,
        count("[0-9]") / n,
        count("[A-Z]") / n,
        count("[a-z]") / n,
        F.size(F.array_distinct(F.split(v, ""))).cast("double") / n,
        changes / n,
        count("(?i)[aeiou]") / n,
        count("(?i)[bcdfghjklmnpqrstvwxyz]{4,}"),
        1 - uncovered / n,
        count("[/\\\\]"),
        count("[.]"),
        count("@"),
        flag(v.rlike("^[0-9a-f]+$")),
        flag(v.rlike("^[0-9.+/_-]+$")),
        flag(candidate.rlike(ASSIGNED)),
        flag(before.rlike(rf"(?i)({NAMES}|auth|bearer|login)\W{{0,6}}\w{{0,12}}\W{{0,4}}$")),
        flag(before.rlike(r"[=:]\s*[\x22']?$")),
        flag(after.rlike(r"^[\x22']")),
    )


def labelled(found: DataFrame) -> DataFrame:
    """Findings whose form settles the label: provider keys and long random values given to telling names, against numbers and addresses."""
    v = value(F.col("candidate"))
    yes = v.rlike("^AKIA[0-9A-Z]{16}$") | (F.col("candidate").rlike(ASSIGNED) & v.rlike("^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z+/_=-]{16,}$"))
    no = v.rlike(r"^[0-9.+() -]+$") | v.rlike(r"^[\w.+-]+@[\w-]+(\.[\w-]+)+\.?$") | v.rlike(r"^(https?:)?/?/?[\w-]+(\.[\w-]+)+(/|$)")
    label = F.when(yes, 1.0).when(no, 0.0)
    return found.select("candidate", "before", "after", label.alias("label")).where("label IS NOT NULL")


def scored(found: DataFrame, findings: DataFrame, *, sample_rows: int = 5000, trees: int = 24, depth: int = 6, seed: int = 42) -> DataFrame:
    """``found`` with ``score``, the forest's share for "secret"."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    held = findings.dropDuplicates(["candidate", "before", "after", "label"])
    mixed = F.xxhash64("candidate", "before", "after")
    some = [held.where(F.col("label") == x).orderBy(mixed, "candidate", "before", "after").limit(sample_rows) for x in (0.0, 1.0)]
    cells = features(F.col("candidate"), F.col("before"), F.col("after"))
    rows = saved(some[0].unionByName(some[1]).select("label", cells.alias("cells")))
    kinds = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(kinds) < 2:
        return found.withColumn("score", F.lit(max(kinds, default=1.0)))
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    model = forest.fit(rows.withColumn("vector", array_to_vector("cells")).coalesce(1))
    judged = model.transform(found.withColumn("vector", array_to_vector(cells)))
    return judged.withColumn("score", vector_to_array("probability")[1]).select(*found.columns, "score")


def scan(docs: DataFrame, findings: DataFrame | None = None, *, threshold: float = 0.5, **options) -> DataFrame:
    """One row per candidate with ``score`` and ``secret``. Without labelled findings, those settled by their form are the labels."""
    found = saved(candidates(docs))
    return scored(found, labelled(found) if findings is None else findings, **options).withColumn("secret", F.col("score") >= threshold)


def by_document(docs: DataFrame, findings: DataFrame | None = None, **options) -> DataFrame:
    """``doc_id``, numbers of candidates and secrets, and the secrets' places, for every document."""
    judged = scan(docs, findings, **options)
    begin = F.col("start") + F.char_length("candidate") - F.char_length(value(F.col("candidate")))
    place = F.struct(begin.alias("start"), F.char_length(value(F.col("candidate"))).cast("long").alias("length"), F.round("score", 6).alias("score"))
    rows = judged.groupBy("doc_id", "text_hash", "start").agg(F.first("secret").alias("secret"), F.first(place).alias("place"))
    sums = rows.groupBy(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash")).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count_if("secret").alias("n_secrets"), F.sort_array(F.collect_list(F.when(F.col("secret"), F.col("place")))).alias("secrets")
    )
    each = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return each.join(sums, same, "left").select("doc_id", zero("n_candidates"), zero("n_secrets"), "secrets")


def redacted(docs: DataFrame, findings: DataFrame | None = None, *, mark: str = "<secret>", **options) -> DataFrame:
    """``docs`` with every secret's value replaced by ``mark``; ``n_chars`` follows the text where it is a column."""
    judged = scan(docs, findings, **options).where("secret").select(F.col("doc_id").alias("s_id"), F.col("text_hash").alias("s_hash"), value(F.col("candidate")).alias("v"))
    values = judged.groupBy("s_id", "s_hash").agg(F.array_sort(F.collect_set("v"), lambda a, b: F.when(F.char_length(a) == F.char_length(b), 0).otherwise(F.signum(F.char_length(b) - F.char_length(a))).cast("int")).alias("vs"))
    held = packed(docs, id_=F.col("doc_id"), hash_=F.xxhash64("text"))
    same = F.col("id_").eqNullSafe(F.col("s_id")) & (F.col("hash_") == F.col("s_hash"))
    text = F.aggregate("vs", F.col("row_.text"), lambda t, v: F.replace(t, v, F.lit(mark)))
    row = F.col("row_").withField("text", F.when(F.col("vs").isNull(), F.col("row_.text")).otherwise(text))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("vs").isNull(), F.col("row_.n_chars")).otherwise(F.char_length(text).cast("long")))
    return held.join(values, same, "left").select(row.alias("row_")).select("row_.*")
