"""Which conditions may run beside others: those that Spark accepts in a counter and that no row can make fail.

All conditions of a run share one job, so one that raises on some row would take every cell with it. A condition is read
as Spark's analyzed expression. Expressions that give a value or NULL for any input are ``TOTAL``. Functions of a pattern, format or
position that is part of the condition are tried once with it, on the driver. Anything else may raise on some row:
patterns taken from the data, ``raise_error``, functions not known here, user-defined ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.local import local_table
from tallyframe.operators.conditions import Condition, Node
from tallyframe.operators.counts import lenient

#: Expressions that never raise where casts and arithmetic are lenient.
TOTAL = frozenset(
    """
    Alias AggregateExpression Count AttributeReference Literal Cast And Or Not If CaseWhen Between With CommonExpressionRef
    CommonExpressionDef EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual In InSet IsNull IsNotNull IsNaN
    Coalesce Nvl Nvl2 NullIf Greatest Least
    Add Subtract Multiply Divide IntegralDivide Remainder Pmod UnaryMinus UnaryPositive Abs Signum Round BRound Floor Ceil RoundFloor
    RoundCeil Sqrt Exp Log Log10 Log2 Pow BitwiseAnd BitwiseOr BitwiseXor BitwiseNot TryAdd TrySubtract TryMultiply TryDivide
    Length OctetLength BitLength Upper Lower InitCap StringTrim StringTrimLeft StringTrimRight StringTrimBoth Substring Left Right
    SubstringIndex Concat ConcatWs StringInstr StringLocate StringReplace StringTranslate StringLPad StringRPad Reverse Ascii
    Contains StartsWith EndsWith Levenshtein SoundEx Md5 Sha1 Crc32 XxHash64 Murmur3Hash
    Year Quarter Month DayOfMonth DayOfWeek WeekDay DayOfYear WeekOfYear Hour Minute Second DateAdd DateSub DateDiff MonthsBetween
    LastDay TruncDate TruncTimestamp CurrentDate CurrentTimestamp TimestampDiff DatePart Extract UnixDate
    GetArrayItem GetMapValue GetStructField Size ArrayContains CreateArray CreateNamedStruct
    """.split()
)


def _regex(node: Node) -> Column:
    return F.lit("x").rlike(node.children[1].value)


def _group(node: Node) -> Column:
    """The pattern made to match anywhere, so that the group's number counts."""
    return F.regexp_extract(F.lit("x"), f"(?:{node.children[1].value})|", int(node.children[2].value))


def _replacement(node: Node) -> Column:
    return F.regexp_replace(F.lit("x"), f"(?:{node.children[1].value})|", node.children[2].value)


def _date_format(node: Node) -> Column:
    pattern = node.children[1].value
    return F.concat_ws(" ", F.to_timestamp(F.lit("2000-01-01"), pattern), F.date_format(F.lit("2000-01-01").cast("timestamp"), pattern))


def _parsing(node: Node) -> Column:
    return F.to_timestamp(F.lit("2000-01-01"), node.children[1].value) if len(node.children) > 1 else F.lit("x")


#: How an expression whose arguments behind the first are literals is tried; the first one is the data.
TRIED: dict[str, Callable[[Node], Column]] = {
    "RLike": _regex,
    "StringSplit": _regex,
    "RegExpCount": _regex,
    "RegExpExtract": _group,
    "RegExpReplace": _replacement,
    "Like": lambda n: F.lit("x").like(n.children[1].value),
    "ILike": lambda n: F.lit("x").ilike(n.children[1].value),
    "ParseToDate": _parsing,
    "ParseToTimestamp": _parsing,
    "GetTimestamp": _parsing,
    "UnixTimestamp": _parsing,
    "ToUnixTimestamp": _parsing,
    "DateFormatClass": _date_format,
    "FromUnixTime": _date_format,
    "ElementAt": lambda n: F.element_at(F.array(F.lit(1)), int(n.children[1].value)),
    "AddMonths": lambda n: F.add_months(F.lit("2000-01-01").cast("date"), int(n.children[1].value)),
    "DateAddYMInterval": lambda n: F.lit("x"),
}


def _trials(node: Node) -> list[Column] | None:
    """What has to be tried before the condition may run; None if it may raise whatever the trials give."""
    own: list[Column] = []
    if node.kind in TRIED:
        if any(c.kind != "Literal" or c.value is None for c in node.children[1:]):
            return None
        try:
            own = [TRIED[node.kind](node)]
        except ValueError:  # a literal of another kind than the trial takes
            return None
    elif node.kind not in TOTAL:
        return None
    for child in node.children:
        more = _trials(child)
        if more is None:
            return None
        own += more
    return own


def _run(spark: SparkSession, trials: list[Column]) -> bool:
    """Whether all of them give a value. Rows of literals are evaluated on the driver, without a job."""
    try:
        with lenient(spark):
            tried = local_table(spark, [("x",)], "t string").select(*[t.cast("string").alias(f"t{i}") for i, t in enumerate(trials)])
        tried.collect()
    except (PySparkException, Py4JJavaError):  # some patterns fail with an error of the JVM
        return False
    return True


def failing_conditions(spark: SparkSession, analysis: Mapping[str, Condition | None], contain: bool = True) -> set[str]:
    """Texts that can't be counted beside others: Spark rejects them or, with ``contain``, some row could make them raise. Runs no job."""
    bad = {text for text, condition in analysis.items() if condition is None}
    if not contain:
        return bad
    trials = {text: _trials(condition.node) for text, condition in analysis.items() if condition is not None}
    bad |= {text for text, needed in trials.items() if needed is None}
    needed = {text: t for text, t in trials.items() if t}
    if needed and not _run(spark, [t for each in needed.values() for t in each]):
        bad |= {text for text, each in needed.items() if not _run(spark, each)}
    return bad
