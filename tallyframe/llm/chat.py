"""Chat formatting of conversations whose turns hold typed content parts.

A turn's content is an array of parts ``type, text, ref, width, height, seconds, pages``. A visitor takes the parts in
order: text is escaped, an image, audio or document part becomes its placeholder, its reference goes to ``attachments``
and its expanded number of tokens is recorded. Each turn becomes one segment ``<|im_start|>role\\ntext<|im_end|>\\n``; a
conversation's text is its segments in the order of ``turn``. Segments need no shuffle and no conversation is ever
gathered in memory: reading back sorts segments and takes them one after the other.

Control strings inside texts and roles get a backslash behind their first character, those that already have such
backslashes one more, so taking one away gives the text back.

Defined results: null roles and texts are empty, null parts arrays and null parts give nothing, an unknown type is text;
null turns come first, equal turns are ordered by role and content; a null ``conv_id`` is one conversation of its own.
Columns besides those named here are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: What may not stand in a text as it is: the template's own strings and those of common chat templates.
CONTROL = r"(<|\[)(\\*)(\|im_start\|>|\|im_end\|>|\|image\|>|\|audio\|>|\|document\|>|\|endoftext\|>|\|startoftext\|>|s>|/s>|SYS>>|/SYS>>|INST\]|/INST\])"
ESCAPED = CONTROL.replace(r"(\\*)", r"\\(\\*)")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: str) -> str:
    return re.sub(ESCAPED, r"\1\2\3", text)


def text_part(text: Column) -> Column:
    """Content of one text part, for tables that keep plain texts."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[F.lit(None).cast(t).alias(k) for k, t in none.items()])).cast(f"array<{PART}>")


def visit(part: Column, patch: int = 14, merge: int = 2, audio_rate: float = 25.0, page_tokens: int = 1024) -> Column:
    """One part as ``text, ref, kind, tokens``; tokens count what a placeholder expands to."""
    side = lambda x: F.ceil(F.coalesce(x, F.lit(0)) / (patch * merge))
    kind = F.when(part["type"].isin(*PLACEHOLDERS), part["type"])
    held = F.coalesce(part["text"], F.lit(""))
    shown = escape(held)
    for name, mark in PLACEHOLDERS.items():
        shown = F.when(part["type"] == name, F.lit(mark)).otherwise(shown)
    tokens = (
        F.when(kind == "image", side(part["width"]) * side(part["height"]))
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * audio_rate))
        .when(kind == "document", F.coalesce(part["pages"], F.lit(0)) * page_tokens)
        .otherwise(0)
        .cast("long")
    )
    return F.struct(shown.alias("text"), part["ref"].alias("ref"), kind.alias("kind"), tokens.alias("tokens"))


def format_turns(turns: DataFrame, learn: tuple[str, ...] = ("assistant",), **expand) -> DataFrame:
    """Segments ``conv_id, turn, segment, loss_from, loss_length, attachments, expanded_tokens`` of ``conv_id, turn, role, parts``.

    ``loss_from`` counts code points in the segment; ``loss_length`` is null where the turn isn't learned from.
    """
    parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    seen = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.transform(parts, lambda p: visit(p, **expand)).alias("seen"))
    body = F.array_join(F.transform("seen", lambda x: x["text"]), "")
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit("\n"))
    held = F.filter("seen", lambda x: x["kind"].isNotNull())
    return seen.withColumns({"head": head, "body": body}).select(
        "conv_id",
        "turn",
        F.concat("head", "body", F.lit(CLOSE + "\n")).alias("segment"),
        F.char_length("head").cast("long").alias("loss_from"),
        F.when(F.col("role").isin(*learn), F.char_length("body")).cast("long").alias("loss_length"),
        F.transform(held, lambda x: F.struct(x["kind"].alias("kind"), x["ref"].alias("ref"), x["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate("seen", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
    )


SEGMENT = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.S)
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads sorted segments one by one, parses each and keeps running digests of one conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    done: list[tuple] = []
    now: list | None = None

    def flush() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*done)] or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    close = lambda s: done.append((s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]))
    for batch in batches:
        got = batch.to_pydict()
        for conv, segment, begin, length in zip(got["conv_id"], got["segment"], got["loss_from"], got["loss_length"]):
            if now is None or now[0] != conv:
                if now is not None:
                    close(now)
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = SEGMENT.fullmatch(segment).groups()
            now[1] += 1
            now[2].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            now[5] += len(segment)
            if length is not None:
                learned = unescape(segment[begin : begin + length])
                now[3] += len(learned)
                now[4].update(learned.encode())
        if len(done) >= 10_000:
            yield flush()
    if now is not None:
        close(now)
    if done:
        yield flush()


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, read from the formatted text and its loss spans."""
    held = segments.select("conv_id", "turn", "segment", "loss_from", "loss_length")
    return held.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment").mapInArrow(_digests, DIGEST)
