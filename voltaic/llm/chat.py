"""Chat formatting of typed content parts.

A visitor flattens the parts of a turn in order: text is escaped, images, audio and
documents become placeholders, with a reference and an expanded token count recorded for
each.  Turns then join to one text per conversation, with the places of assistant content
as the loss mask.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_starts

#: Marks of the template.  Text can never hold "<|", so they cannot be forged.
TURN, CONTENT, END = "<|turn|>", "<|content|>", "<|end|>"
#: Starts of control strings, of this template and of others: an opening character, any number
#: of backslashes, and a tail.  Escaping adds one backslash, unescaping removes one.
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_FLAT = ("conv_id long, turn long, role string, content string, n_tokens long, "
         "attachments array<struct<kind:string,ref:string,tokens:long>>")
_ATTACHMENT = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])


def escape(text: str) -> str:
    return re.sub(_CONTROL, r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return re.sub(_ESCAPED, r"\1\2\3", text)


def unescaped(col: Column) -> Column:
    """:func:`unescape` as a column expression."""
    return F.regexp_replace(col, _ESCAPED, "$1$2$3")


class Flatten:
    """Visits the parts of one turn in order."""

    def __init__(self, image_patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 512):
        self.image_patch, self.audio_rate, self.page_tokens = image_patch, audio_rate, page_tokens
        self.content: list[str] = []
        self.attachments: list[dict] = []
        self.tokens = 0

    def visit(self, part: dict) -> None:
        kind = part.get("kind")
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.content.append(escape(text))
        self.tokens += len(text.split())

    def visit_image(self, part: dict) -> None:
        p = self.image_patch
        self.attach(part, -(-(part.get("width") or 0) // p) * -(-(part.get("height") or 0) // p))

    def visit_audio(self, part: dict) -> None:
        self.attach(part, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self.attach(part, (part.get("pages") or 0) * self.page_tokens)

    def visit_unknown(self, part: dict) -> None:
        """A part of another kind is kept as an attachment without tokens."""
        self.attach(part | {"kind": "other"}, 0)

    def attach(self, part: dict, tokens: int) -> None:
        self.content.append(f"<|{part['kind']}:{len(self.attachments)}|>")
        self.attachments.append({"kind": part["kind"], "ref": part.get("ref"), "tokens": tokens})
        self.tokens += tokens


def flatten(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, content, n_tokens, attachments of every turn (columns conv_id, turn,
    role, parts).  Text beside text meets escaped separately, so a control string cannot come
    together from two parts."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("content", pa.string()),
                        ("n_tokens", pa.int64()), ("attachments", pa.list_(_ATTACHMENT))])

    def run(batches):
        for b in batches:
            cols = {"conv_id": b.column("conv_id").to_pylist(), "turn": b.column("turn").to_pylist(),
                    "role": [escape(r or "") for r in b.column("role").to_pylist()], "content": [], "n_tokens": [], "attachments": []}
            for parts in b.column("parts").to_pylist():
                v = Flatten()
                merged: list[dict] = []
                for p in parts or []:
                    if p and p.get("kind") == "text" and merged and merged[-1].get("kind") == "text":
                        merged[-1] = {"kind": "text", "text": (merged[-1].get("text") or "") + (p.get("text") or "")}
                    elif p:
                        merged.append(p)
                for p in merged:
                    v.visit(p)
                cols["content"].append("".join(v.content))
                cols["n_tokens"].append(v.tokens)
                cols["attachments"].append(v.attachments)
            yield pa.RecordBatch.from_pydict(cols, schema=schema)

    return (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                         F.col("parts").cast(PARTS)).mapInArrow(run, _FLAT))


def text_parts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and parts for a table whose turns hold one text; null is empty."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
                    F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"),
                    F.lit(None).cast("int").alias("pages"))
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (spans of assistant content in
    code points, end exclusive), attachments in order, n_tokens.

    Turns are ordered by turn (null first), ties by role, then content; repeated rows are
    turns like others.  A null role is empty, a null or empty list of parts is empty content.
    Rows without a conv_id are conversations of one turn each.  An empty table gives no rows;
    other columns are not read.
    """
    flat = flatten(turns).withColumn("alone", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content", "attachments", "n_tokens")),
                           lambda a, b: _order(a, b))
    head = F.lit(len(TURN) + len(CONTENT))
    length = lambda t: head + F.length(t["role"]) + F.length(t["content"]) + len(END)
    spans = F.zip_with("t", running_starts(F.transform("t", length)), lambda t, at: F.struct(
        t["role"].alias("role"), (at + head + F.length(t["role"])).alias("start"),
        (at + head + F.length(t["role"]) + F.length(t["content"])).alias("end")))
    return (flat.groupBy("conv_id", "alone").agg(ordered.alias("t"))
            .select("conv_id",
                    F.array_join(F.transform("t", lambda t: F.concat(F.lit(TURN), t["role"], F.lit(CONTENT), t["content"], F.lit(END))), "").alias("formatted"),
                    F.transform(F.filter(spans, lambda s: s["role"] == "assistant"),
                                lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"),
                    F.flatten(F.transform("t", lambda t: t["attachments"])).alias("attachments"),
                    F.aggregate("t", F.lit(0).cast("long"), lambda a, t: a + t["n_tokens"]).alias("n_tokens")))


def _order(a: Column, b: Column) -> Column:
    """Comparator by turn (null first), role, content."""
    out = F.lit(0)
    for key in ("content", "role", "turn"):
        x, y = a[key], b[key]
        out = (F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1)
               .when(x < y, -1).when(x > y, 1).otherwise(out))
    return out


def turns_of(formatted: Column) -> Column:
    """Read back: array of (role, text) of a formatted conversation."""
    pattern = r"(?s)<\|turn\|>(.*?)<\|content\|>(.*?)<\|end\|>"
    return F.zip_with(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1)),
                      F.regexp_extract_all(formatted, F.lit(pattern), F.lit(2)),
                      lambda r, t: F.struct(unescaped(r).alias("role"), unescaped(t).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescaped(
        F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
