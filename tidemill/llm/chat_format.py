r"""Chat formatting with typed content parts.

A turn's content is a list of parts: ``kind`` (text, image, audio, document),
``text`` for text parts, ``ref`` and ``units`` (tiles, seconds, pages) for the
others. A visitor walks the parts in order and flattens them into one string:
text is escaped, an attachment leaves a placeholder. It records every
attachment with its reference and the number of tokens its placeholder expands
to, and the spans that carry the training loss.

    <|im_start|>ROLE\nCONTENT<|im_end|>\n

In texts a backslash becomes two, and ``<|`` becomes ``<\|``; in roles a line
feed becomes ``\n`` as well. So no text can look like a control string, and
``unescaped`` gives the text back.

Turns are formatted one by one: a conversation is the rows in their order, and
none has to fit into memory whole. Null texts and roles are empty; turns with
the same number are put in order by role and content; null turns come first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import col as named
from tidemill.llm.common import prepared

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of one tile, second or page.
TOKENS = {"image": 256, "audio": 25, "document": 512}
PART = "struct<kind:string,text:string,ref:string,units:long>"
FORMATTED = (
    "struct<formatted:string,loss:array<struct<a:long,b:long>>,"
    "attachments:array<struct<part:long,kind:string,ref:string,tokens:long>>,expanded:long>"
)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escaped_role(role: str) -> str:
    return escaped(role).replace("\n", "\\n")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


class Flatten:
    """Visits the parts of one turn."""

    def __init__(self, loss: bool):
        self.out: list[str] = []
        self.length = 0
        self.loss: list[dict] = []
        self.attachments: list[dict] = []
        self.wanted = loss

    def put(self, piece: str) -> None:
        self.out.append(piece)
        self.length += len(piece)

    def visit(self, at: int, part) -> None:
        if part["kind"] == "text":
            self.visit_text(at, part)
        elif part["kind"] in TOKENS:
            self.visit_attachment(at, part)
        else:
            self.visit_unknown(at, part)

    def visit_text(self, at: int, part) -> None:
        piece = escaped(part["text"] or "")
        if self.wanted and piece:
            self.loss.append({"a": self.length, "b": self.length + len(piece)})
        self.put(piece)

    def visit_attachment(self, at: int, part) -> None:
        kind = part["kind"]
        self.attachments.append({"part": at, "kind": kind, "ref": part["ref"], "tokens": TOKENS[kind] * max(1, int(part["units"] or 1))})
        self.put(f"<|{kind}|>")

    def visit_unknown(self, at: int, part) -> None:
        self.attachments.append({"part": at, "kind": part["kind"], "ref": part.get("ref"), "tokens": 0})
        self.put("<|unknown|>")


def formatted_turn(role: str | None, parts, loss_role: str = "assistant") -> dict:
    visitor = Flatten(role == loss_role)
    visitor.put(START + escaped_role(role or "") + "\n")
    for at, part in enumerate(parts if parts is not None else ()):
        if part is not None:
            visitor.visit(at, part)
    visitor.put(END + "\n")
    return {"formatted": "".join(visitor.out), "loss": visitor.loss, "attachments": visitor.attachments, "expanded": sum(a["tokens"] for a in visitor.attachments)}


def _formatted(roles: pd.Series, parts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([formatted_turn(r, p) for r, p in zip(roles, parts, strict=True)], columns=["formatted", "loss", "attachments", "expanded"])


def format_turns(turns: DataFrame, role_col: str = "role", parts_col: str = "parts", result: str = "chat") -> DataFrame:
    """``turns`` with a struct column ``result``: ``formatted``, ``loss`` spans (code points), ``attachments``, ``expanded`` tokens."""
    prepared(turns.sparkSession)
    return turns.withColumn(result, F.pandas_udf(_formatted, FORMATTED)(named(role_col), named(parts_col)))


def text_parts(text_col: str = "text"):
    """Plain text as a list of one text part."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(named(text_col), F.lit("")).alias("text"), none.alias("ref"), F.lit(None).cast("long").alias("units")))


class Reader:
    """Reads formatted turns of one conversation back, piece by piece."""

    def __init__(self):
        self.turns, self.loss, self.length = 0, 0, 0
        self.all, self.trained = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, loss) -> None:
        for m in _TURN.finditer(formatted):
            self.turns += 1
            self.all.update(f"{unescaped(m[1])}\n{unescaped(m[2])}\n".encode())
        for s in loss:
            text = unescaped(formatted[s["a"] : s["b"]])
            self.loss += len(text)
            self.trained.update(text.encode())
        self.length += len(formatted)

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss, self.trained.hexdigest(), self.length


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, conv_col: str = "conv_id", order: tuple[str, ...] = ("turn", "role", "text"), chat: str = "chat") -> DataFrame:
    """Read every conversation back from its formatted turns.

    Turns are dealt out by conversation and stream through in order; only
    running digests are held.
    """
    rows = formatted.select(named(conv_col).cast("long").alias("conv"), *[named(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(chat)["formatted"].alias("f"), F.col(chat)["loss"].alias("l"))
    dealt = rows.repartition("conv").sortWithinPartitions("conv", *[f"o{i}" for i in range(len(order))]).select("conv", "f", "l")

    def read(batches) -> Iterator[pd.DataFrame]:
        current, reader, out = None, None, []
        for pdf in batches:
            for conv, f, loss in zip(pdf["conv"], pdf["f"], pdf["l"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if reader is None or conv != current:
                    if reader:
                        out.append((current, *reader.row()))
                    current, reader = conv, Reader()
                reader.read(f, loss)
            if out:
                yield pd.DataFrame(out, columns=DIGEST.replace(" long", "").replace(" string", "").split(", ")).astype({"conv_id": "Int64"})
                out = []
        if reader:
            yield pd.DataFrame([(current, *reader.row())], columns=DIGEST.replace(" long", "").replace(" string", "").split(", ")).astype({"conv_id": "Int64"})

    return dealt.mapInPandas(read, DIGEST)
