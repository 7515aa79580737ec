"""Chat formatting of typed content parts.

A turn's content is a list of parts (text, image, audio, document). A visitor with one method a kind
flattens them into ordered placeholders and text; each attachment is recorded with its kind, reference,
place and expanded number of tokens. Turns are rendered one by one, as

    <|im_start|>role\\ntext<|im_end|>\\n

so rows need no order to be formatted. Inside roles and texts ``<|`` is escaped by a backslash after the
``<`` (one more where there are some already), which reading back undoes; no text can therefore open or
end a turn. The loss mask covers the escaped text of assistant turns.

``read_back`` streams the rendered turns of sorted partitions through a small parser, holding one batch
and one conversation's running digests, however long the conversation. A conversation's digest needs its
turns in order, so they meet in one task, but never in memory.

Null role or text: empty. Text parts that follow each other are one text, which is escaped as a whole, so no
split of a text into parts can open or end a turn either. A null part counts for nothing, a part of null kind
as text; a part of any other kind becomes the placeholder ``<|attachment|>`` and is recorded with its kind and
no tokens. Null and empty lists give an empty text. Rows that tie in (conversation, turn) are ordered by role and text; repeated rows
are turns of their own; a null conversation or turn comes first. No rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shipped

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<kind:string,text:string,ref:string,units:long>"
TURN_SCHEMA = ("conv_id long, turn long, role string, rendered string, loss_from int, loss_to int, "
               "attachments array<struct<kind:string,ref:string,place:long,tokens:long>>, n_tokens long")
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "<|nl|>")


def unescape_role(role: str) -> str:
    return unescape(role.replace("<|nl|>", "\n"))


class Flatten:
    """Visitor over the parts of one turn: collects text with placeholders, and the attachments.

    ``units``: images count tiles, audio counts seconds, documents count pages.
    """

    TOKENS = {"image": 85, "audio": 25, "document": 800}

    def __init__(self):
        self.out: list[str] = []
        self.run: list[str] = []       # texts since the last placeholder
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> None:
        if part is not None:
            kind = "text" if part["kind"] is None else part["kind"]
            method = getattr(self, f"visit_{kind}") if kind in ("text", *self.TOKENS) else self.visit_other
            method(part)

    def visit_text(self, part: dict) -> None:
        self.run.append(part["text"] or "")

    def _attach(self, part: dict, placeholder: str, tokens: int) -> None:
        self._end_run()
        self.out.append(f"<|{placeholder}|>")
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "place": len(self.attachments),
                                 "tokens": tokens})

    def _known(self, part: dict) -> None:
        self._attach(part, part["kind"], self.TOKENS[part["kind"]] * max(1, part["units"] or 1))

    visit_image = visit_audio = visit_document = _known

    def visit_other(self, part: dict) -> None:
        self._attach(part, "attachment", 0)

    def _end_run(self) -> None:
        if self.run:
            self.out.append(escape("".join(self.run)))
            self.run.clear()

    def body(self) -> str:
        self._end_run()
        return "".join(self.out)


def text_parts(text: str) -> Column:
    """A plain text column as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.col(text).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 parts: str = "parts") -> DataFrame:
    """One row a turn with its rendered text, loss span (code points), attachments and their tokens."""
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.col(parts).cast(f"array<{PART}>").alias("parts"))

    attachment = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("place", pa.int64()), ("tokens", pa.int64())])
    out = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("rendered", pa.string()),
                     ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("attachments", pa.list_(attachment)),
                     ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, 500) for whole in batches for a in range(0, whole.num_rows, 500)):
            found = []
            for row in batch.to_pylist():
                visitor = Flatten()
                for part in row["parts"] or []:
                    visitor.visit(part)
                head = f"{START}{escape_role(row['role'])}\n"
                body = visitor.body()
                loss = (len(head), len(head) + len(body)) if row["role"] == "assistant" else (0, 0)
                found.append({"conv_id": row["conv_id"], "turn": row["turn"], "role": row["role"],
                              "rendered": f"{head}{body}{END}\n", "loss_from": loss[0], "loss_to": loss[1],
                              "attachments": visitor.attachments,
                              "n_tokens": sum(a["tokens"] for a in visitor.attachments)})
            yield pa.RecordBatch.from_pylist(found, schema=out)

    return shipped(rows).mapInArrow(run, TURN_SCHEMA)


class _Digest:
    """What is read back of one conversation so far."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str, loss_from: int, loss_to: int) -> None:
        if not rendered.startswith(START) or not rendered.endswith(END + "\n"):
            raise ValueError(f"not a rendered turn of conversation {self.conv}")
        role, _, body = rendered[len(START):-len(END) - 1].partition("\n")
        self.turns += 1
        self.chars += len(rendered)
        self.all.update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
        text = unescape(rendered[loss_from:loss_to])
        self.loss_chars += len(text)
        self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, parsed from its rendered turns in order."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            for conv, rendered, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now is None or now.conv != conv:
                    if now:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(rendered, a, b)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in done], schema=out)
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, now.row()))], schema=out)

    ordered = (formatted.repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "rendered")
               .select("conv_id", "rendered", "loss_from", "loss_to"))
    return shipped(ordered).mapInArrow(run, schema)
