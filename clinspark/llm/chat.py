"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as

    ### Assistant: <text> NEWLINE </turn> NEWLINE

The control strings are ``###`` and ``</turn>``. A rendered turn is parsed again
and compared with its source. Where a control string stands bare in the text or
the turn comes back different, the text is escaped and compared once more: a
control string and the backslashes right before it get one more backslash, and reading
takes one away. A text with nothing to escape is written as it is.

A conversation's turns are streamed in order; formatted text is cut into rows
of about ``PART`` characters at turn ends, so a conversation of any length needs
no more memory than a part.

Defined results: a null or empty text is an empty text. A null role is an empty role;
a role outside the known ones is written percent-encoded behind ``=``. Turns
of a conversation are ordered by turn (null last), then role and text, so
that ties give one result; repeated rows are repeated turns. A null conv_id is a
conversation of its own. Extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from typing import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1 << 20
ROLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
FORMATTED = "conv_id long, part long, formatted string, mask array<struct<start: long, end: long>>"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


class FormatError(ValueError):
    """A rendered turn that does not come back as it was."""


@dataclass
class Template:
    """How turns are marked. ``conflict`` finds a control string with the backslashes before it."""

    head: str = "### {}: "
    end: str = "\n</turn>\n"
    conflict: re.Pattern = field(default_factory=lambda: re.compile(r"\\*(?:###|</turn>)"))
    escaped: re.Pattern = field(default_factory=lambda: re.compile(r"\\(\\*(?:###|</turn>))"))
    turn: re.Pattern = field(default_factory=lambda: re.compile(r"### ([A-Za-z]+|=[^:\s]*): "))

    def conflicts(self, written: str) -> bool:
        """Whether a control string stands in a text as it is written without a backslash before it."""
        return any(m[0][0] != "\\" for m in self.conflict.finditer(written))

    def escape(self, text: str) -> str:
        return self.conflict.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[1], text)

    def role(self, role: str) -> str:
        return ROLES.get(role) or "=" + quote(role, safe="")

    def plain_role(self, mark: str) -> str:
        return unquote(mark[1:]) if mark[:1] == "=" else {v: k for k, v in ROLES.items()}[mark]

    def render(self, role: str, written: str) -> tuple[str, int]:
        """The rendered turn, and where its text starts; ``written`` is escaped where it must be."""
        head = self.head.format(self.role(role))
        return head + written + self.end, len(head)

    def parse(self, formatted: str) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, start, end) of each turn; start and end bound the text as it is written."""
        at = 0
        while at < len(formatted):
            head = self.turn.match(formatted, at)
            if not head:
                raise FormatError(f"no turn starts at {at}")
            start, end = head.end(), formatted.find(self.end, head.end())
            if end < 0:
                raise FormatError(f"the turn at {at} has no end")
            yield self.plain_role(head[1]), self.unescape(formatted[start:end]), start, end
            at = end + len(self.end)


def rendered(role: str, text: str, template: Template) -> tuple[str, int]:
    """A turn that parses back to its source: what conflicts is escaped until it does."""
    written, tried = text, set()
    while written not in tried:
        out, start = template.render(role, written)
        try:
            if not template.conflicts(written) and [x[:2] for x in template.parse(out)] == [(role, text)]:
                return out, start
        except FormatError:
            pass
        tried.add(written)
        written = template.escape(text)
    raise FormatError(f"a turn of {role!r} does not come back as it was")


def format_conversations(turns: DataFrame, part: int = PART) -> DataFrame:
    """One row per part of a conversation: conv_id, part, formatted, mask.

    ``mask`` lists the [start, end) spans of the part's assistant texts.
    """
    template = Template()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
                            ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        now, number, texts, mask, size, done, done_size = (), 0, [], [], 0, [], 0

        def close():
            nonlocal texts, mask, size, number, done_size
            if texts:
                done.append({"conv_id": now[0], "part": number, "formatted": "".join(texts), "mask": mask})
                done_size += size
                texts, mask, size, number = [], [], 0, number + 1

        for b in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
                if now != (conv,):
                    close()
                    now, number = (conv,), 0
                out, start = rendered(role, text, template)
                if role == "assistant":
                    mask.append({"start": size + start, "end": size + len(out) - len(template.end)})
                texts.append(out)
                size += len(out)
                if size >= part:
                    close()
                if done_size >= part or len(done) >= 4096:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, done_size = [], 0
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    rows = (turns.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
                 .repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
                 .select("conv_id", "role", "text"))
    return rows.mapInArrow(write, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, parsed from the formatted text."""
    template = Template()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        now, turns, loss, counts, rows = (), None, None, None, []

        def close():
            if now:
                rows.append((now[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        def batch():
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            for conv, text, mask in zip(*(c.to_pylist() for c in b.columns)):
                if now != (conv,):
                    close()
                    now, turns, loss, counts = (conv,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                    if len(rows) >= 4096:
                        yield batch()
                        rows = []
                for role, said, _, _ in template.parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    counts[0] += 1
                for span in mask:
                    said = template.unescape(text[span["start"]:span["end"]])
                    loss.update(said.encode())
                    counts[1] += len(said)
                counts[2] += len(text)
        close()
        if rows:
            yield batch()

    rows = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
                     .select("conv_id", "formatted", "mask"))
    return rows.mapInArrow(read, DIGESTS)
