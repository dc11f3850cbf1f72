"""Chat formatting by a grammar round trip.

Grammar of the rendered text, which a deterministic parser reads without looking back:

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Every turn is rendered as it is, reparsed and compared with its source.  A turn
that does not come back identical holds conflicting content: its text and role
get one level of escapes (a backslash inside each control string, and before
each backslash that already stands there) and are rendered again, until the
reparsed turn is identical.  The parser always takes one level off, so escapes
are reversible for every text.

Turns are shuffled by conversation and sorted by turn; a task then streams over
its conversations, however long they are, holding one batch at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from . import shared

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
# neither role nor text holds a control string: the first one that follows ends them
TURN = re.compile(r"<\|im_start\|>((?:(?!<\|im_(?:start|end)\|>)[^\n])*+)\n((?:[^<]|<(?!\|im_(?:start|end)\|>))*+)<\|im_end\|>\n")


def escape(text: str) -> str:
    return CONTROL.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of every turn; begin..end spans the text as rendered.  The whole input must parse."""
    turns, at = [], 0
    while at < len(rendered):
        m = TURN.match(rendered, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return turns


def render(role: str, text: str) -> str:
    """The turn in the grammar, escaped as far as its round trip needs."""
    head, body = role, text
    for _ in range(3):
        out = f"{START}{head}\n{body}{END}\n"
        try:
            back = parse(out)
        except ValueError:
            back = []
        if [(r, t) for r, t, _, _ in back] == [(role, text)]:
            return out
        head, body = escape_role(role), escape(text)
    raise ValueError("turn has no rendering")  # the escaped form always parses back


def format_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Rendered turns in order: (conv_id, position, role, formatted, begin, end, loss).

    ``formatted`` is the turn's piece of the conversation's text; joined in
    order of ``position`` (from 0) they are the whole.  ``begin`` and ``end``
    count characters from the conversation's start and span the turn's content
    as rendered; ``loss`` marks the spans to learn from (role ``assistant``).

    Null roles and texts count as empty.  Rows with a null conversation form
    one conversation; null turns come first; rows tied in turn are ordered by
    role, then text.  Repeated rows are repeated turns.  Partitions hold whole
    conversations, in order.  Other columns are ignored; an empty table gives
    an empty result.
    """
    shared.require(df, conv_col, turn_col, role_col, text_col)
    ship_package(df.sparkSession)
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, position, chars = ..., 0, 0
        for b in batches:
            out: list[tuple] = []
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if c != conv:
                    conv, position, chars = c, 0, 0
                piece = render(role, text)
                _, _, begin, end = parse(piece)[0]
                out.append((c, position, role, piece, chars + begin, chars + end, role == "assistant"))
                position, chars = position + 1, chars + len(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), t) for x, t in zip(zip(*out) if out else [()] * 7, TYPES)], names=NAMES)

    return rows.mapInArrow(run, "conv_id long, position long, role string, formatted string, begin long, end long, loss boolean")


NAMES = ["conv_id", "position", "role", "formatted", "begin", "end", "loss"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered text and the loss mask: (conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Streams over the partitions of ``format_turns`` (whole conversations in
    order), parses the rendered text and feeds running digests.  The loss text is
    what lies under the mask's spans (``begin`` to ``end`` where ``loss``), unescaped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = ..., None

        def done() -> pa.RecordBatch:
            n, turns, loss_chars, loss, chars = state
            return pa.RecordBatch.from_pylist([{
                "conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                "loss_sha256": loss.hexdigest(), "formatted_chars": chars}], schema=DIGESTS)

        for b in batches:
            finished = []
            for c, piece, begin, end, masked in zip(*(x.to_pylist() for x in b.columns)):
                if c != conv:
                    if state:
                        finished.append(done())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if masked:
                    text = unescape(piece[begin - state[4]: end - state[4]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(piece)
            if finished:
                yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
        if state:
            yield done()

    return formatted.select("conv_id", "formatted", "begin", "end", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def conversations(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted): whole rendered conversations, for corpora whose conversations fit a row."""
    piece: Column = F.struct("position", "formatted")
    joined = formatted.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return joined.select("conv_id", F.array_join(F.col("p.formatted"), "").alias("formatted"))
