"""Conversations as one training text each, with a loss mask over its tokens.

A conversation is rendered whole and encoded once, with offsets; the spans of the assistant's texts and
the token spans are both sorted, so binary search finds the tokens of each turn. Turns are marked by
control strings, which are tokens of their own, so that no token crosses the edge of a turn.

    user        [INST]text[/INST]
    assistant   text</s>
    system      <<SYS>>text<</SYS>>
    any other   <<TURN>>role<<TEXT>>text<</TURN>>

In texts and roles a backslash is doubled, and a control string gets a backslash after its first
character; dropping one backslash before each character undoes both.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import Batches, in_tasks
from airwave.llm.tokens import BYTE_BPE, vocabulary_path

CONTROLS = [
    "[INST]",
    "[/INST]",
    "</s>",
    "<<SYS>>",
    "<</SYS>>",
    "<<TURN>>",
    "<<TEXT>>",
    "<</TURN>>",
]
ANSWERS = "assistant"
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

FORMATTED = (
    "conv_id long, formatted string, ids array<int>, token_starts array<int>, "
    "token_ends array<int>, loss_mask array<boolean>"
)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of the assistant's texts in it, both ascending."""
    out, spans, size = [], [], 0
    for role, text in turns:
        body = escape(text)
        if role == ANSWERS:
            spans.append((size, size + len(body)))
            parts = [body, "</s>"]
        elif role == "user":
            parts = ["[INST]", body, "[/INST]"]
        elif role == "system":
            parts = ["<<SYS>>", body, "<</SYS>>"]
        else:
            parts = ["<<TURN>>", escape(role), "<<TEXT>>", body, "<</TURN>>"]
        out += parts
        size += sum(map(len, parts))
    return "".join(out), spans


def parse(formatted: str) -> list[Turn]:
    """The turns back from the formatted text."""
    turns, role, start = [], ANSWERS, 0
    for control in _CONTROL.finditer(formatted):
        text = unescape(formatted[start : control.start()])
        start = control.end()
        match control[0]:
            case "[INST]":
                role = "user"
            case "<<SYS>>":
                role = "system"
            case "<<TEXT>>":
                role = text
            case "<<TURN>>":
                pass
            case _:
                turns.append((role, text))
                role = ANSWERS
    return turns


def mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens lie in one of the spans; all three ascend."""
    inside = np.zeros(len(starts), bool)
    if spans:
        low, high = np.array(spans).T
        first = np.searchsorted(ends, low, side="right")
        last = np.searchsorted(starts, high, side="left")
        for a, b, filled in zip(first, last, low < high, strict=True):
            if filled:
                inside[a:b] = True
    return inside


def under_mask(formatted: str, starts: list[int], ends: list[int], inside: list[bool]) -> str:
    """The unescaped text of the masked tokens; the tokens of one character count once."""
    out, done = [], 0
    run: list[int] | None = None
    for start, end, masked in zip(starts, ends, inside, strict=True):
        if masked:
            start = max(start, done)
            run = run or [start, start]
            run[1] = done = max(done, end)
        elif run:
            out.append(unescape(formatted[run[0] : run[1]]))
            run = None
    if run:
        out.append(unescape(formatted[run[0] : run[1]]))
    return "".join(out)


@lru_cache(maxsize=2)
def chat_tokenizer(name: str):
    """The public vocabulary with the control strings as tokens after its own."""
    from tokenizers import AddedToken, Tokenizer

    library = Tokenizer.from_file(vocabulary_path(name))
    library.add_special_tokens([AddedToken(c, normalized=False) for c in CONTROLS])
    return library


def format_chats(turns: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """One row per conversation: formatted text, token ids, token spans and loss mask.

    `turns` has conv_id, turn, role, text; other columns are ignored. Null texts and roles count as
    empty. Turns are ordered by number, nulls first; turns of one number, and repeated rows, all stay,
    by role and text. Rows without conv_id form one conversation. An empty table gives no rows. A
    conversation is one row of the result, so it must fit a task, as any row must.
    """

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        library = chat_tokenizer(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                chats = [[(t["role"], t["text"]) for t in c] for c in part.column(1).to_pylist()]
                rendered = [render(chat) for chat in chats]
                encoded = library.encode_batch([r[0] for r in rendered], add_special_tokens=False)
                columns: list[list] = [[], [], [], []]
                for (_, spans), one in zip(rendered, encoded, strict=True):
                    starts, ends = np.array(one.offsets, np.int32).reshape(-1, 2).T
                    inside = mask(spans, starts, ends)
                    for column, values in zip(columns, (one.ids, starts, ends, inside)):
                        column.append(values)
                lists = [pa.array(c, pa.list_(pa.int32())) for c in columns[:3]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([r[0] for r in rendered], pa.string()),
                        *lists,
                        pa.array(columns[3], pa.list_(pa.bool_())),
                    ],
                    ["conv_id", "formatted", "ids", "token_starts", "token_ends", "loss_mask"],
                )

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turn = F.struct(F.col("turn").cast("long").alias("turn"), *text)
    chats = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns")
    )
    return in_tasks(chats, run, FORMATTED)


def read_chats(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted rows hold: their turns, and the text under the loss mask."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                turns = parse(row["formatted"])
                loss = under_mask(
                    row["formatted"], row["token_starts"], row["token_ends"], row["loss_mask"]
                )
                told = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append(
                    {
                        "conv_id": row["conv_id"],
                        "n_turns": len(turns),
                        "turns_sha256": sha256(told.encode()).hexdigest(),
                        "loss_chars": len(loss),
                        "loss_sha256": sha256(loss.encode()).hexdigest(),
                        "formatted_chars": len(row["formatted"]),
                    }
                )
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    return in_tasks(
        formatted.select("conv_id", "formatted", "token_starts", "token_ends", "loss_mask"),
        run,
        DIGEST,
    )
