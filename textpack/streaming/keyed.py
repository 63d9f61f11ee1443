"""Stream operators whose state is kept by key in Spark's state store.

What a line or turn is, and its ids, is computed by row before the grouping; the state function only
puts rows of one key together. A micro-batch reads and writes the state of its own keys and no other; a key
that has been idle for a given time is retired.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textpack.constants import CONTEXT_LENGTH, END_TOKEN, EOS_TOKEN, INSTRUCTION_PREFIXES, STORY_PREFIX
from textpack.functions.text import collapse_ws, py_strip, render_open_prompt
from textpack.functions.tokens import encode_ids
from textpack.operators.vocabulary import Vocabulary

END, STORY, REQUEST, TEXT = 0, 1, 2, 3


def _in_order(parts: Iterator[pd.DataFrame], key: str, order: str, last: int | None) -> pd.DataFrame:
    rows = pd.concat(list(parts)).sort_values(order)
    if last is not None and len(rows) and rows[order].iloc[0] <= last:
        raise ValueError(f"rows of a {key} arrived out of {order} order")
    return rows


def _retire(state: GroupState, idle_ms: int | None) -> None:
    if idle_ms:
        state.setTimeoutDuration(idle_ms)


def _timeout(idle_ms: int | None) -> str:
    return GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout


def lines_by_kind(lines: DataFrame) -> DataFrame:
    """``src, line_no, kind, body`` of the lines that may count; blank ones never do."""
    text = F.col("_text")
    cleaned = lines.select("src", "line_no", py_strip(F.coalesce(F.col("line"), F.lit(""))).alias("_text")).where("_text <> ''")
    request: Column = F.lit(False)
    for prefix in INSTRUCTION_PREFIXES:
        request = request | text.startswith(prefix)
    kind = (F.when(text == EOS_TOKEN, END).when(text.startswith(STORY_PREFIX), STORY).when(request, REQUEST).otherwise(TEXT))
    body = F.when(text.startswith(STORY_PREFIX), py_strip(F.substring(text, len(STORY_PREFIX) + 1, 2**31 - 1))).otherwise(text)
    return cleaned.select("src", "line_no", kind.alias("kind"), body.alias("body"))


def parsed(lines: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """A stream of lines (src, line_no, line) as pairs (src, end_line, user, assistant).

    The state of a source is its open block. After ``idle_ms`` without a line that block is dropped.
    """
    kinds = lines_by_kind(lines)
    key = lines.schema["src"].dataType.simpleString()

    def assemble(src: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, in_story, user, story = state.get if state.exists else (None, False, "", "")
        rows = _in_order(parts, "src", "line_no", last)
        users, stories = ([user] if user else []), ([story] if story else [])
        closed = []
        for number, kind, body in zip(rows["line_no"].tolist(), rows["kind"].tolist(), rows["body"].tolist()):
            if kind == END:
                if users and stories:
                    closed.append((src[0], number, " ".join(users), " ".join(stories)))
                users, stories, in_story = [], [], False
            elif kind == STORY or in_story:
                in_story = True
                if body:
                    stories.append(body)
            elif kind == REQUEST:
                users.append(body)
            last = number
        state.update((last, in_story, " ".join(users), " ".join(stories)))
        _retire(state, idle_ms)
        yield pd.DataFrame(closed, columns=["src", "end_line", "user", "assistant"])

    pairs = kinds.groupBy("src").applyInPandasWithState(
        assemble, f"src {key}, end_line long, user string, assistant string",
        "last long, in_story boolean, user string, story string", "append", _timeout(idle_ms))
    return pairs.select("src", "end_line", collapse_ws("user").alias("user"), collapse_ws("assistant").alias("assistant")).where(
        (F.col("user") != "") & (F.col("assistant") != ""))


def contexts(turns: DataFrame, vocabulary: Vocabulary, context_length: int = CONTEXT_LENGTH,
             idle_ms: int | None = None) -> DataFrame:
    """A stream of turns (conv_id, turn, role, text) as contexts (conv_id, turn, n_pairs, ids) of its user turns.

    The state of a conversation is the pairs that may still fit, at most C ids, and the request that may
    be waiting for its reply. After ``idle_ms`` without a turn it is forgotten.
    """
    c, end_id = context_length, vocabulary.specials[END_TOKEN]
    text = py_strip(F.coalesce("text", F.lit("")))
    asked = F.col("role") == "user"
    said = F.when(asked, render_open_prompt("text")).otherwise(F.col("text"))
    spoken = turns.where(F.col("role").isin("user", "assistant")).select("conv_id", "turn", "role", text.alias("text")).select(
        "conv_id", "turn", (asked & (F.col("text") != "")).alias("prompt"), asked.alias("asked"),
        encode_ids(said, vocabulary).alias("ids"))
    key = turns.schema["conv_id"].dataType.simpleString()

    def follow(conversation: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, sizes, flat, waiting = state.get if state.exists else (None, [], [], None)
        rows = _in_order(parts, "conv_id", "turn", last)
        pairs, at = [], 0
        for size in sizes:
            pairs.append(list(flat[at:at + size]))
            at += size
        shown = []
        for turn, prompt, own_turn, ids in zip(rows["turn"].tolist(), rows["prompt"].tolist(), rows["asked"].tolist(), rows["ids"]):
            if prompt:
                ids = [int(i) for i in ids]
                room, first = c - len(ids), len(pairs)
                while first and len(pairs[first - 1]) <= room:
                    first -= 1
                    room -= len(pairs[first])
                shown.append((conversation[0], turn, len(pairs) - first, [i for p in pairs[first:] for i in p] + ids[-c:]))
                waiting = ids
            elif not own_turn and waiting is not None:
                pairs.append([*waiting, *(int(i) for i in ids), end_id])
                held, first = 0, len(pairs)
                while first and held + len(pairs[first - 1]) <= c:
                    first -= 1
                    held += len(pairs[first])
                pairs, waiting = pairs[first:], None
            else:
                waiting = None
            last = turn
        state.update((last, [len(p) for p in pairs], [i for p in pairs for i in p], waiting))
        _retire(state, idle_ms)
        yield pd.DataFrame(shown, columns=["conv_id", "turn", "n_pairs", "ids"])

    return spoken.groupBy("conv_id").applyInPandasWithState(
        follow, f"conv_id {key}, turn {turns.schema['turn'].dataType.simpleString()}, n_pairs int, ids array<int>",
        "last long, sizes array<int>, flat array<int>, waiting array<int>", "append", _timeout(idle_ms))
