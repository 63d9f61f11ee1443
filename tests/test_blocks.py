import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textpack.operators import blocks

END = "<|endoftext|>"
SCHEMA = "src string, line_no long, line string"

# What each file holds, and the pairs expected from it as (closing line, request, story).
FILES = {
    "plain": (["Summary: a fox", "Story: Once", "upon", END], [(3, "Summary: a fox", "Once upon")]),
    "padded end": (["Words: x", "Story: y", f"  {END} "], [(2, "Words: x", "y")]),
    "text before the end token": (["Words: x", "Story: y", f"z {END}", END], [(3, "Words: x", f"y z {END}")]),
    "story line without text": (["Features: Twist", "Story:", "it began", END], [(3, "Features: Twist", "it began")]),
    "two story lines": (["Words: x", "Story: one", "Story: two", END], [(3, "Words: x", "one two")]),
    "prefix inside a story": (["Words: x", "Story: one", "Words: in it", END], [(3, "Words: x", "one Words: in it")]),
    "prefix twice in a line": (["Words: x", "Story:Story: y", END], [(2, "Words: x", "Story: y")]),
    "several requests": (["Features: F", "Words: a, b", "Summary: s", "Story: t", END],
                         [(4, "Features: F Words: a, b Summary: s", "t")]),
    "stray lines": (["stray", "Words: x", "stray", "", None, "Story: y", "", None, END], [(8, "Words: x", "y")]),
    "white space": (["  Words:\ta   b ", "\x85Story: c\x1c", " d\u00a0 e ", END], [(3, "Words: a b", "c d e")]),
    "letter case counts": (["words: x", "story: y", END, "Words: x", "Story: y", END], [(5, "Words: x", "y")]),
    "a mark in front counts": (["Words: x", "\ufeffStory: y", END], []),
    "request alone": (["Words: x", END], []),
    "story alone": (["Story: y", END], []),
    "end alone": ([END, END], []),
    "no end": (["Words: x", "Story: y"], []),
    "unclosed tail": (["Words: x", "Story: y", END, "Words: z", "Story: lost"], [(2, "Words: x", "y")]),
    "two blocks": (["Words: x", "Story: y", END, "Words: z", "Story: w", END],
                   [(2, "Words: x", "y"), (5, "Words: z", "w")]),
}


@pytest.mark.parametrize("width", [1, 2, 1 << 16])
def test_parse_blocks(spark, width):
    rows = [(name, i, line) for name, (lines, _) in FILES.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, blocks.parse_blocks(df, width).collect()))
    assert got == sorted((name, *pair) for name, (_, pairs) in FILES.items() for pair in pairs)


def many_lines(seed, n):
    draw = random.Random(seed)
    every = [line for lines, _ in FILES.values() for line in lines]
    return [(3 * i, draw.choice(every)) for i in range(n)]


def parsed(spark, lines, width=1 << 16):
    df = spark.createDataFrame([("s", n, line) for n, line in lines], SCHEMA)
    return sorted((r.end_line, r.user, r.assistant) for r in blocks.parse_blocks(df, width).collect())


def test_chunk_widths_agree(spark):
    lines = many_lines(1, 1500)
    whole = parsed(spark, lines)
    assert len(whole) > 50
    assert parsed(spark, lines, 7) == parsed(spark, lines, 1000) == whole


def test_a_closed_file_and_the_next_one_add_up(spark):
    first, second = [*many_lines(2, 300), (2000, END)], [(n + 3000, line) for n, line in many_lines(3, 300)]
    assert parsed(spark, first + second) == parsed(spark, first) + parsed(spark, second)


@given(st.integers(0, 250))
@settings(max_examples=5, deadline=None)
def test_what_is_not_closed_adds_nothing(spark, cut):
    lines = many_lines(4, 250)[:cut]
    closed = max((i for i, (_, line) in enumerate(lines) if (line or "").strip() == END), default=-1) + 1
    assert parsed(spark, lines) == parsed(spark, lines[:closed]) if closed else parsed(spark, lines) == []


@pytest.mark.parametrize("width", [2, 1 << 16])
def test_pair_turns(spark, width):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 5, "user", "c"), (1, 6, "user", "d"),
        (1, 9, "assistant", "e"), (1, 10, "assistant", "f"), (2, 3, "user", "g"), (2, 4, "system", "h"),
        (2, 40, "assistant", "i"), (3, 0, "assistant", "j"), (3, 1, "user", "k"), (4, 7, "user", "l")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, blocks.pair_turns(df, width).collect()))
    assert got == [(1, 1, "a", "b"), (1, 6, "d", "e"), (2, 3, "g", "i")]
