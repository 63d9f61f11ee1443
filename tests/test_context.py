import pytest

from textpack.operators import context
from textpack.operators.vocabulary import Vocabulary

CHAT = Vocabulary().with_chat_tokens()
SCHEMA = "conv_id long, turn long, role string, text string"

# A token is a byte or a control token: <|user|> + 2 + <|assistant|> + 2 + <|end|> is 7 tokens for a pair of two
# letters each, and <|user|> + 2 + <|assistant|> is 4 for a prompt. Each conversation: its turns, and for each
# prompt the turn, how many pairs are still held within 18 tokens, and the transcript.
PAIR = "<|user|>{}<|assistant|>{}<|end|>"
CONVERSATIONS = {
    1: ([(0, "user", "aa"), (1, "assistant", "bb"), (2, "user", "cc"), (3, "assistant", "dd"), (4, "user", "ee"),
         (5, "assistant", "ff"), (6, "user", "gg")],
        [(0, 0, "<|user|>aa<|assistant|>"),
         (2, 1, PAIR.format("aa", "bb") + "<|user|>cc<|assistant|>"),
         (4, 2, PAIR.format("aa", "bb") + PAIR.format("cc", "dd") + "<|user|>ee<|assistant|>"),  # 18 tokens: fits
         (6, 2, PAIR.format("cc", "dd") + PAIR.format("ee", "ff") + "<|user|>gg<|assistant|>")]),
    2: ([(0, "system", "be kind"), (1, "user", "aa"), (2, "assistant", "bb"), (3, "user", "cc"), (4, "assistant", "dd"),
         (5, "user", "eee")],  # one token over: the oldest pair goes
        [(1, 0, "<|user|>aa<|assistant|>"), (3, 1, PAIR.format("aa", "bb") + "<|user|>cc<|assistant|>"),
         (5, 1, PAIR.format("cc", "dd") + "<|user|>eee<|assistant|>")]),
    3: ([(0, "user", "aa"), (1, "assistant", "bb"), (2, "user", "cc"), (3, "assistant", "dd"), (4, "user", "w" * 10)],
        [(0, 0, "<|user|>aa<|assistant|>"), (2, 1, PAIR.format("aa", "bb") + "<|user|>cc<|assistant|>"),
         (4, 0, "<|user|>" + "w" * 10 + "<|assistant|>")]),  # two pairs go at once
    4: ([(0, "user", "q" * 40)], [(0, 0, "<|user|>" + "q" * 40 + "<|assistant|>")]),  # too long alone
    5: ([(0, "user", " a "), (1, "user", "bb"), (2, "assistant", "c"), (3, "user", "  "), (4, "assistant", "zz"), (5, "user", "d")],
        [(0, 0, "<|user|>a<|assistant|>"), (1, 0, "<|user|>bb<|assistant|>"),
         (5, 1, PAIR.format("bb", "c") + "<|user|>d<|assistant|>")]),  # no reply, no pair; a blank turn doesn't count
    6: ([(0, "assistant", "x")], []),
}


def frame(spark, conversations):
    return spark.createDataFrame([(c, *turn) for c, (turns, _) in conversations.items() for turn in turns], SCHEMA)


@pytest.mark.parametrize("width,per_task", [(1 << 16, 1024), (2, 1), (1, 2)])
def test_history_within_the_context(spark, monkeypatch, width, per_task):
    monkeypatch.setattr(context, "CONTEXTS_PER_TASK", per_task)
    df = frame(spark, CONVERSATIONS).repartition(3)
    shown = sorted(map(tuple, context.render_transcript(df, CHAT, 18, width).collect()))
    assert shown == sorted((c, *prompt) for c, (_, prompts) in CONVERSATIONS.items() for prompt in prompts)
    held = {(r.conv_id, r.turn): r for r in context.chat_context(df, CHAT, 18, width).collect()}
    assert {k: r.n_pairs for k, r in held.items()} == {(c, t): n for c, t, n, _ in shown}
    assert len(held[1, 4].ids) == 18 and len(held[2, 5].ids) == 12 and len(held[4, 0].ids) == 18
    assert held[4, 0].ids[-1] == CHAT.specials["<|assistant|>"] and held[4, 0].ids[0] == held[4, 0].ids[1]


def long_conversation(n):
    turns = [(i, ("user", "assistant")[i % 2], "xyz"[: 1 + i % 3] * (1 + i * 7 % 5)) for i in range(n)]
    return {9: (turns, [])}


def test_as_much_history_as_fits(spark):
    """What is shown fits, is a tail of what came before, and would not fit with one more pair."""
    c = 60
    df = frame(spark, long_conversation(120))
    wide = {r.turn: r.ids for r in context.chat_context(df, CHAT, 10_000).collect()}
    pairs = {r.turn: r.n_pairs for r in context.chat_context(df, CHAT, 10_000).collect()}
    starts = {t: [i for i, x in enumerate(ids) if x == CHAT.specials["<|user|>"]] for t, ids in wide.items()}
    for r in context.chat_context(df, CHAT, c).collect():
        whole = wide[r.turn]
        assert len(r.ids) <= c and whole[len(whole) - len(r.ids):] == r.ids
        if r.n_pairs < pairs[r.turn]:
            assert len(whole) - starts[r.turn][pairs[r.turn] - r.n_pairs - 1] > c


def test_prompts_without_replies_share_their_history(spark):
    turns = [(0, "user", "aa"), (1, "assistant", "bb"), *((2 + i, "user", "cc") for i in range(5000))]
    df = frame(spark, {1: (turns, [])})
    placed = context.place_turns(df, CHAT)
    assert placed.select("start").distinct().count() == 2  # so windows run over two rows
    found = context.context_of(placed, 18).collect()
    assert len(found) == 5001 and all(r.n_pairs == 1 and len(r.ids) == 11 for r in found if r.turn)
