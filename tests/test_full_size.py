"""The chain on a vocabulary of full size, against the public library and brute force."""

import random

import pytest

from textpack.constants import BASE_VOCAB_SIZE, CHAT_TOKENS
from textpack.functions import text as T
from textpack.operators import encode
from textpack.plans import catalog, inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library(spark):
    """The library, trained on the same stories with the same special tokens."""
    from tests.test_tokens import library as trained

    stories = [r.text for r in catalog.scan_corpus(spark, FOLDER).collect()]
    theirs = trained(stories, BASE_VOCAB_SIZE)
    theirs.add_special_tokens(CHAT_TOKENS)
    return theirs


@pytest.fixture(scope="module")
def vocabulary(spark):
    return catalog.full_vocabulary(spark, FOLDER)


def test_vocabulary(spark, library, vocabulary):
    assert vocabulary.size == BASE_VOCAB_SIZE + len(CHAT_TOKENS)
    found = library.get_vocab()
    rows = {r.token: (r.id, r.special) for r in catalog.bpe_train_full(spark, FOLDER).collect()}
    assert {t: i for t, (i, _) in rows.items()} == found


def test_every_document_is_encoded_alike(spark, library, vocabulary):
    rows = inputs.documents(spark, FOLDER).collect()
    expected = {r.doc_id: e.ids for r, e in zip(rows, library.encode_batch([r.text for r in rows]))}
    got = {r.doc_id: (r.n_tokens, r.ids) for r in catalog.bpe_encode_full(spark, FOLDER).collect()}
    assert got == {k: (len(v), str(v)) for k, v in expected.items()}


def test_chat_blocks_hold_the_kept_conversations(spark, library, vocabulary):
    from textpack.operators.clean import english_pairs

    lines = english_pairs(inputs.pairs(spark, FOLDER)).select("line").collect()
    lengths = [n for n in (len(library.encode(r.line).ids) for r in lines) if n <= 250]
    manifest = {(r.artifact, r.metric): r.value for r in catalog.dataset_manifest_full(spark, FOLDER).collect()}
    assert manifest["formatted", "rows"] == len(lengths) and manifest["formatted", "tokens"] == sum(lengths)
    assert manifest["train", "rows"] + manifest["val", "rows"] == len(lengths)
    assert manifest["vocabulary", "tokens"] == vocabulary.size
    blocks = catalog.pack_chat_full(spark, FOLDER).collect()
    for split in ("train", "val"):
        assert sum(b.split == split for b in blocks) == max(0, (manifest[split, "tokens"] - 1) // 256)


def test_contexts_by_brute_force(spark, library, vocabulary):
    turns = inputs.conversations(spark, FOLDER)
    stripped = turns.select("conv_id", "turn", "role", T.py_strip("text").alias("text")).orderBy("conv_id", "turn").collect()
    by_conversation = {}
    for r in stripped:
        if r.role in ("user", "assistant"):
            by_conversation.setdefault(r.conv_id, []).append(r)
    expected = {}
    for key, own in by_conversation.items():
        pairs = []
        for i, r in enumerate(own):
            if r.role != "user" or not r.text:
                continue
            prompt = library.encode(f"<|user|>{r.text}<|assistant|>").ids
            history, shown = [], 0
            for pair in reversed(pairs):
                if sum(map(len, history)) + len(pair) + len(prompt) > 256:
                    break
                history.insert(0, pair)
                shown += 1
            expected[key, r.turn] = (shown, [x for p in history for x in p] + prompt[-256:])
            if i + 1 < len(own) and own[i + 1].role == "assistant":
                pairs.append(prompt + library.encode(own[i + 1].text).ids + library.encode("<|end|>").ids)
    got = {(r.conv_id, r.turn): (r.n_pairs, r.ids) for r in catalog.chat_context_full(spark, FOLDER).collect()}
    assert got == {k: (n, str(ids)) for k, (n, ids) in expected.items()}
    shown = {(r.conv_id, r.turn): r.n_pairs for r in catalog.render_transcript_full(spark, FOLDER).collect()}
    assert shown == {k: n for k, (n, _) in expected.items()}


def test_round_trip_is_checked_on_the_whole_vocabulary(spark, tmp_path, monkeypatch):
    """Every check of the query uses all tokens that the library learns from the same stories, and the chat tokens."""
    from tests.test_tokens import library as trained

    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(2000)]
    texts = [" ".join(draw.choices(words, k=60)) for _ in range(150)]
    texts += [texts[0], "  ", "", None, "é\U0001f600 <|end|> a\x00b", "<|endoftext|>"]
    spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string") \
        .coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(1, 0, "user", f"{words[0]}?"), (1, 1, "assistant", " ".join(words[:40])), (2, 0, "user", None),
             (2, 1, "assistant", "<|user|> <|end|>"), (2, 2, "user", "unanswered")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string") \
        .coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")

    used = []
    check, controls = encode.roundtrip_check, encode.special_token_check
    monkeypatch.setattr(encode, "roundtrip_check", lambda rows, vocab: used.append(vocab) or check(rows, vocab))
    monkeypatch.setattr(encode, "special_token_check", lambda vocab, rows: used.append(vocab) or controls(vocab, rows))
    got = {r.what: (r.n_rows, r.n_bad) for r in catalog.roundtrip_check(spark, str(tmp_path)).collect()}
    assert got == {"documents": (len(texts), 0), "chat lines": (2, 0), "control <|endoftext|>": (0, 0),
                   "control <|user|>": (3, 0), "control <|assistant|>": (2, 0), "control <|end|>": (3, 0)}
    theirs = trained([t.strip() for t in texts if t and t.strip()], BASE_VOCAB_SIZE)
    theirs.add_special_tokens(CHAT_TOKENS)
    expected = sorted(theirs.get_vocab(), key=theirs.get_vocab().get)
    assert len(expected) == BASE_VOCAB_SIZE + len(CHAT_TOKENS)
    assert [v.tokens() for v in used] == [expected] * 3
