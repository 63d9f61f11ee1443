import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from textpack.constants import CHAT_TOKENS, EOS_TOKEN, byte_ids
from textpack.functions import tokens as K
from textpack.operators import bpe, encode, vocabulary
from textpack.operators.vocabulary import Vocabulary

CONTROLS = [EOS_TOKEN, *CHAT_TOKENS]
EDGE = [
    "a  b\n\n c \n\nd   \n'sx  42 é", "\U0001f600\U0001f600 \U0001f468‍\U0001f469", "", "aaaa",
    "a\x00b", "<|end|>", "x <|end|>  <|user|>y<|endoftext|>", "<<|end|>>", "<|end", "|>", "don't I'll",
    "  lead", "tail  ", "\t\n", "a\x1cb\x1d\x1ec", " non breaking　wide", "²½Ⅷ",
    "a" * 3000, "<>" * 2000, "!" * 5000 + "<|end|>", " " * 4000,
]


def corpus():
    import pyarrow.parquet as pq

    folder = Path("/root/testdata/sf0.001")
    return pq.read_table(folder / "documents.parquet")["text"].to_pylist()


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def ids_of(spark, texts, vocab):
    rows = table(spark, texts).select("i", K.encode_ids("t", vocab).alias("ids"))
    return [r.ids for r in rows.orderBy("i").collect()]


def library(texts, size):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import decoders, models, pre_tokenizers, trainers

    made = tokenizers.Tokenizer(models.BPE())
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    made.decoder = decoders.ByteLevel()
    made.train_from_iterator(texts, trainers.BpeTrainer(
        vocab_size=size, special_tokens=[EOS_TOKEN], show_progress=False,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet()))
    return made


@pytest.fixture(scope="module")
def trained(spark):
    """A vocabulary of 700 learned here, and the same learned by the public library."""
    texts = corpus()
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    return bpe.train_vocabulary(bpe.piece_counts(rows), 700), library(texts, 700)


def test_pieces_match_library(spark):
    pre = pytest.importorskip("tokenizers").pre_tokenizers.ByteLevel(add_prefix_space=False)
    texts = [t for t in EDGE if "<|" not in t] + corpus()[:100]
    rows = table(spark, texts).select("i", F.transform(K.pieces("t", []), K.byte_text).alias("p"))
    ours = [r.p for r in rows.orderBy("i").collect()]
    assert ours == [[p for p, _ in pre.pre_tokenize_str(t)] for t in texts]


def test_training_matches_library(trained):
    ours, theirs = trained
    vocab = theirs.get_vocab()
    assert ours.tokens() == sorted(vocab, key=vocab.get)


def test_encoding_matches_library(spark, trained):
    ours, theirs = trained
    chat = ours.with_chat_tokens()
    theirs.add_special_tokens(CHAT_TOKENS)
    assert [theirs.token_to_id(t) for t in CHAT_TOKENS] == [chat.specials[t] for t in CHAT_TOKENS]
    texts = EDGE + corpus()
    expected = [e.ids for e in theirs.encode_batch(texts)]
    assert ids_of(spark, texts, chat) == expected
    rows = spark.createDataFrame([(i, e) for i, e in enumerate(expected)], "i int, ids array<int>")
    for skip in (True, False):
        decoded = rows.select("i", K.decode_ids("ids", chat, skip).alias("t")).orderBy("i").collect()
        assert [r.t for r in decoded] == [
            theirs.decode(e, skip_special_tokens=skip) for e in expected]


def test_broken_utf8_decodes_to_replacement(spark, trained):
    ours, theirs = trained
    cut = [ids_of(spark, ["é\U0001f600"], Vocabulary())[0][:n] for n in range(1, 6)]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cut)], "i int, ids array<int>")
    decoded = rows.select("i", K.decode_ids("ids", ours).alias("t")).orderBy("i").collect()
    assert [r.t for r in decoded] == [theirs.decode(c) for c in cut]


def test_byte_encoding(spark):
    chat = Vocabulary().with_chat_tokens()
    base = byte_ids()
    got = ids_of(spark, EDGE, chat)
    counted = table(spark, EDGE).select(
        "i", K.byte_count("t", CONTROLS).alias("n")).orderBy("i").collect()
    assert [len(g) for g in got] == [r.n for r in counted]
    assert got[EDGE.index("<<|end|>>")] == [base[ord("<")], chat.specials["<|end|>"], base[ord(">")]]
    plain = "a\x00b"
    assert got[EDGE.index(plain)] == [base[b] for b in plain.encode()]


def test_roundtrip_and_controls(spark, trained):
    chat = trained[0].with_chat_tokens()
    rows = table(spark, EDGE).select(F.col("t").alias("text"))
    assert encode.roundtrip_check(rows, chat).first().asDict() == {"n_rows": len(EDGE), "n_bad": 0}
    for r in encode.special_token_check(chat, rows).collect():
        assert r.n_text == r.n_ids


def test_pieces_kept_from_earlier_slices(trained, monkeypatch):
    import pyarrow as pa

    ours = trained[0].with_chat_tokens()
    cut = [t.replace(" ", "\x1f ").split("\x1f") + ["<|end|>", "don", "'t"] for t in corpus()[:40] if t]
    batch = pa.array([[p for p in row if p] for row in cut])
    whole = K._piece_encoder(ours)(batch).to_pylist()
    for size in (1, 300, 3000):
        monkeypatch.setattr(K, "SLICE", size)
        assert K._piece_encoder(ours)(batch).to_pylist() == whole


def one_at_a_time(ids, merges):
    rank = {(a, b): (r, m) for r, (a, b, m) in enumerate(merges)}
    ids = list(ids)
    while True:
        found = [(rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        if not found:
            return ids
        (_, merged), i = min(found)
        ids[i:i + 2] = [merged]


def test_merger_against_one_merge_at_a_time():
    import numpy as np

    rng = random.Random(5)
    for _ in range(100):
        names, known, merges, used = {66 + i: "abcd"[i] for i in range(4)}, {}, [], set()
        known = {v: k for k, v in names.items()}
        while len(merges) < 12:
            a, b = rng.choice(list(names)), rng.choice(list(names))
            if (a, b) in used or len(names[a] + names[b]) > 6:
                continue
            used.add((a, b))
            merged = known.setdefault(names[a] + names[b], 253 + len(names))
            names[merged] = names[a] + names[b]
            merges.append((a, b, merged))
        pieces = [[66 + rng.randrange(4) for _ in range(rng.randrange(1, 15))] for _ in range(20)]
        merger = K._Merger(Vocabulary(tuple(merges)))
        flat, lengths = merger(np.array(sum(pieces, [])), np.array([len(p) for p in pieces]))
        ends = np.cumsum(lengths)
        got = [flat[e - n:e].tolist() for e, n in zip(ends, lengths)]
        assert got == [one_at_a_time(p, merges) for p in pieces]


def test_training_stops_when_no_pair_is_left(spark):
    rows = spark.createDataFrame([("aaaa ab",), ("abab",)], "text string")
    vocab = bpe.train_vocabulary(bpe.piece_counts(rows), 4096)
    theirs = library(["aaaa ab", "abab"], 4096).get_vocab()
    assert vocab.tokens() == sorted(theirs, key=theirs.get)


def test_vocabulary_tables(spark, trained, tmp_path):
    ours = trained[0]
    back = Vocabulary.from_tables(ours.vocab_table(spark), ours.merges_table(spark))
    assert back == ours
    grown = vocabulary.add_special_tokens(ours.vocab_table(spark))
    assert [r.token for r in grown.orderBy("id").collect()] == ours.with_chat_tokens().tokens()
    again = vocabulary.add_special_tokens(grown)
    assert again.count() == grown.count()
    assert vocabulary.assert_vocab_fits(grown).first()[0] == 703
    with pytest.raises(Exception, match="exceeds"):
        vocabulary.assert_vocab_fits(grown, 702).collect()
    with pytest.raises(Exception, match="missing"):
        vocabulary.token_ids(ours.vocab_table(spark), ["<|user|>"]).collect()
    with pytest.raises(ValueError, match="two bytes"):
        Vocabulary(tuple((1, 2, 257 + i) for i in range(65536)))


def test_a_vocabulary_of_full_size_is_the_librarys(spark):
    """4,096 tokens: far beyond what is looked up in a dense table."""
    import json

    public_tokenizers = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"][:4096 - 257]
    ids = {c: i + 1 for i, c in enumerate(sorted(K.byte_alphabet()))}
    table = []
    for a, b in merges:
        ids[a + b] = 257 + len(table)
        table.append((ids[a], ids[b], ids[a + b]))
    own = Vocabulary(tuple(table))
    assert own.size == 4096 > K.DENSE_VOCAB
    library = tokenizers.Tokenizer(tokenizers.models.BPE(vocab=ids, merges=[tuple(m) for m in merges]))
    library.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    rng = random.Random(11)
    parts = ["the", " story", "tion", "é", "\U0001f600", "  ", "\n", "'s", "12", "ingly", "aaaa", "==", " Theatre", "漢字"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.ids for r in rows.select("i", K.encode_ids("t", own).alias("ids")).collect()}
    assert [got[i] for i in range(400)] == [e.ids for e in library.encode_batch(texts)]


@pytest.mark.parametrize("proposed, top, sample", [(256, 20_000, 50_000), (16, 40, 30), (1, 1, 1), (64, 300, 0)])
def test_guesses_never_change_what_is_learned(spark, monkeypatch, proposed, top, sample):
    """However few counts and pieces the proposals rest on, down to none."""
    rng = random.Random(12)
    parts = ["aaaa", "aba", "abab", "bab", "story", "stories", "sto", "ry", "é", "éé", "caa"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) + " ",) for _ in range(400)]
    monkeypatch.setattr(bpe, "PROPOSED", proposed)
    monkeypatch.setattr(bpe, "TOP_PAIRS", top)
    monkeypatch.setattr(bpe, "SAMPLE_PIECES", sample)
    size = 257 + (8 if proposed == 1 else 60)
    theirs = library([r[0] for r in rows], size).get_vocab()
    counts = bpe.piece_counts(spark.createDataFrame(rows, "text string"))
    assert bpe.train_vocabulary(counts, size).tokens() == sorted(theirs, key=theirs.get)


def test_a_vocabulary_of_full_size_is_learned_in_few_rounds(spark):
    """4,096 tokens over a whole table, the same as the public library's, in many times fewer jobs than merges."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    theirs = library([r.text for r in documents.collect()], 4096).get_vocab()
    rounds = []
    ours = bpe.train_vocabulary(bpe.piece_counts(documents), 4096, rounds)
    assert ours.tokens() == sorted(theirs, key=theirs.get)
    assert sum(rounds) == len(ours.merges) >= 4096 - 257 and len(rounds) < 200


def test_runs_of_merges_against_one_merge_at_a_time(spark):
    """A whole run is made at once, and its changes of pair counts are those of making its merges in turn."""
    from collections import Counter

    import pyarrow as pa

    from textpack.constants import SYMBOL_BASE
    from textpack.operators.speculation import Chain, Step

    def once(piece, a, b, merged):
        out, i = [], 0
        while i < len(piece):
            hit = piece[i:i + 2] == [a, b]
            out.append(merged if hit else piece[i])
            i += 2 if hit else 1
        return out

    rng = random.Random(8)
    for trial in range(60):
        known, merges = list(range(1, 4)), []
        for _ in range(10):
            a, b = rng.choice(known), rng.choice(known)
            merged = rng.choice([x for x in known if x not in (a, b)]) if rng.random() < 0.15 else max(known) + 1
            merges.append((a, b, merged))
            known.append(merged)
        pieces = [[rng.randrange(1, 4) for _ in range(rng.randrange(2, 16))] for _ in range(30)]
        counts = [rng.randrange(1, 9) for _ in pieces]
        batch = pa.RecordBatch.from_pydict({"symbols": ["".join(chr(SYMBOL_BASE + x) for x in p) for p in pieces], "n": counts})
        expected, after = Counter(), pieces
        for k, merge in enumerate(merges):
            made = [once(p, *merge) for p in after]
            for old, new, n in zip(after, made, counts):
                expected.update({(k, *x): n * m for x, m in Counter(zip(new, new[1:])).items()})
                expected.subtract({(k, *x): n * m for x, m in Counter(zip(old, old[1:])).items()})
            after = made
        runs = bpe.in_runs(merges)
        assert sum(runs, []) == merges
        held, chain = bpe._Pieces(batch), Chain(np.array(sum(pieces, [])), np.array([len(p) for p in pieces]))
        for run in runs:
            held.merge(bpe._Run(run))
        assert held.texts().to_pylist() == ["".join(chr(SYMBOL_BASE + x) for x in p) for p in after]
        for merge in merges:
            chain.merge(np.arange(len(chain.symbols) - 1), *merge)
        assert [s for s in chain.symbols.tolist() if s >= 0] == sum(after, [])
        if trial < 3:
            state = spark.createDataFrame(list(zip(batch.column(0).to_pylist(), counts)), "symbols string, n long")
            found = bpe.count_changes(state, [], [Step(*m, True) for m in merges]).collect()
            got = {(r.step, *divmod(r.pair, 65536)): r.change for r in found}
            assert got == {key: by for key, by in expected.items() if by}


def test_rounds_hold_for_long(spark):
    """A round accepts some 50 merges of the full vocabulary on average."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    rounds = []
    bpe.train_vocabulary(bpe.piece_counts(documents), 4096, rounds)
    assert len(rounds) < 76


def test_a_round_teaches_the_next_one(spark, monkeypatch):
    """What a round counted of merges that it didn't accept places them in the next: with few pieces to guess from, a
    round still accepts many."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    counts = bpe.piece_counts(documents).localCheckpoint()
    whole = bpe.train_vocabulary(counts, 1500)
    monkeypatch.setattr(bpe, "SAMPLE_PIECES", 2000)
    rounds = []
    assert bpe.train_vocabulary(counts, 1500, rounds) == whole
    assert len(rounds) <= 20


def test_changes_told_are_those_of_the_order_proposed():
    """``re on`` was counted before ``on en``, which now leads: ``re on en`` is lost to the first and won by the second."""
    from textpack.operators.speculation import Predictor, Step

    tokens = ["", "re", "on", "en"]
    none = np.zeros(0, dtype=np.int64)
    predictor = Predictor(none, none, none.astype(float))
    predictor.tell([Step(1, 2, 4, True), Step(2, 3, 5, True)],
                   [(Step(1, 2, 4, True), {(1, 2): -100, (2, 3): -30, (4, 3): 30}), (Step(2, 3, 5, True), {(2, 3): -80})], tokens)
    written = {t: i for i, t in enumerate(tokens)}
    steps = predictor.propose({(1, 2): 100, (2, 3): 110}, 0, tokens, written, 4)
    # Without the correction reon en would come next with 30, which no text holds any more.
    assert [(s.a, s.b) for s in steps] == [(2, 3), (1, 2), (1, 4)]


def test_few_counts_are_followed_for_long(spark, monkeypatch):
    """Counts that fell behind are dropped, and what is learned stays the same."""
    from textpack.operators import speculation

    rng = random.Random(13)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7))) for _ in range(150)]
    counts = bpe.piece_counts(spark.createDataFrame([(" ".join(rng.choices(words, k=400)),) for _ in range(5)], "text string"))
    whole = bpe.train_vocabulary(counts, 257 + 120)
    monkeypatch.setattr(speculation, "FOLLOWED", 30)
    assert bpe.train_vocabulary(counts, 257 + 120) == whole
    replay = speculation.Replay({(a, b): a * 20 + b for a in range(1, 20) for b in range(1, 20)}, 3)
    import pyarrow as pa
    none = pa.table({"step": pa.array([], pa.int32()), "pair": pa.array([], pa.int64()), "change": pa.array([], pa.int64())})
    replay.accept([], none, [], {})
    assert len(replay.counts) == 30 and replay.floor == min(replay.counts.values()) - 1


def test_steps_are_taken_in_another_order_than_proposed():
    """Merges that can't meet in a text go before each other in one round, also beside each other's tokens."""
    import pyarrow as pa

    from textpack.constants import SYMBOL_BASE
    from textpack.operators.speculation import Replay, Step

    def counted(pieces, weights, steps):
        held = bpe._Pieces(pa.RecordBatch.from_pydict(
            {"symbols": ["".join(chr(SYMBOL_BASE + x) for x in p) for p in pieces], "n": weights}))
        changes = []
        held.merge(bpe._Run([(s.a, s.b, s.merged) for s in steps]), changes)
        key, by = bpe._summed(changes)
        return pa.table({"step": key // 65536 ** 2, "pair": key % 65536 ** 2, "change": by})

    rng = random.Random(5)
    taken = 0
    for _ in range(200):
        pieces = [[rng.randrange(1, 8) for _ in range(rng.randrange(2, 12))] for _ in range(30)]
        weights = [rng.randrange(1, 9) for _ in pieces]
        counts = {}
        for p, n in zip(pieces, weights):
            for pair in zip(p, p[1:]):
                counts[pair] = counts.get(pair, 0) + n
        # The most frequent pairs, in any order; in the end each is proposed as if the others weren't there.
        pairs = sorted(counts, key=lambda x: (-counts[x], x))[:4]
        rng.shuffle(pairs)
        steps = [Step(a, b, 8 + i, True) for i, (a, b) in enumerate(pairs)]
        tokens = [chr(97 + i) for i in range(8)]
        replay = Replay(dict(counts), 0)
        accepted, complete = replay.accept(steps, counted(pieces, weights, steps), tokens, {})
        assert complete
        taken += len(accepted)
        for a, b, merged in accepted:  # one at a time, each the most frequent of its time
            assert (a, b) == min(counts, key=lambda x: (-counts[x], x))
            after = []
            for p in pieces:
                out, i = [], 0
                while i < len(p):
                    hit = p[i:i + 2] == [a, b]
                    out.append(merged if hit else p[i])
                    i += 2 if hit else 1
                after.append(out)
            pieces, counts = after, {}
            for p, n in zip(pieces, weights):
                for pair in zip(p, p[1:]):
                    counts[pair] = counts.get(pair, 0) + n
        assert {k: n for k, n in replay.counts.items() if n} == counts
    assert taken > 230


def test_sampled_pieces_stand_for_all(spark):
    """Pieces taken by chance weigh as much as all; where all are taken, each weighs its count."""
    state = spark.range(4000).selectExpr("concat('p', id) AS symbols", "1 + id % 7 + IF(id % 500 = 0, 5000, 0) AS n")
    total = state.agg(F.sum("n")).first()[0]
    symbols, weights = bpe.sampled_pieces(state, 1000)
    assert len(symbols) == 1000 and abs(weights.sum() / total - 1) < 0.05
    symbols, weights = bpe.sampled_pieces(state, 5000)
    assert len(symbols) == 4000 and weights.sum() == total
    assert len(bpe.sampled_pieces(state, 0)[0]) == 0


@pytest.mark.parametrize("merges", [(), ((66, 67, 257), (257, 68, 258))])
def test_memory_does_not_grow_with_the_batch(merges):
    """A batch of 26 MB takes little more than its ids; its slices give what single rows give."""
    import tracemalloc

    import pyarrow as pa

    vocabulary = Vocabulary(merges)
    encode = (K._piece_encoder if merges else K._byte_encoder)(vocabulary)
    rng = random.Random(9)
    rows = [[rng.choice(["abc", " cab", "<|endoftext|>", "é", " ab"]) * rng.randrange(1, 9) for _ in range(n)]
            for n in (*[400] * 100, 0, 1, 300_000, 0)]
    batch = pa.array(rows, pa.list_(pa.string())).slice(3)
    big = pa.concat_arrays([batch.slice(0, 97)] * 50)
    for work, given in ((encode, big), (K._decoder(vocabulary, False), encode(big))):
        tracemalloc.start()
        made = work(given)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < made.nbytes + 100 * K.SLICE
    ids = encode(batch)
    assert ids.to_pylist() == [encode(batch.slice(i, 1)).to_pylist()[0] for i in range(len(batch))]
    assert K._decoder(vocabulary, False)(ids).to_pylist() == ["".join(r).encode() for r in rows[3:]]


@pytest.mark.parametrize("merges", [(), ((66, 67, 257), (257, 68, 258))])
def test_results_of_a_batch_are_handed_on_in_slices(merges):
    """The Arrow functions never hold the ids or bytes of a whole batch."""
    import pyarrow as pa

    vocabulary = Vocabulary(merges)
    encode = (K._piece_encoder if merges else K._byte_encoder)(vocabulary)
    batch = pa.array([["abc", " cab", "<|endoftext|>"] * n for n in (*[4000] * 90, 0, 1, 200_000, 0)], pa.list_(pa.string()))
    for work, given in ((encode, batch), (K._decoder(vocabulary, False), encode(batch))):
        parts = list(K._streamed(work)(iter([given, given.slice(90), given.slice(0, 0)])))
        assert len(parts) > 4 and all(len(p) == 1 or p.nbytes < 8 * K.SLICE for p in parts)
        assert pa.concat_arrays(parts).equals(pa.concat_arrays([work(given), work(given.slice(90))]))
