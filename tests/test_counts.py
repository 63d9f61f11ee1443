import math

import pytest

from textpack.operators import counts, report


@pytest.fixture(scope="module")
def grams(spark):
    return spark.createDataFrame(
        [(1, 1, 5), (1, 2, 3), (1, 3, 3), (1, 4, 1), (2, 9, 2), (2, 8, 2)], "x int, y int, n long")


def dist(df):
    return {(r.x, r.y): r.p for r in df.collect()}


def test_bigrams(spark):
    rows = spark.createDataFrame([([1, 1, 2], [1, 2, 3]), ([1], [2])], "x array<int>, y array<int>")
    assert sorted(map(tuple, counts.bigram_counts(rows).collect())) == [
        (1, 1, 1), (1, 2, 2), (2, 3, 1)]


def test_top_k_keeps_ties(grams):
    got = counts.next_token_dist(grams, temperature=1.0, top_k=2, vocab_size=10)
    assert {k: round(v, 9) for k, v in dist(got).items()} == {
        (1, 1): round(5 / 11, 9), (1, 2): round(3 / 11, 9), (1, 3): round(3 / 11, 9),
        (2, 9): 0.5, (2, 8): 0.5}


@pytest.mark.parametrize("k", [0, 10, 50])
def test_top_k_off(grams, k):
    got = dist(counts.next_token_dist(grams, 0.5, k, vocab_size=10))
    assert math.isclose(got[1, 4], 1 / (25 + 9 + 9 + 1)) and len(got) == 6


def test_greedy(grams):
    assert dist(counts.next_token_dist(grams, 0.0)) == {(1, 1): 1.0, (2, 8): 1.0}


def test_heldout_loss(spark, grams):
    val = spark.createDataFrame([([1, 2, 7], [2, 9, 1])], "x array<int>, y array<int>")
    got = counts.heldout_loss(grams, val, 10).first()
    want = -(math.log(4 / 22) + math.log(3 / 14) + math.log(1 / 10)) / 3
    assert math.isclose(got.loss, want) and got.n_tokens == 3
    assert math.isnan(counts.heldout_loss(grams, val.where("false"), 10).first().loss)


def test_resize_embeddings(spark):
    old = spark.createDataFrame([(i, [float(i)] * 64) for i in range(5)],
                                "id long, embedding array<float>")
    grown = counts.resize_embeddings(old, 400, 64)
    first = {r.id: r.embedding for r in grown.collect()}
    assert sorted(first) == list(range(400))
    assert all(first[i] == [float(i)] * 64 for i in range(5))
    assert first == {r.id: r.embedding for r in grown.repartition(3).collect()}
    drawn = [v for i, e in first.items() if i >= 5 for v in e]
    mean = sum(drawn) / len(drawn)
    std = math.sqrt(sum((v - mean) ** 2 for v in drawn) / len(drawn))
    assert abs(mean) < 0.001 and abs(std - 0.02) < 0.001
    assert sorted(r.id for r in counts.resize_embeddings(old, 3, 64).collect()) == [0, 1, 2]


def test_sequence_counts(spark):
    rows = spark.createDataFrame(
        [("train", 1000), ("train", 281), ("val", 10), ("tiny", 1)], "split string, n_tokens long")
    got = {r.split: (r.tokens, r.sequences, r.batches, r.steps)
           for r in report.n_sequences(rows, 2, 2, 3, 10).collect()}
    assert got == {"train": (1281, 128, 64, 96), "val": (10, 0, 0, 0), "tiny": (1, 0, 0, 0)}
    totals = {r.split: (r.conversations, r.tokens) for r in report.split_totals(rows).collect()}
    assert totals["total"] == (4, 1292) and totals["train"] == (2, 1281)


def test_counts_and_manifest(spark, grams):
    assert report.corpus_count(grams).first().n == 6
    with pytest.raises(Exception, match="no usable"):
        report.corpus_count(grams.where("false")).collect()
    rows = spark.createDataFrame([(3,), (4,)], "n_tokens int")
    got = report.dataset_manifest({"a": rows, "b": grams}, 260).collect()
    assert sorted(map(tuple, got)) == [
        ("a", "rows", 2), ("a", "tokens", 7), ("b", "rows", 6), ("vocabulary", "tokens", 260)]


@pytest.mark.parametrize("ids, sizes, fits", [
    (range(5), [2] * 5, True), (range(4), [2] * 4, False), (range(6), [2] * 6, False), ([0, 1, 2, 3, 3], [2] * 5, False),
    ([1, 2, 3, 4, 5], [2] * 5, False), (range(5), [2, 2, 3, 2, 2], False), ([], [], False)])
def test_embeddings_must_fit_the_vocabulary(spark, ids, sizes, fits):
    table = spark.createDataFrame([(i, [0.5] * n) for i, n in zip(ids, sizes)], "id long, embedding array<float>")
    vocab = spark.createDataFrame([(i, str(i), False) for i in range(5)], "id int, token string, special boolean")
    found = counts.check_embeddings(table, vocab)
    if fits:
        assert tuple(found.first()) == (5, 5, 2)
    else:
        with pytest.raises(Exception, match="embedding table"):
            found.collect()
