import random

import pytest
from pyspark.sql import functions as F

from textpack.functions.tokens import byte_ids
from textpack.operators import ordering, pack
from textpack.operators.vocabulary import Vocabulary
from textpack.plans.chat import encode_chat, pack_chat
from textpack.plans.corpus import pack_corpus, place_corpus


def place(spark, lengths):
    rng = random.Random(len(lengths))
    ids = [[rng.randrange(1000) for _ in range(n)] for n in lengths]
    df = spark.createDataFrame(list(enumerate(ids)), "k long, ids array<int>").withColumn(
        "n_tokens", F.size("ids"))
    return sum(ids, []), pack.place_in_stream(df, F.col("k"), ordering.chunk_buckets("k", 2) + [F.lit(0)])


@pytest.mark.parametrize("c", [1, 4, 7])
@pytest.mark.parametrize("lengths", [
    [], [0], [1], [4], [5], [9], [0, 0, 8, 1], [1] * 30, [29, 1, 1, 2], [8, 8, 8], [4, 0, 4, 25]])
def test_pack_blocks(spark, c, lengths):
    stream, placed = place(spark, lengths)
    got = {r.block_id: r.tokens for r in pack.pack_blocks(placed, c).collect()}
    n = max(0, (len(stream) - 1) // c)
    assert got == {i: stream[i * c:i * c + c + 1] for i in range(n)}


def test_xy_shift(spark):
    _, placed = place(spark, [20])
    for r in pack.xy_shift(pack.pack_blocks(placed, 5), 5).collect():
        assert len(r.x) == len(r.y) == 5 and r.x[1:] == r.y[:-1]


@pytest.mark.parametrize("n,batch,accum", [(3, 4, 1), (17, 4, 1), (17, 4, 3), (9, 4, 5), (24, 4, 2),
                                           (0, 4, 1)])
def test_batch_plan(spark, n, batch, accum):
    blocks = spark.range(n).withColumnRenamed("id", "block_id")
    rows = pack.batch_plan(blocks, batch, epochs=2, accum=accum).collect()
    full = n // batch
    used = min(full, max(1, full // accum) * accum)
    for epoch in (1, 2):
        mine = [r for r in rows if r.epoch == epoch]
        assert len(mine) == used * batch == len({r.block_id for r in mine})
        assert sorted(r.position for r in mine) == list(range(used * batch))
        assert all(r.batch == r.position // batch and r.step == r.batch // accum for r in mine)
    orders = [[r.block_id for r in sorted(rows, key=lambda r: r.position) if r.epoch == e]
              for e in (1, 2)]
    assert n < 9 or orders[0] != orders[1]


def test_blocks_are_counted_from_lengths(spark):
    for lengths, n in (([], 0), ([1], 0), ([4, 5], 2), ([9], 2), ([0, 8], 1)):
        df = spark.createDataFrame([(x,) for x in lengths], "n_tokens long")
        assert pack.block_count(df, 4) == n
    assert [r.block_id for r in pack.numbered_blocks(spark, 3, 3).collect()] == [0, 1, 2]
    with pytest.raises(ValueError, match="too few"):
        pack.numbered_blocks(spark, 3, 4)


def test_each_text_is_encoded_once(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    plan = pack_corpus(rows, "doc_id", Vocabulary(), 8)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "pythonUDF" not in plan  # ids come from the written table


@pytest.mark.parametrize("n,batch,most", [(0, 4, 5), (3, 4, 5), (10, 4, 5), (100, 4, 5)])
def test_eval_plan(spark, n, batch, most):
    blocks = spark.range(n).withColumnRenamed("id", "block_id")
    got = sorted((r.block_id, r.batch) for r in pack.eval_plan(blocks, batch, most).collect())
    size = max(1, min(batch, n))
    assert got == [(i, i // size) for i in range(min(n // size, most) * size)]


def test_corpus_to_blocks(spark):
    texts = ["  one ", "", None, "two é", "\n", "three" * 9]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = byte_ids()
    stream = []
    for t in texts:
        if (t or "").strip():
            stream += [base[b] for b in t.strip().encode()] + [0]
    got = {r.block_id: r.tokens
           for r in pack_corpus(rows, "doc_id", Vocabulary(), 8).collect()}
    assert got == {i: stream[i * 8:i * 8 + 9] for i in range((len(stream) - 1) // 8)}


def test_chat_to_blocks_holds_every_token(spark):
    rows = [(i, f"tell the story {i}", "and a dog " * (i % 7 + 1)) for i in range(60)]
    pairs = spark.createDataFrame(rows, "pair_id long, user string, assistant string")
    encoded = encode_chat(pairs, Vocabulary().with_chat_tokens(), 60)
    kept = encoded.collect()
    assert 0 < len(kept) < 60 and max(r.n_tokens for r in kept) <= 60
    blocks = pack_chat(encoded, ["pair_id"], 16).collect()
    order = sorted(kept, key=lambda r: ordering_key(r.pair_id))
    n_val = round(len(kept) * 0.05)
    for split, part in (("val", order[:n_val]), ("train", order[n_val:])):
        stream = sum((r.ids for r in part), [])
        assert {r.block_id: r.tokens for r in blocks if r.split == split} == {
            i: stream[i * 16:i * 16 + 17] for i in range(max(0, (len(stream) - 1) // 16))}


def ordering_key(i):
    import hashlib

    return hashlib.md5(f"42:{i}".encode()).hexdigest()


def narrow_exchanges(df):
    """Exchanges of the plan and whether ids pass through any but the last."""
    spark = df.sparkSession
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = df._jdf.sparkSession().sessionState().executePlan(
            df._jdf.queryExecution().analyzed(), df._jdf.queryExecution().mode()).executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    return [line for line in plan.splitlines() if "Exchange" in line], plan


def test_ids_are_not_shuffled_to_meet_their_places(spark):
    rows = spark.createDataFrame([(i, "the story of a lamp " * (i % 7)) for i in range(200)], "doc_id long, text string")
    placed = place_corpus(rows, "doc_id", Vocabulary())
    exchanges, plan = narrow_exchanges(placed)
    ids_side = next(line for line in plan.splitlines() if "FileScan" in line and "ids" in line)
    assert len(exchanges) == 1 and "Bucketed: true" in ids_side
    pairs = spark.createDataFrame(
        [(i, 0, "the dog and a cat", "she said that it was in the house " * (i % 5 + 1)) for i in range(90)],
        "conv_id long, turn long, user string, assistant string")
    encoded = encode_chat(pairs, Vocabulary().with_chat_tokens(), 1000, ["conv_id", "turn"])
    exchanges, plan = narrow_exchanges(ordering.split_and_place(encoded, ["conv_id", "turn"]))
    assert "Bucketed: true" in plan and len([e for e in exchanges if "hashpartitioning(conv_id" in e]) == 1


@pytest.mark.parametrize("lengths", [[1], [4], [5], [9, 1, 30], [3, 3, 3, 0, 17, 4, 4, 8], [40]])
def test_whole_blocks_are_cut_in_place(spark, lengths):
    """Rows shorter than, as long as and many times longer than a block, starting anywhere."""
    stream, rows = [], []
    for i, n in enumerate(lengths):
        ids = list(range(1000 * i, 1000 * i + n))
        rows.append((ids, len(stream)))
        stream += ids
    got = pack.pack_blocks(spark.createDataFrame(rows, "ids array<int>, start long"), 4).collect()
    assert {r.block_id: r.tokens for r in got} == {
        i: stream[4 * i:4 * i + 5] for i in range(max(0, (len(stream) - 1) // 4))} and len(got) == max(0, (len(stream) - 1) // 4)


def test_only_shares_of_broken_blocks_are_exchanged(spark):
    rows = spark.createDataFrame([([1] * 4001, 0), ([2] * 3999, 4001)], "ids array<int>, start long")
    shared = pack.pack_blocks(rows, 4)
    assert shared.count() == 1999
    before_group = [line for line in shared._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Generate" in line]
    assert len(before_group) == 2  # whole blocks, and at most four shares a row


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 1000])
def test_every_epoch_is_a_permutation_of_its_own(spark, n):
    rows = spark.range(n).select("id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("epoch"))
    got = rows.select("id", "epoch", pack.permuted(F.col("id"), F.col("epoch"), n, 3).alias("p")).orderBy("id").collect()
    by_epoch = [[r.p for r in got if r.epoch == e] for e in (1, 2, 3)]
    assert all(sorted(p) == list(range(n)) for p in by_epoch)
    if n >= 97:
        assert by_epoch[0] != by_epoch[1] != by_epoch[2]
        # Neighbours land far apart: the mean distance of a random order is a third of n.
        far = [sum(abs(a - b) for a, b in zip(p, p[1:])) / n for p in by_epoch]
        assert all(0.25 * n < d < 0.42 * n for d in far)


@pytest.mark.parametrize("n, b, accum", [(7, 2, 1), (10, 3, 2), (5, 2, 9), (64, 4, 3)])
def test_a_permuted_plan_needs_no_shuffle(spark, n, b, accum):
    plan = pack.batch_plan_permuted(spark, n, b, 2, accum)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    sorted_plan = pack.batch_plan(spark.range(n).withColumnRenamed("id", "block_id"), b, 2, accum)
    shape = ["epoch", "position", "batch", "step"]  # all but which block it is
    assert sorted(map(tuple, plan.select(shape).collect())) == sorted(map(tuple, sorted_plan.select(shape).collect()))
    with pytest.raises(ValueError, match="too few"):
        pack.batch_plan_permuted(spark, 1, 2)
