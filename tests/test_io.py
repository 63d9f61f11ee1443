import json

import pytest
from pyspark.sql import functions as F

from textpack.operators.blocks import parse_blocks
from textpack.operators.vocabulary import Vocabulary
from textpack.sources import io

PAIRS = [("é \"q\"", "\U0001f600\n"), ("a", "b")]


def test_pairs_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(PAIRS, io.PAIR_SCHEMA)
    io.write_pairs(df, f"{tmp_path}/p")
    assert sorted(map(tuple, io.read_pairs(spark, f"{tmp_path}/p").collect())) == sorted(PAIRS)
    raw = "".join(f.read_text() for f in (tmp_path / "p").glob("part-*"))
    assert "\U0001f600" in raw
    whole = tmp_path / "array.json"
    whole.write_text(json.dumps([{"user": u, "assistant": a} for u, a in PAIRS]))
    got = io.read_pairs(spark, str(whole), array_file=True)
    assert sorted(map(tuple, got.collect())) == sorted(PAIRS)


def test_formatted_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("",), ("ü y",)], "line string")
    io.write_formatted(df, f"{tmp_path}/f")
    assert sorted(r.line for r in io.read_formatted(spark, f"{tmp_path}/f").collect()) == ["x", "ü y"]
    io.write_formatted(df.where("line = ''"), f"{tmp_path}/g")
    with pytest.raises(ValueError, match="no conversations"):
        io.read_formatted(spark, f"{tmp_path}/g")


def test_first_readable(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b")
    found = io.first_readable(spark, [f"{tmp_path}/a", f"{tmp_path}/b", f"{tmp_path}/c"])
    assert {r.source for r in found.collect()} == {f"{tmp_path}/b"}
    with pytest.raises(FileNotFoundError):
        io.first_readable(spark, [f"{tmp_path}/a"])


def test_text_lines_keep_their_order_across_splits(spark, tmp_path):
    files = {f"{i}.txt": [f"{i}-{j}" for j in range(400)] for i in range(3)}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = io.read_text_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, lines in files.items():
        mine = sorted((r.line_no, r.line) for r in rows if r.src.endswith(name))
        assert [line for _, line in mine] == lines
        assert len({n for n, _ in mine}) == len(mine)


def test_parse_a_text_file(spark, tmp_path):
    block = "Features: Dialogue\nSummary: s\nStory:\nOnce\n\nupon\n<|endoftext|>\n"
    (tmp_path / "a.txt").write_text(block * 5 + "Summary: open\nStory: x\n")
    got = parse_blocks(io.read_text_lines(spark, str(tmp_path))).collect()
    assert [(r.user, r.assistant) for r in got] == [("Features: Dialogue Summary: s", "Once upon")] * 5


def test_packed_cache(spark, tmp_path):
    calls = []

    def build(n):
        def made():
            calls.append(n)
            return spark.createDataFrame([("train", 0, [n]), ("val", 0, [n + 1])],
                                         "split string, block_id long, tokens array<int>")
        return made

    def load(n, split, force=False, **parameters):
        vocabulary = parameters.pop("vocabulary", Vocabulary())
        rows = io.load_or_build(spark, str(tmp_path), split, build(n), vocabulary, force, **parameters)
        return [r.tokens[0] for r in rows.collect()]

    assert load(1, "train", c=16) == [1]
    assert load(2, "validation", c=16) == [2] and calls == [1]
    assert load(5, "train", c=32) == [5] and calls == [1, 5]
    assert load(7, "train", force=True, c=16) == [7]
    def key(**parameters):
        return io.fingerprint(merges=(), specials=Vocabulary().specials, **parameters)

    io.write_packed(build(9)(), f"{tmp_path}/chat_{key(c=64)}")
    assert load(3, "train", c=64, force=True) == [3]
    io.write_packed(build(9)(), f"{tmp_path}/chat_{key(c=65)}")
    spark.range(1).write.parquet(f"{tmp_path}/chat_{key(c=65)}.done")
    assert load(0, "validation", c=65) == [10]
    # A table without its mark is one whose write may have died.
    io.write_packed(build(9)(), f"{tmp_path}/{key(c=66)}")
    assert load(4, "train", c=66) == [4]
    # Two vocabularies of one size.
    merged = [Vocabulary(((a, a + 1, 257),)) for a in (5, 6)]
    assert load(20, "train", c=16, vocabulary=merged[0]) == [20]
    assert load(30, "train", c=16, vocabulary=merged[1]) == [30]
    assert load(0, "train", c=16, vocabulary=merged[0]) == [20]
    plan = io.read_packed(spark, f"{tmp_path}/{key(c=16)}", "val")
    assert "PartitionFilters: [isnotnull(split" in plan._jdf.queryExecution().executedPlan().toString()


def test_vocabulary_roundtrip(spark, tmp_path):
    vocab = Vocabulary(((40, 41, 257), (257, 42, 258))).with_chat_tokens()
    io.save_vocabulary(spark, vocab, str(tmp_path))
    assert io.load_vocabulary(spark, str(tmp_path)) == vocab
    io.check_same_vocabulary(vocab.size, 262)
    with pytest.raises(ValueError):
        io.check_same_vocabulary(vocab.size, 261)


def test_lines_of_rows(spark):
    df = spark.createDataFrame([(1, "a\n\nb"), (2, None)], "doc_id long, text string")
    got = io.lines_of_rows(df, "doc_id").orderBy("src", "line_no").select(
        "src", F.col("line_no").cast("long"), "line")
    assert [tuple(r) for r in got.collect()] == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (2, 0, "")]


def test_a_build_that_dies_leaves_the_last_one(spark, tmp_path):
    """Neither a forced build under way nor one that fails changes what readers of the last one see."""
    def blocks(value):
        return spark.createDataFrame([("train", 0, [value])], "split string, block_id long, tokens array<int>")

    def load(build, force=False):
        return io.load_or_build(spark, f"{tmp_path}", "train", build, Vocabulary(), force)

    held = load(lambda: blocks(1))

    def dying():
        return blocks(2).withColumn("tokens", F.expr("IF(block_id = 0, raise_error('killed'), tokens)"))

    with pytest.raises(Exception, match="killed"):
        load(dying, force=True)
    assert [r.tokens for r in load(dying).collect()] == [[1]]
    assert [r.tokens for r in load(lambda: blocks(3), force=True).collect()] == [[3]]
    assert [r.tokens for r in held.collect()] == [[1]] and [r.tokens for r in load(dying).collect()] == [[3]]


def test_an_array_file_is_read_by_many_tasks(spark, tmp_path):
    """One JSON array without line breaks, with braces, quotes and escapes in its strings, cut anywhere."""
    import random
    draw = random.Random(3)
    parts = ["{", "}", '"', "\\", "},{", '"},{"user":"', "é", "\n", "[", "]", ",", "word ", "\\\"", "\U0001f600", "}}}", " "]
    rows = [{"conv_id": i, "user": "".join(draw.choice(parts) for _ in range(draw.randrange(30))),
             "assistant": "".join(draw.choice(parts) for _ in range(draw.randrange(60)))} for i in range(3000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(rows[:2000], ensure_ascii=False))
    (tmp_path / "in" / "b.json").write_text(json.dumps(rows[2000:], indent=1))
    (tmp_path / "in" / "c.json").write_text("[]")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert io.read_text_lines(spark, f"{tmp_path}/in", "}").rdd.getNumPartitions() > 10
        got = io.read_pairs(spark, f"{tmp_path}/in", "conv_id long", array_file=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert sorted(map(tuple, got)) == [tuple(r.values()) for r in rows]
    plain = io.read_pairs(spark, f"{tmp_path}/in/c.json", "conv_id long", array_file=True)
    assert plain.count() == 0
