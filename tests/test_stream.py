import os
import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from tests.test_blocks import FILES
from tests.test_blocks import SCHEMA as LINES
from tests.test_context import CHAT, CONVERSATIONS, SCHEMA
from textpack.operators import clean, context
from textpack.streaming import jobs


def staged(spark, path, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/s={i}")
    return jobs.read_table_stream(spark, f"{path}/s=*", spark.createDataFrame([], schema).schema)


def cut(rows, places):
    """Rows in steps: those before each place of their key come first."""
    bounds = [0, *places, 10**9]
    return [[r for r in rows if lo <= r[1] < hi] for lo, hi in zip(bounds, bounds[1:])]


def test_format(spark, tmp_path):
    schema = "pair_id long, user string, assistant string"
    rows = [(i, "the dog", "and a cat " * (i * 9)) for i in range(12)]
    stream = staged(spark, f"{tmp_path}/in", [rows[:5], rows[5:]], schema)
    jobs.stream_format(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    batch = clean.format_pairs(spark.createDataFrame(rows, schema))
    got = spark.read.parquet(f"{tmp_path}/out").select(*batch.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


@pytest.mark.parametrize("job", [jobs.stream_parse_blocks, partial(jobs.stream_parse_blocks_chunked, width=16)])
@pytest.mark.parametrize("places", [[1, 2, 3], [2], [4, 6]])
def test_parse_blocks(spark, tmp_path, places, job):
    """Files that arrive in parts give what they give as a whole."""
    rows = [(name, i, line) for name, (lines, _) in FILES.items() for i, line in enumerate(lines)]
    stream = staged(spark, f"{tmp_path}/in", cut(rows, places), LINES)
    job(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/batch=*").collect()
    assert sorted((r.src, r.end_line, r.user, r.assistant) for r in got) == sorted(
        (name, *pair) for name, (_, pairs) in FILES.items() for pair in pairs)


@pytest.mark.parametrize("job", [jobs.stream_chat_context, partial(jobs.stream_chat_context_chunked, width=8)])
def test_chat_context(spark, tmp_path, job):
    rows = [(c, *turn) for c, (turns, _) in CONVERSATIONS.items() for turn in turns]
    stream = staged(spark, f"{tmp_path}/in", cut(rows, [2, 3, 5]), SCHEMA)
    job(stream, CHAT, f"{tmp_path}/out", f"{tmp_path}/cp", 18).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/batch=*").collect()
    assert {(r.conv_id, r.turn): r.n_pairs for r in got} == {
        (c, turn): n for c, (_, prompts) in CONVERSATIONS.items() for turn, n, _ in prompts}
    whole = context.chat_context(spark.createDataFrame(rows, SCHEMA), CHAT, 18).collect()
    assert {(r.conv_id, r.turn): r.ids for r in got} == {(r.conv_id, r.turn): r.ids for r in whole}


def test_a_batch_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    steps = [[(f"s{i}", 0, "Words: x") for i in range(40)], [("s3", 1, "Story: y"), ("s3", 2, "<|endoftext|>")]]
    stream = staged(spark, f"{tmp_path}/in", steps, LINES)
    jobs.stream_parse_blocks_chunked(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    buckets = [{d for d in os.listdir(f"{tmp_path}/cp/carry/batch={n}") if d.startswith("bucket=")} for n in (0, 1)]
    own = spark.range(1).select(F.pmod(F.xxhash64(F.lit("s3")), F.lit(jobs.CARRY_BUCKETS))).first()[0]
    assert len(buckets[0]) > 20 and buckets[1] == {f"bucket={own}"}
    index = {r.bucket: r.batch for r in spark.read.parquet(f"{tmp_path}/cp/index/batch=1").collect()}
    assert index[own] == 1 and set(index.values()) == {0, 1} and len(index) == len(buckets[0])
    # What an untouched bucket holds isn't read: the next batch would fail on it.
    assert [r.user for r in spark.read.parquet(f"{tmp_path}/out/batch=1").collect()] == ["Words: x"]


def test_idle_keys_are_not_written_again(spark, tmp_path):
    """A second micro-batch of one source updates the state of that source alone."""
    steps = [[(f"s{i}", 0, "Words: x") for i in range(40)], [("s3", 1, "Story: y"), ("s3", 2, "<|endoftext|>")]]
    stream = staged(spark, f"{tmp_path}/in", steps, LINES)
    query = jobs.stream_parse_blocks(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
    assert [s.numRowsUpdated for s in states] == [40, 1] and [s.numRowsTotal for s in states] == [40, 40]
    assert [tuple(r)[:4] for r in spark.read.parquet(f"{tmp_path}/out/batch=1").collect()] == [("s3", 2, "Words: x", "y")]


def until(true):
    for _ in range(300):
        if true():
            return True
        time.sleep(0.2)
    return False


def test_sources_are_retired(spark, tmp_path):
    """After its idle time the open block of a source is gone, and what comes then starts anew."""
    def part(rows, step):
        spark.createDataFrame(rows, LINES).coalesce(1).write.parquet(f"{tmp_path}/in/s={step}")

    def states():
        last = query.lastProgress
        return last.stateOperators[0].numRowsTotal if last and last.stateOperators else None

    part([("a", 0, "Words: x"), ("a", 1, "Story: y")], 0)
    stream = jobs.read_table_stream(spark, f"{tmp_path}/in/s=*", spark.createDataFrame([], LINES).schema)
    query = jobs.stream_parse_blocks(stream, f"{tmp_path}/out", f"{tmp_path}/cp", 1000, {"processingTime": "200 milliseconds"})
    try:
        assert until(lambda: any(p.numInputRows == 2 for p in query.recentProgress)) and until(lambda: states() == 0)
        part([("a", 2, "more"), ("a", 3, "<|endoftext|>")], 1)
        assert until(lambda: sum(p.numInputRows for p in query.recentProgress) == 4)
    finally:
        query.stop()
    assert spark.read.parquet(f"{tmp_path}/out/batch=*").count() == 0


def test_hot_keys_are_named(spark):
    rows = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2, "src string")
    assert jobs.hot_keys(rows, "src", 3) == ["a"] and jobs.hot_keys(rows, "src") == []


@pytest.mark.parametrize("job", [jobs.stream_parse_blocks, jobs.stream_parse_blocks_chunked])
def test_late_lines_are_an_error(spark, tmp_path, job):
    stream = staged(spark, f"{tmp_path}/in", [[("a", 5, "x")], [("a", 4, "y")]],
                    "src string, line_no long, line string")
    with pytest.raises(Exception, match="out of line_no order"):
        job(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
