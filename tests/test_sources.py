"""From a source to pairs, and the report of the job that writes them."""

import pytest
from pyspark.sql import functions as F

from textpack.operators import clean, report
from textpack.plans.sources import MAX_PAIRS, Source, source_pairs
from textpack.sources import io

BLOCKS = "Summary: a {n}\nnoise\nStory: once {n}\n  more  text\n<|endoftext|>\n"


@pytest.fixture
def folders(spark, tmp_path):
    (tmp_path / "files").mkdir()
    for name in "ab":
        (tmp_path / "files" / f"{name}.txt").write_text("".join(BLOCKS.format(n=f"{name}{i}") for i in range(5)) + "Words: open\n")
    rows = [(3, " third \n story "), (1, None), (2, "  "), (0, "zero")]
    spark.createDataFrame(rows, "id long, body string").write.parquet(f"{tmp_path}/stories")
    return (Source(f"{tmp_path}/missing", "instructions", "text"), Source(f"{tmp_path}/files", "instructions", "text"),
            Source(f"{tmp_path}/stories", key="id", text="body"))


def test_the_first_source_that_opens_is_parsed(spark, folders):
    missing, files, stories = folders
    got = source_pairs(spark, [missing, files, stories]).select("user", "assistant", "source").collect()
    assert sorted((r.user, r.assistant) for r in got) == sorted(
        (f"Summary: a {n}{i}", f"once {n}{i} more text") for n in "ab" for i in range(5))
    assert {r.source for r in got} == {files.path}


def test_stories_get_the_default_turn(spark, folders, tmp_path):
    missing, _, stories = folders
    got = source_pairs(spark, [missing, stories], out=f"{tmp_path}/out").collect()
    assert sorted((r.id, r.user, r.assistant) for r in got) == [
        (0, "Write a short story for me.", "zero"), (3, "Write a short story for me.", "third story")]


@pytest.mark.parametrize("n", [1, 3, 10, MAX_PAIRS])
def test_the_cap_takes_the_first_pairs(spark, folders, n):
    _, files, stories = folders
    got = source_pairs(spark, [files], n).orderBy("src", "end_line").collect()
    assert [r.user for r in got] == [f"Summary: a {name}{i}" for name in "ab" for i in range(5)][:n]
    assert source_pairs(spark, [stories], n).count() == min(n, 2)


def test_sources_without_pairs_are_errors(spark, folders, tmp_path):
    with pytest.raises(FileNotFoundError):
        source_pairs(spark, folders[:1])
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/empty")
    empty = [Source(f"{tmp_path}/empty")]
    assert source_pairs(spark, empty).count() == 0
    with pytest.raises(ValueError, match="no usable"):
        source_pairs(spark, empty, out=f"{tmp_path}/none")


def labelled(spark):
    rows = [("the dog said", "it was in the house and she had a day " * n) for n in (1, 2, 3, 60)] + [
        ("", "x"), ("a", None), ("нет", "не по-английски")]
    return clean.with_drop_reason(spark.createDataFrame(rows, io.PAIR_SCHEMA))


def test_the_write_reports_what_it_dropped(spark, tmp_path):
    rows = labelled(spark)
    found = io.write_formatted_reporting(rows, f"{tmp_path}/lines")
    assert {k: found[k] for k in ("kept", "skipped", "empty", "non_english", "too_long")} == report.filter_report(rows).first().asDict()
    assert found["avg_tokens"] == report.avg_tokens(rows.where("drop_reason = 'kept'")).first()[0]
    assert spark.read.text(f"{tmp_path}/lines").count() == found["kept"] == 3
    none = io.write_formatted_reporting(rows.where(F.lit(False)), f"{tmp_path}/none")
    assert none["kept"] == 0 and none["avg_tokens"] == 0.0


def test_the_report_needs_no_second_scan(spark, tmp_path):
    spark.createDataFrame([("the dog said", "it was in the house")], io.PAIR_SCHEMA).write.parquet(f"{tmp_path}/pairs")
    rows, _ = report.observed(clean.with_drop_reason(spark.read.parquet(f"{tmp_path}/pairs")), "one")
    plan = rows.where("drop_reason = 'kept'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics one" in plan


def test_a_stream_reports_with_every_batch(spark, tmp_path):
    spark.createDataFrame([("the dog said", "it was in the house"), ("", "x")], io.PAIR_SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = clean.with_drop_reason(spark.readStream.schema(io.PAIR_SCHEMA).parquet(f"{tmp_path}/in"))
    rows, _ = report.observed(stream, "formatted")
    query = rows.where("drop_reason = 'kept'").select("line").writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    counts = next(p.observedMetrics["formatted"] for p in query.recentProgress if p.numInputRows)
    assert (counts.kept, counts.empty) == (1, 1) or (counts.skipped, counts.empty) == (1, 1)
