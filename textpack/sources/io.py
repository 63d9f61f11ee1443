"""Readers and writers for every stage's table."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.constants import MAX_VOCAB_SIZE
from textpack.operators.ordering import CHUNK_WIDTH, chunk_buckets, running
from textpack.operators.report import observed, report_of
from textpack.operators.vocabulary import MERGES_SCHEMA, VOCAB_SCHEMA, Vocabulary
from textpack.session import materialize

PAIR_SCHEMA = "user string, assistant string"
MARK_SCHEMA = "place string, built long"
VALIDATION_ALIASES = {"validation": "val"}


def lines_of_rows(rows: DataFrame, src: str, text: str = "text") -> DataFrame:
    """One row per text line as (src, line_no, line); null text is one empty line."""
    return rows.select(
        F.col(src).alias("src"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line"))


def read_text_lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """Text files as (src, line_no, line), splitting large files over many tasks.

    ``line_no`` orders the lines of a file and is unique in it, but leaves gaps: it is the byte
    where the split starts plus the row's place in the scan task, and every line is at least a byte.
    Write the result before using it in more than one query with differing read settings.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return spark.read.text(path, lineSep=separator).select(
        F.col("_metadata.file_path").alias("src"),
        (F.col("_metadata.file_block_start") + place).alias("line_no"),
        F.col("value").alias("line"))


def first_readable(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """The first source that opens, with its name in ``source``; an error if none does.

    Only opening is tried; a source that fails while being read is not replaced.
    """
    for path in paths:
        try:
            return spark.read.format(fmt).load(path).withColumn("source", F.lit(path))
        except AnalysisException:
            continue
    raise FileNotFoundError(f"none of the sources could be opened: {paths}")


def write_pairs(pairs: DataFrame, path: str) -> None:
    """JSON Lines, one pair per line; text outside ASCII is written as it is."""
    pairs.write.mode("overwrite").json(path)


def read_pairs(spark: SparkSession, path: str, extra: str = "", array_file: bool = False
               ) -> DataFrame:
    """Pairs from JSON Lines, or with ``array_file`` from files that are one JSON array each."""
    schema = f"{extra}, {PAIR_SCHEMA}" if extra else PAIR_SCHEMA
    return read_json_array(spark, path, schema) if array_file else spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str, width: int = CHUNK_WIDTH) -> DataFrame:
    """Rows of files that hold one JSON array of objects without objects in them, however large a file is.

    A file is read in splits, cut at every closing brace. Whether a brace lies in a string follows from the number of
    quotes before it in the file, a running sum over the splits. Most objects are one such part; only parts that
    a brace within a string has cut are shuffled to be put together. An object that isn't valid, or breaks off, is a row of nulls.
    """
    parts = read_text_lines(spark, path, "}")
    # An escape is two characters; the one after a backslash is no quote. None spans a cut: \} is no escape.
    bare = F.regexp_replace("line", r"(?s)\\.", "")
    parts = materialize(parts.withColumn("quotes", (F.length(bare) - F.length(F.replace(bare, F.lit('"')))).cast("long")), "array-parts")
    placed = running(parts, "line_no", chunk_buckets("line_no", width), ["src"], sums={"before": F.col("quotes")})
    starts_inside = F.col("before") % 2 == 1
    ends_inside = (F.col("before") + F.col("quotes")) % 2 == 1
    whole = placed.where(~starts_inside & ~ends_inside & F.contains("line", F.lit("{"))).select("line")
    broken = placed.where(starts_inside | ends_inside).withColumn("inside", starts_inside).select("src", "line_no", "line", "inside")
    begun = running(broken, "line_no", chunk_buckets("line_no", width), ["src"],
                    maxes={"first": F.when(~F.col("inside"), F.col("line_no"))})
    own = F.when(F.col("inside"), F.col("first")).otherwise(F.col("line_no"))
    joined = begun.groupBy("src", own.alias("first")).agg(
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("parts")).select(
        F.array_join(F.transform("parts", lambda p: p["line"]), "}").alias("line"))
    spelled = F.concat(F.substring("line", F.instr("line", "{"), F.length("line")), F.lit("}"))
    return whole.unionByName(joined).select(F.from_json(spelled, schema).alias("o")).select("o.*")


def write_formatted(formatted: DataFrame, path: str) -> None:
    formatted.select("line").write.mode("overwrite").text(path)


def write_formatted_reporting(labelled: DataFrame, path: str) -> dict[str, int | float]:
    """Write the kept lines of labelled pairs; what was kept and dropped and why, counted in the same pass."""
    rows, counts = observed(labelled, "formatted")
    write_formatted(rows.where("drop_reason = 'kept'"), path)
    return report_of(counts.get)


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty formatted lines; a folder without any is an error."""
    lines = spark.read.text(path).select(F.col("value").alias("line")).where("line <> ''")
    if lines.isEmpty():
        raise ValueError(f"no conversations found in {path}")
    return lines


def write_packed(blocks: DataFrame, path: str) -> None:
    """Blocks by split. Readers of one split skip the other's files."""
    blocks.write.mode("overwrite").partitionBy("split").parquet(path)


def read_packed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    blocks = spark.read.parquet(path)
    if split is None:
        return blocks
    names = {split, VALIDATION_ALIASES.get(split, split)}
    return blocks.where(F.col("split").isin(*names))


def fingerprint(**parameters) -> str:
    text = json.dumps(parameters, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def load_or_build(spark: SparkSession, root: str, split: str, build: Callable[[], DataFrame],
                  vocabulary: Vocabulary, force: bool = False, **parameters) -> DataFrame:
    """Blocks of one split, from the cached table if it was built with the same parameters.

    The key covers every merge and control token of the vocabulary and all of ``parameters``, which must name
    whatever else decides the blocks. A table counts once a mark that names its folder is written after it. A
    chat table (``chat_`` prefix) stands in when there is no plain one; ``validation`` finds ``val``.
    ``build`` returns the blocks of all splits; ``force`` builds again.
    """
    key = fingerprint(merges=vocabulary.merges, specials=vocabulary.specials, **parameters)
    plain, chat = f"{root}/{key}", f"{root}/chat_{key}"
    if not force:
        for path in (plain, chat):
            place = _marked(spark, path)
            if place is not None:
                return read_packed(spark, place, split)
    # Every build has a folder of its own, so nobody's table changes under a reader, and a build that dies leaves
    # no mark on what it wrote.
    place = f"{plain}/build={uuid.uuid4().hex}"
    write_packed(build(), place)
    spark.createDataFrame([(place, time.time_ns())], MARK_SCHEMA).coalesce(1).write.mode("append").parquet(f"{plain}.done")
    return read_packed(spark, place, split)


def _marked(spark: SparkSession, path: str) -> str | None:
    """The folder that the last mark names, or the path itself if it names none; nothing without a mark."""
    try:
        last = spark.read.schema(MARK_SCHEMA).parquet(f"{path}.done").orderBy(F.desc("built"), "place").first()
    except AnalysisException:
        return None
    return last and (last["place"] or path)


def save_vocabulary(spark: SparkSession, vocabulary: Vocabulary, path: str) -> None:
    vocabulary.vocab_table(spark).write.mode("overwrite").parquet(f"{path}/vocab")
    vocabulary.merges_table(spark).write.mode("overwrite").parquet(f"{path}/merges")


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    return Vocabulary.from_tables(
        spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges"))


def check_same_vocabulary(size: int, expected: int) -> None:
    if size != expected or size > MAX_VOCAB_SIZE:
        raise ValueError(f"vocabulary has {size} tokens, the table expects {expected}")
