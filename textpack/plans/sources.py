"""From whichever source can be opened to chat pairs, as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.operators.blocks import parse_blocks
from textpack.operators.clean import synth_user_turn
from textpack.operators.ordering import CHUNK_WIDTH, limit_n
from textpack.sources.io import read_text_lines, write_pairs

MAX_PAIRS = 50_000


@dataclass(frozen=True)
class Source:
    """A folder or file and what it holds.

    ``instructions`` are lines of instruction blocks: text files, or a table of (src, line_no, line). ``stories`` is a table
    of texts without instructions, ordered by ``key``.
    """

    path: str
    holds: str = "stories"
    fmt: str = "parquet"
    key: str = "doc_id"
    text: str = "text"


def first_source(spark: SparkSession, sources: list[Source]) -> tuple[Source, DataFrame]:
    """The first source that opens; an error if none does. Only opening is tried."""
    for source in sources:
        try:
            if source.fmt == "text":
                return source, read_text_lines(spark, source.path)
            return source, spark.read.format(source.fmt).load(source.path)
        except AnalysisException:
            continue
    raise FileNotFoundError(f"none of the sources could be opened: {[s.path for s in sources]}")


def pairs_of(source: Source, rows: DataFrame, width: int = CHUNK_WIDTH) -> tuple[DataFrame, list[str]]:
    """Pairs (key..., user, assistant) of an opened source, and the columns that order them.

    Instruction blocks are parsed; stories get the default user turn. Plain text files of stories hold one a line.
    """
    if source.holds == "instructions":
        return parse_blocks(rows.select("src", "line_no", "line"), width), ["src", "end_line"]
    if source.fmt == "text":
        return synth_user_turn(rows.withColumn("place", F.struct("src", "line_no")), "place", "line"), ["place"]
    return synth_user_turn(rows, source.key, source.text), [source.key]


def source_pairs(spark: SparkSession, sources: list[Source], max_pairs: int = MAX_PAIRS, out: str | None = None,
                 width: int = CHUNK_WIDTH) -> DataFrame:
    """The first ``max_pairs`` pairs of the first source that opens, with its path in ``source``.

    Nothing but keys is ordered for the limit. ``out`` writes the pairs and reads them back; a source
    without a pair is an error then and there, otherwise an empty result.
    """
    source, rows = first_source(spark, sources)
    pairs, keys = pairs_of(source, rows, width)
    kept = limit_n(pairs, keys, max_pairs).withColumn("source", F.lit(source.path))
    if out is None:
        return kept
    write_pairs(kept, out)
    written = spark.read.schema(kept.schema).json(out)
    if written.isEmpty():
        raise ValueError(f"no usable conversations found in {source.path}")
    return written
