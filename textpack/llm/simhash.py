"""Near duplicates by SimHash fingerprints, met in the middle.

Two fingerprints differ in at most two bits if and only if they have a variant in common that differs from each
in at most one. Every distinct fingerprint emits its 65 variants, and fingerprints meet by variant. At most 65
distinct ones meet there, all within two bits of one another, so no meeting needs splitting, and linking each
to the smallest of them loses no component. Copies are one fingerprint from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.components import connect
from textpack.llm.words import by_slice, free_name, schema_with, texts_of
from textpack.session import materialize

SEED, RADIUS = 42, 2


def fingerprint(text: bytes, shingle: int = 3, seed: int = SEED) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, repeats included; A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends.tolist())),
                         dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):  # a few MB of bits at a time, whatever the length
        part = hashes[at:at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                 seed: int = SEED) -> DataFrame:
    """``(key, fp)``: the fingerprint of each row as a signed 64-bit number. A null, empty or blank
    text has no shingle and fingerprint zero; a text shorter than a shingle is one shingle."""
    schema = schema_with(docs.select(key), "fp bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)`` pairs of distinct fingerprints within RADIUS bits that connect all that are linked, from a
    column ``fp`` of distinct fingerprints."""
    masks = [0, *(1 << b for b in range(63)), -(1 << 63)]  # at most half of RADIUS bits
    # Each row becomes 65: as many tasks as the shuffle behind has, however few rows there are. Dealt by another key than the
    # rows lie by, or the exchange would be left out and its few small partitions put together.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = prints.repartition(tasks, F.xxhash64("fp")).select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    met = (variants.groupBy(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
           .agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1))
    pairs = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    seed: int = SEED) -> DataFrame:
    """``(key, fingerprint, component_id)`` of every row: 16 hexadecimal digits, and the smallest key
    reachable over links of at most RADIUS bits, its own included.

    Null keys take part but are never a component's name unless it has no other; repeated rows are kept.
    """
    rows = materialize(fingerprints(docs, key, text, shingle, seed), "fingerprints")
    named = rows.groupBy("fp").agg(F.min(key).alias("first"))
    classes = named.join(groups(rows), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    members = classes.join(names, "root").select("fp", "component_id")
    return (rows.join(members, "fp")
            .select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def groups(rows: DataFrame) -> DataFrame:
    """``(fp, root)`` of every fingerprint that is linked to another."""
    return connect(materialize(links(rows.select("fp").distinct()), "links")).withColumnRenamed("node", "fp")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = SEED) -> DataFrame:
    """Rows of ``docs``, one of each component: that of the smallest key, null keys last.

    Rows are told apart by their place in the written table, so rows that share a key but not a component all stay,
    and of repeated rows one. Texts are shuffled once.
    """
    at = docs.columns.index(text)
    fp, row = free_name(docs, "_fp"), free_name(docs, "_row")
    names = [*docs.columns, fp]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch.column(at))], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))], names=names)

    written = docs.mapInArrow(by_slice(work, text), schema_with(docs, f"`{fp}` bigint")).withColumn(row, F.monotonically_increasing_id())
    written = materialize(written, "fingerprinted")
    rows = written.select(F.struct(F.col(key).isNull(), F.col(key), F.col(row)).alias("order"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    # Reduced to the first row of each fingerprint before the links are followed.
    firsts = rows.groupBy("fp").agg(F.min("order").alias("order"), F.min_by("row", "order").alias("row"))
    label = F.coalesce("root", "fp").alias("root")
    chosen = (firsts.join(groups(rows), "fp", "left").select(label, "order", "row")
              .groupBy("root").agg(F.min_by("row", "order").alias(row)).select(row))
    return written.join(chosen, row, "left_semi").select(docs.columns)
