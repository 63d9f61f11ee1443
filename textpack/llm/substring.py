"""Substring deduplication with a compressed FM-index for each shard.

Windows of ``window`` words are looked up in FM-indexes by backward search over wavelet trees. What
an index holds is dealt by content, so that equal windows always meet: every window has an anchor, the
run of words of the smallest hash in it, and neighbouring windows of one anchor make a segment. Only
segments whose anchor occurs again are indexed; equal segments are one, owned by the smallest document, so a
group of copies is indexed once. Segments of an anchor that has very many different ones are dealt anew by longer
anchors, up to whole windows, so that no shard grows with a passage's popularity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.fmindex import FMIndex
from textpack.llm.words import coefficients, hashed_words, mix, slices, texts_of
from textpack.session import materialize

WINDOW = 50
#: Words of an anchor, first and then for segments of an anchor that has more than MANY of them.
FIRST_ANCHOR, LONGER_ANCHORS, MANY = 8, (29, 43), 500
#: Words that a shard holds, about.
SHARD_WORDS = 250_000
#: Stands for a missing document id, behind all others.
LAST_ID = (1 << 63) - 1
_ORDER = np.uint64(0xFFFFFFFFF0000000)
_BASE = 0x9E3779B97F4A7C15 | 1


def powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, dtype=np.uint64)
    made[:1] = 1
    return np.multiply.accumulate(made)


def runs(words: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Row, anchor hash, content hash, start and length of the segments of several word sequences.

    A segment covers the longest stretch of windows that have one anchor in common; the leftmost of equal
    anchors counts. A sequence shorter than a window has none.
    """
    n, span = len(words), window - anchor + 1
    fits = np.maximum(np.diff(first) - window + 1, 0)
    ends = np.cumsum(fits)
    if not len(ends) or not ends[-1]:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    grams = np.zeros(n - anchor + 1, dtype=np.uint64)
    for j, c in enumerate(coefficients(anchor)):
        grams += words[j:n - anchor + 1 + j] * c
    grams = mix(grams)
    least = (grams & _ORDER) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[:len(least) - (span - width)], least[span - width:]) if span > width else least
    rows = np.repeat(np.arange(len(fits)), fits)
    starts = np.arange(ends[-1]) + np.repeat(first[:-1] - (ends - fits), fits)
    at = (least[starts] & ~_ORDER).astype(np.int64)
    head = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(rows, prepend=-1) != 0))
    begin, row = starts[head], rows[head]
    stop = starts[np.append(head[1:], len(starts)) - 1] + window
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * powers(_BASE, n), out=total[1:])
    inverse = powers(pow(_BASE, -1, 1 << 64), n)
    content = mix((total[stop] - total[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))
    return row, grams[at[head]], content, begin - first[row], stop - begin


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, digest, text``: rows of one id and text are alike in all that follows."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text"))


def segments(rows: DataFrame, window: int) -> DataFrame:
    """``id, digest, anchor, content, start, length`` of all segments of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column(2)):
                words, first = hashed_words(batch.column(2).slice(begin, end - begin))
                row, anchor, content, start, length = runs(words, first, window, FIRST_ANCHOR)
                if len(row):
                    taken = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(begin, end - begin).take(taken), batch.column(1).slice(begin, end - begin).take(taken),
                         pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                         pa.array(start, pa.int32()), pa.array(length, pa.int32())],
                        names=["id", "digest", "anchor", "content", "start", "length"])

    return rows.select("id", "digest", "text").mapInArrow(
        run, "id long, digest long, anchor long, content long, start int, length int")


def words_of(owned: DataFrame) -> DataFrame:
    """``anchor, content, id, words`` of the segments that each text of ``owned`` lists in ``parts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column(1)):
                words, first = hashed_words(batch.column(1).slice(begin, end - begin))
                parts = batch.column(2).slice(begin, end - begin)
                flat = parts.flatten()
                row = pa.compute.list_parent_indices(parts).to_numpy()
                at = first[row] + flat.field("start").to_numpy()
                stop = at + flat.field("length").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [flat.field("anchor"), flat.field("content"), batch.column(0).slice(begin, end - begin).take(pa.array(row)),
                     pa.array([words[a:b].tobytes() for a, b in zip(at.tolist(), stop.tolist())], pa.binary())],
                    names=["anchor", "content", "id", "words"])

    return owned.select("id", "text", "parts").mapInArrow(run, "anchor long, content long, id long, words binary")


def dealt_anew(hot: DataFrame, window: int, anchor: int) -> DataFrame:
    """Segments cut into segments of longer anchors, each with what it was cut from and where."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                whole = [np.frombuffer(b.as_py(), np.uint64) for b in part.column(3)]
                first = np.concatenate([[0], np.cumsum([len(w) for w in whole])])
                words = np.concatenate(whole)
                row, longer, content, start, length = runs(words, first, window, anchor)
                taken, at = pa.array(row), first[row] + start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(longer.view(np.int64)), pa.array(content.view(np.int64)), part.column(2).take(taken),
                     pa.array([words[a:a + n].tobytes() for a, n in zip(at.tolist(), length.tolist())], pa.binary()),
                     part.column(0).take(taken), part.column(1).take(taken), pa.array(start, pa.int32())],
                    names=["anchor", "content", "id", "words", "from_anchor", "from_content", "offset"])

    return hot.select("anchor", "content", "id", "words").mapInArrow(
        run, "anchor long, content long, id long, words binary, from_anchor long, from_content long, offset int")


def searched(segs: DataFrame, window: int, n_shards: int) -> DataFrame:
    """``anchor, content, low, high, first``: for windows ``low`` to ``high`` of each segment, the
    smallest owner of an equal window, from the FM-index of the segment's shard."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sequences = [np.frombuffer(b.as_py(), np.uint64) for b in table.column("words")]
        lengths = np.array([len(s) for s in sequences])
        index = FMIndex(sequences, table.column("id").to_numpy(), window)
        rows, low, high, least = [], [], [], []
        for k, first in enumerate(index.first_owners(lengths)):
            heads = np.flatnonzero(np.diff(first, prepend=first[0] - 1 if len(first) else 0))
            rows.append(np.full(len(heads), k))
            low.append(heads)
            high.append(np.append(heads[1:], len(first))[:len(heads)] - 1)
            least.append(first[heads])
        rows, low, high, least = (np.concatenate(x).astype(np.int64) for x in (rows, low, high, least))
        taken = pa.array(rows)
        return pa.table({"anchor": table.column("anchor").take(taken), "content": table.column("content").take(taken),
                         "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32()), "first": pa.array(least)})

    shard = F.pmod("anchor", F.lit(n_shards)).alias("shard")
    return (segs.select(shard, "anchor", "content", "id", "words").groupBy("shard")
            .applyInArrow(run, "anchor long, content long, low int, high int, first long"))


def first_owners(segs: DataFrame, window: int, level: int = 0) -> DataFrame:
    """As ``searched``; segments of crowded anchors are dealt anew first, and what is found is put together."""
    sizes = segs.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.length("words")).alias("bytes"))
    crowded = sizes.where(F.col("n") > MANY)
    n_words, hot = sizes.agg(F.sum("bytes"), F.sum(F.when(F.col("n") > MANY, F.col("n")))).first()
    n_shards = max(1, round((n_words or 0) / 8 / SHARD_WORDS))
    anchors = (*LONGER_ANCHORS, window)
    anchors = [a for a in anchors if FIRST_ANCHOR < a <= window]
    if not hot or level >= len(anchors):
        return searched(segs, window, n_shards)
    cut = materialize(dealt_anew(segs.join(crowded.select("anchor"), "anchor", "left_semi"), window, anchors[level]), "dealt-anew")
    children = materialize(cut.groupBy("anchor", "content").agg(F.min("id").alias("id"), F.first("words").alias("words")), "children")
    below = (first_owners(children, window, level + 1)
             .join(cut.select("anchor", "content", "from_anchor", "from_content", "offset"), ["anchor", "content"])
             .select(F.col("from_anchor").alias("anchor"), F.col("from_content").alias("content"),
                     (F.col("low") + F.col("offset")).alias("low"), (F.col("high") + F.col("offset")).alias("high"), "first"))
    rest = segs.join(crowded.select("anchor"), "anchor", "left_anti")
    return searched(rest, window, n_shards).unionByName(below)


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``id, digest, spans`` of texts with windows that a smaller id has too, and the texts that may be such.

    ``spans`` has the first word of such a window run and the word behind its last.
    """
    every = materialize(segments(rows, window), "segments")
    # Written first, so that the join reads both sides from exchanges, whose large keys Spark can split.
    again = materialize(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    members = materialize(every.join(again, "anchor"), "members")
    owners = (members.groupBy("anchor", "content")
              .agg(F.min(F.struct("id", "digest", "start", "length")).alias("o"), F.count("*").alias("n")))
    parts = (owners.select("o.id", "o.digest", F.struct("anchor", "content", "o.start", "o.length").alias("part"))
             .groupBy("id", "digest").agg(F.collect_list("part").alias("parts")))
    wanted = members.select("id", "digest").distinct().join(parts, ["id", "digest"], "left")
    texts = materialize(rows.join(wanted, ["id", "digest"]), "repeating-texts")
    owned = texts.where(F.col("parts").isNotNull()).dropDuplicates(["id", "digest"])
    found = first_owners(materialize(words_of(owned), "segment-words"), window)
    spans = (members.join(found, ["anchor", "content"]).where(F.col("first") < F.col("id"))
             .select("id", "digest", F.struct((F.col("start") + F.col("low")).alias("begin"),
                                              (F.col("start") + F.col("high") + window).alias("end")).alias("span"))
             .groupBy("id", "digest").agg(F.collect_set("span").alias("spans")))
    return spans, texts


def deduplicate(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` of every row.

    A word goes if it lies in a window of ``window`` words whose words, in their order, also start in a
    row of a smaller key; the rest is joined by one space. Windows are judged on the input. A null key is
    behind all others; a null, empty or short text loses nothing; repeated rows of one key are no smaller than each other. Words are compared by
    64-bit hashes, windows therefore by ``window`` of them.
    """
    rows = keyed(docs, key, text)
    spans, texts = repeated_spans(rows, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for body, found in zip(texts_of(batch.column(2)), batch.column(3).to_pylist()):
                words = body.split()
                gone = np.zeros(len(words), dtype=bool)
                for span in found:
                    gone[span["begin"]:span["end"]] = True
                removed.append(int(gone.sum()))
                kept.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             names=["id", "digest", "n_removed", "less_sha256"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.split() for t in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([len(w) for w in words], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())],
                names=["id", "digest", "n_words", "whole_sha256"])

    less = (texts.select("id", "digest", "text").dropDuplicates(["id", "digest"]).join(spans, ["id", "digest"])
            .select("id", "digest", "text", "spans").mapInArrow(cut, "id long, digest long, n_removed long, less_sha256 string"))
    whole = rows.select("id", "digest", "text").mapInArrow(count, "id long, digest long, n_words long, whole_sha256 string")
    return whole.join(less, ["id", "digest"], "left").select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias(key), "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("less_sha256", "whole_sha256").alias("kept_sha256"))
