"""Quality rules: counts of a text, and a likelihood ratio of hashed n-grams.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials are counted, over trusted texts
and over all texts; a text's score is the mean log ratio of its buckets, and it is kept if the score
reaches the threshold. No draw is involved, so every text is decided, and always alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.words import buffers_of, by_slice, coefficients, hash_runs, mix, schema_with, texts_of, word_spans
from textpack.session import materialize

#: Buckets of n-grams; their two counts are all that a model is.
BUCKETS = 1 << 16
#: Added to every bucket before counts become shares.
SMOOTHING = 1.0
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
_SPACE_BYTES = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))


def bucket_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs of neighbours, and where each row's buckets start."""
    raw, bounds = buffers_of(column)
    starts, lengths, first = word_spans(raw, bounds)
    words = hash_runs(raw, starts, lengths)
    counts = np.diff(first)
    n_pairs = np.maximum(counts - 1, 0)
    pairs = mix(words[:-1] * coefficients(2)[0] + words[1:] * coefficients(2)[1]) if len(words) else words
    inner = np.ones(len(words), dtype=bool)
    inner[first[1:][counts > 0] - 1] = False
    sizes = counts + n_pairs
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words)) + (ends - sizes - first[:-1])[row]
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    out[at] = (words >> shift).astype(np.int64)
    out[(at + counts[row])[inner]] = (pairs[inner[:-1]] >> shift).astype(np.int64) if len(words) else 0
    return out, np.append(0, ends)


def bucket_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(bucket, n)`` over all texts.

    Each task adds up its texts, so the shuffle has at most one row for each bucket and task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)

        def add(batch: pa.RecordBatch) -> None:
            total[:] += np.bincount(bucket_runs(batch.column(0))[0], minlength=BUCKETS)

        for _ in by_slice(add)(batches):
            pass
        yield used_buckets(total)

    return added_up(docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long"))


def labelled_buckets(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``marks`` (``_key``, each once, ``_good, _fold``) with the buckets of the texts of ``docs`` (``_doc, text``) of that key.

    ``_good, _fold, base_failed, buckets``, a written table. Any number of keys may be marked. Not the texts meet them but
    their buckets, two bytes for each n-gram.
    """
    schema = schema_with(docs.select("_doc"), "base_failed boolean, buckets binary")

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, bounds = bucket_runs(batch.column(1))
        packed, at = found.astype("<u2").tobytes(), (2 * bounds).tolist()
        counts = np.array([measure(t) for t in texts_of(batch.column(1))], dtype=np.int64).reshape(-1, 5)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(fails(counts)), pa.array([packed[a:b] for a, b in zip(at, at[1:])], pa.binary())],
            names=schema.names)

    met = docs.mapInArrow(by_slice(pack), schema).join(marks, F.col("_doc") == F.col("_key"))
    return materialize(met.select("_good", "_fold", "base_failed", "buckets"), "labelled-buckets")


def target_counts(labelled: DataFrame) -> DataFrame:
    """``(bucket, n)`` over all rows of ``labelled_buckets``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total[:] += np.bincount(np.frombuffer(packed.as_buffer(), "<u2"), minlength=BUCKETS)
        yield used_buckets(total)

    return added_up(labelled.select("buckets").mapInArrow(run, "bucket long, n long"))


def fold_scores(labelled: DataFrame, ratios: list[np.ndarray]) -> DataFrame:
    """``_good, base_failed, score`` of rows of ``labelled_buckets``, by the log ratios of their fold."""
    shared = labelled.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for fold, packed in zip(batch.column(1).to_pylist(), batch.column(3)):
                found = shared.value[fold][np.frombuffer(packed.as_buffer(), "<u2")]
                scores.append(round(float(found.mean()), 9) if len(found) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())],
                                             names=["_good", "base_failed", "score"])

    return labelled.select("_good", "_fold", "base_failed", "buckets").mapInArrow(
        run, "_good boolean, base_failed boolean, score double")


def used_buckets(total: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(total)
    return pa.RecordBatch.from_pydict({"bucket": pa.array(used), "n": pa.array(total[used])})


def added_up(parts: DataFrame) -> DataFrame:
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(raw: DataFrame, target: DataFrame) -> np.ndarray:
    """Log of trusted over raw share for each bucket; at most ``BUCKETS`` rows of each come to the driver."""
    total = np.full((2, BUCKETS), SMOOTHING)
    for shares, counts in zip(total, (raw, target)):
        rows = counts.toArrow()
        shares[rows.column("bucket").to_numpy()] += rows.column("n").to_numpy()
    shares = np.log(total) - np.log(total.sum(axis=1, keepdims=True))
    return shares[1] - shares[0]


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    words = text.split()
    packed = text.translate(None, _SPACE_BYTES + _CONTINUED)
    symbols = len(packed) - len(packed.translate(None, SYMBOLS.encode()))
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE_BYTES)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) < len(windows):
        last = -1  # the last word already counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 2 - max(last, i - 1)
                last = i + 2
    return len(words), len(packed), symbols, len(lines) - len(set(lines)), repeated


def fails(counts: np.ndarray) -> np.ndarray:
    """Whether rows of ``measure`` fail the base rules."""
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED_PERCENT * counts[:, 0])


def score(docs: DataFrame, ratios: np.ndarray, threshold: float, key: str = "doc_id", text: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts, base rules, score and verdict of every row.

    ``key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept``.
    ``score`` is the mean log ratio over words and word pairs, 0 for a text without words. A null or
    empty text has no words and fails the base rules. Repeated rows are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    chosen = docs.select(key, F.col(text).alias("text"), *carry)
    schema = schema_with(docs.select(key, *carry), """
        n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,
        base_failed boolean, score double, kept boolean""")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(1)
        counts = np.array([measure(t) for t in texts_of(column)], dtype=np.int64).reshape(-1, 5)
        found, bounds = bucket_runs(column)
        running = np.concatenate([[0.0], np.cumsum(shared.value[found])])
        sizes = np.diff(bounds)
        scores = np.round((running[bounds[1:]] - running[bounds[:-1]]) / np.maximum(sizes, 1), 9)
        failed = fails(counts)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *batch.columns[2:], *(pa.array(c) for c in counts.T), pa.array(failed),
             pa.array(scores), pa.array(~failed & (scores >= threshold))], names=schema.names)

    return chosen.mapInArrow(by_slice(work), schema)


def best_threshold(scored: DataFrame, good: str) -> float:
    """The score that parts good from bad labelled rows with the fewest errors, each kind weighed by its share.

    Scores are counted in steps of 1/1000, so what comes to the driver is bounded by their spread.
    """
    step = F.floor(F.col("score") * 1000)
    rows = (scored.where(~F.col("base_failed")).groupBy(step.alias("step"))
            .agg(F.sum(F.when(F.col(good), 1).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col(good), 0).otherwise(1)).alias("bad")).orderBy("step").collect())
    goods, bads = sum(r["good"] for r in rows), sum(r["bad"] for r in rows)
    if not goods or not bads:
        return float("-inf")
    best, lost, caught, below = (0.0, float("-inf")), 0, 0, float("-inf")
    for row in rows:  # a cut lies halfway between the scores on both sides of it
        gain = caught / bads - lost / goods
        best = max(best, (gain, (below + row["step"]) / 2000), key=lambda x: x[0])
        lost, caught, below = lost + row["good"], caught + row["bad"], row["step"] + 1
    return best[1]


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          quality: str = "quality", max_labelled: int | None = None) -> DataFrame:
    """Counts and verdict of every text; trusted are texts that ``labels`` marks with quality 1.

    The raw multinomial is counted over whole texts of all rows, the target over whole texts of all trusted rows. The threshold
    is fitted on all labelled rows: keys of odd and of even hash are two folds, and each is scored by the target of the other,
    so no text is scored by counts that it is trusted in. With ``max_labelled`` only so many keys of odd hash, the smallest by
    hash, are held out: the threshold is fitted on them and the target is that of all others. Texts are never
    shuffled. A key with several labels is trusted if any is 1. Without labels of both kinds the score keeps all.
    """
    marks = (labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull())
             .groupBy(F.col(key).alias("_key")).agg(F.max(F.col(quality) == 1).alias("_good"))
             .withColumn("_fold", F.pmod(F.xxhash64("_key"), F.lit(2)).cast("int")))
    marks = materialize(marks, "labelled")  # its size tells whether it can be broadcast
    if max_labelled is not None:
        few = materialize(marks.where("_fold = 1").orderBy(F.xxhash64("_key"), "_key").limit(max_labelled)
                          .select("_key", F.lit(1).alias("_fold")), "threshold-keys")
        marks = marks.drop("_fold").join(few, "_key", "left").withColumn("_fold", F.coalesce("_fold", F.lit(0)))
    texts = docs.select(F.col(key).alias("_doc"), F.col(text).alias("text"))
    labelled = labelled_buckets(texts.where(F.col("_doc").isNotNull()), marks)
    raw = materialize(bucket_counts(texts), "raw-counts")
    even, odd = (log_ratios(raw, target_counts(labelled.where(F.col("_good") & (F.col("_fold") == fold)))) for fold in (0, 1))
    unseen = labelled if max_labelled is None else labelled.where("_fold = 1")
    threshold = best_threshold(fold_scores(unseen, [odd, even]), "_good")
    whole = even if max_labelled is not None else log_ratios(raw, target_counts(labelled.where("_good")))
    return score(docs, whole, threshold, key, text)
