"""Toxicity by multiple-instance learning.

A text is toxic if any of its sentences is: with sentence probabilities p, its own is the noisy-or
1 - prod(1 - p). Sentence weights are trained from labels of texts alone, through that product; afterwards the
sentence scores show where a text offends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.words import buffers_of, by_slice, hash_runs, schema_with, word_spans
from textpack.session import materialize

#: Hashed features, and the most labelled rows that the model is fitted on, those of the smallest hash.
BUCKET_BITS, MAX_TRAIN = 18, 12_000
STEPS, RATE, DECAY, START_BIAS = 150, 0.2, 1e-4, -6.0
THRESHOLD = 0.5
STEM_BYTES = 4
#: Texts of the sample that have a feature, and standard deviations it tells toxic texts by, under which its
#: weight stays 0.
LEAST_TEXTS, LEAST_DEVIATIONS = 5, 5.0
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# Words are runs of letters, digits and bytes over 127; sentences end at . ! ? and line feeds.
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_STOP = np.isin(np.arange(256), list(b".!?\n"))


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words and their stems, the first bucket of each sentence, the row of each sentence,
    and bytes where sentences start. A stem is the first four bytes; a sentence without words is none."""
    raw, bounds = buffers_of(column)
    starts, lengths, first = word_spans(raw, bounds, _BETWEEN)
    folded = _FOLD[raw]
    words = np.stack([hash_runs(folded, starts, lengths), ~hash_runs(folded, starts, np.minimum(lengths, STEM_BYTES))],
                     axis=1) >> np.uint64(64 - BUCKET_BITS)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    sentence = np.cumsum(_STOP[raw])[starts] + row if len(starts) else starts
    heads = np.flatnonzero(np.diff(sentence, prepend=-1))
    return words.astype(np.int32).ravel(), 2 * heads, row[heads], starts[heads]


def sums(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, heads) if len(heads) else np.zeros(0)


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def sentence_logits(self, words: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return sums(self.weights[words].astype(np.float64), heads) + self.bias

    def text_scores(self, logits: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Noisy-or of the sentences of each row and of one that tells nothing; a row without sentences scores 0.

        A sentence counts by what it adds to one that tells nothing, so that however many of these there are, the
        score is the same.
        """
        leak = np.logaddexp(0, self.bias)
        added = np.maximum(np.logaddexp(0, logits) - leak, 0)
        some = np.bincount(rows, minlength=n) > 0
        return np.where(some, -np.expm1(-np.bincount(rows, weights=added, minlength=n) - leak), 0.0)


def telling(seen: np.ndarray, in_toxic: np.ndarray, n: int, positive: int) -> np.ndarray:
    """Features that tell toxic texts from others: their share of toxic texts is far from the base rate."""
    base = positive / n
    far = np.abs(in_toxic - base * seen) >= LEAST_DEVIATIONS * np.sqrt(np.maximum(seen, 1) * base * (1 - base))
    return np.flatnonzero((seen >= LEAST_TEXTS) & far)


def fit(features: np.ndarray, sentence: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> Model:
    """Weights that make the labels likely, by gradient steps through the noisy-or.

    ``features`` are the telling features found, ``sentence`` the sentence of each, ``rows`` the text of each
    sentence that has any. Both kinds of texts weigh alike in sum. Without texts of both kinds, or without telling
    features, the model says the share of toxic texts.
    """
    size, n = 1 << BUCKET_BITS, len(labels)
    weights, positive = np.zeros(size), int(labels.sum())
    if positive in (0, n) or not len(features):
        share = min(max(positive / n, 1e-9), 1 - 1e-9) if n else 1e-9
        return Model(weights, np.log(share / (1 - share)))
    used, compact = np.unique(features, return_inverse=True)
    w, moment, power = (np.zeros(len(used) + 1) for _ in range(3))
    w[-1] = START_BIAS
    share = np.where(labels == 1, 0.5 / positive, 0.5 / (n - positive))
    for step in range(1, STEPS + 1):
        logits = np.bincount(sentence, weights=w[compact], minlength=len(rows)) + w[-1]
        leak = np.logaddexp(0, w[-1])
        counted = logits >= w[-1]
        clean = np.bincount(rows, weights=np.where(counted, np.logaddexp(0, logits) - leak, 0), minlength=n) + leak
        left = np.exp(-clean)  # chance of no toxic sentence
        pull = np.where(labels == 1, -left / np.maximum(1 - left, 1e-9), 1.0) * share
        chance, plain = np.exp(-np.logaddexp(0, -logits)), np.exp(-np.logaddexp(0, -w[-1]))
        grad_logit = np.where(counted, pull[rows] * chance, 0)
        grad_bias = (pull[rows] * (chance - plain))[counted].sum() + pull.sum() * plain
        grad = np.append(np.bincount(compact, weights=grad_logit[sentence], minlength=len(used)), grad_bias)
        grad[:-1] += DECAY * w[:-1]
        moment = 0.9 * moment + 0.1 * grad
        power = 0.99 * power + 0.01 * grad ** 2
        w -= RATE * (moment / (1 - 0.9 ** step)) / (np.sqrt(power / (1 - 0.99 ** step)) + 1e-9)
    weights[used] = w[:-1]
    return Model(weights, w[-1])


def held_out(key):
    """Rows that are never learned from: crc32 of the key as text divisible by 5, or no key."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows outside the held-out part, the smallest by hash of the key.

    The keys of the sample are broadcast. What comes to the driver is two counts for each feature and, of the sample, the telling features of its
    sentences. A key with several labels is toxic if any is.
    """
    marks = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
             .groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label) == 1).alias("_toxic")))
    chosen = marks.orderBy(F.xxhash64("_key"), "_key").limit(max_train)
    sample = materialize(
        docs.select(F.col(key).alias("_doc"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), F.col("_doc") == F.col("_key")).select("text", "_toxic"), "labelled-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (1 << BUCKET_BITS) + 1), dtype=np.int64)  # the last place counts texts

        def add(batch: pa.RecordBatch) -> None:
            words, heads, rows, _ = features(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            each = np.repeat(rows, np.diff(np.append(heads, len(words))))
            pairs = np.unique(each.astype(np.int64) << BUCKET_BITS | words)
            for place, wanted in enumerate((slice(None), toxic[pairs >> BUCKET_BITS])):
                total[place, :-1] += np.bincount(pairs[wanted] & ((1 << BUCKET_BITS) - 1), minlength=1 << BUCKET_BITS)
            total[:, -1] += len(toxic), toxic.sum()

        for _ in by_slice(add)(batches):
            pass
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used), "seen": pa.array(total[0][used]), "in_toxic": pa.array(total[1][used])})

    counts = (sample.mapInArrow(count, "bucket long, seen long, in_toxic long").groupBy("bucket")
              .agg(F.sum("seen").alias("seen"), F.sum("in_toxic").alias("in_toxic")).toArrow())
    total = np.zeros((2, (1 << BUCKET_BITS) + 1), dtype=np.int64)
    total[:, counts.column("bucket").to_numpy()] = counts.column("seen").to_numpy(), counts.column("in_toxic").to_numpy()
    n, positive = total[:, -1].tolist()
    kept = telling(*total[:, :-1], n, positive) if 0 < positive < n else np.zeros(0, np.int64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BUCKET_BITS, dtype=bool)
        wanted[kept] = True

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, heads, rows, _ = features(batch.column(0))
            sentence = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(words))))
            found = wanted[words]
            n_rows = batch.num_rows
            at = np.append(0, np.cumsum(np.bincount(rows[sentence[found]], minlength=n_rows))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x[found].astype(np.int32))) for x in (words, sentence)]
            return pa.RecordBatch.from_arrays(
                [*lists, pa.array(np.bincount(rows, minlength=n_rows)), batch.column(1)], names=["words", "sentence", "n", "_toxic"])
        return by_slice(work)(batches)

    table = sample.mapInArrow(pick, "words array<int>, sentence array<int>, n long, _toxic boolean").toArrow()
    # In a fixed order, whatever the tasks' was.
    texts = sorted(zip(table.column("_toxic").to_pylist(), table.column("n").to_pylist(), table.column("words").to_pylist(),
                       table.column("sentence").to_pylist()), key=lambda t: (t[0], t[1], t[2], [s - t[3][0] for s in t[3]]))
    flat = np.array([w for t in texts for w in t[2]], dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t[2]) for t in texts]) if texts else np.zeros(0, np.int64)
    number = np.array([s for t in texts for s in t[3]], dtype=np.int64)
    heads = np.append(True, (np.diff(number) != 0) | (np.diff(row) != 0)) if len(flat) else np.zeros(0, bool)
    return fit(flat, np.cumsum(heads) - 1, row[heads], np.array([int(t[0]) for t in texts]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``(key, score, sentences)``: each text's score and its offending sentences.

    ``sentences`` has ``(start, end, score)`` of the sentences that score ``threshold`` or more, in bytes of UTF-8.
    Only the text is an input. Null, empty and wordless texts score 0; repeated rows are scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    schema = schema_with(docs.select(key), "score double, sentences array<struct<start:bigint,end:bigint,score:double>>")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, n = shared.value, batch.num_rows
        _, bounds = buffers_of(batch.column(1))
        words, heads, rows, starts = features(batch.column(1))
        logits = own.sentence_logits(words, heads)
        chance = np.exp(-np.logaddexp(0, -logits))
        places: list[list] = [[] for _ in range(n)]
        for i in np.flatnonzero(chance >= threshold).tolist():
            row = int(rows[i])
            last = i + 1 < len(rows) and rows[i + 1] == row
            end = int(starts[i + 1]) if last else int(bounds[row + 1])
            places[row].append({"start": int(starts[i] - bounds[row]), "end": end - int(bounds[row]), "score": float(chance[i])})
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.clip(own.text_scores(logits, rows, n), 0, 1)), pa.array(places, kind)], names=schema.names)

    return docs.select(key, F.col(text).alias("text")).mapInArrow(by_slice(work), schema)


def without_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score under ``threshold``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, heads, rows, _ = features(batch.column(at))
        logits = shared.value.sentence_logits(words, heads)
        return batch.filter(pa.array(shared.value.text_scores(logits, rows, batch.num_rows) < threshold))

    return docs.mapInArrow(by_slice(work, text), docs.schema)
