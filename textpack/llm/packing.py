"""Token ids as files of fixed-width bit fields.

Every id takes the bits that the largest id of the vocabulary needs. A file is::

    payload   blocks of BLOCK ids, each block a whole number of 64-bit little-endian words
    footer    doc ids (int64), null flags (uint8), lengths (int64), block offsets (uint64)
    trailer   n_docs, n_ids, n_blocks, bits, footer offset (uint64 each), MAGIC

so that any block can be read and unpacked alone. Each task writes one file for its range of
doc ids under a name of its own; only files that the manifest names count, so a task that is run again
leaves an unused file behind and nothing else.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textpack.llm.bpe import coder
from textpack.llm.words import slices
from textpack.session import materialize, scratch_path

MAGIC = b"TPBITS01"
#: Ids of a block; a multiple of 64.
BLOCK = 4096
#: Letters of a text that part rows of one key.
RANGE_LETTERS = 64
MANIFEST = "part int, file string, n_docs long, n_ids long"


def bits_for(vocabulary_size: int) -> int:
    """The fewest bits that hold every id."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids as 64-bit words; the last group of 64 ids is filled up with zeros."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, dtype=np.uint64)
    padded[:len(ids)] = ids
    columns = padded.reshape(groups, 64)
    words = np.zeros((groups, bits), dtype="<u8")
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        words[:, word] |= columns[:, k] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= columns[:, k] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed words."""
    table = words.reshape(-1, bits)
    ids = np.empty((len(table), 64), dtype=np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        ids[:, k] = table[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            ids[:, k] |= table[:, word + 1] << np.uint64(64 - shift)
    ids &= np.uint64((1 << bits) - 1)
    return ids.ravel()[:n].astype(np.uint32)


class IdWriter:
    """Appends documents to one file."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits, self.at = stream, bits, 0
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.offsets: list[int] = []
        self.n_ids = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.nulls.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self.lengths.append(lengths.astype("<i8"))
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            self.flush(self.waiting - self.waiting % BLOCK)

    def flush(self, n: int) -> None:
        """Write the first ``n`` waiting ids as blocks."""
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, dtype=np.int32)
        if n:
            words = pack(ids[:n], self.bits)
            starts = np.arange(0, n, BLOCK) // 64 * self.bits * 8 + self.at
            self.offsets.extend(starts.tolist())
            self.stream.write(words.tobytes())
            self.at += words.nbytes
        self.pending, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> int:
        """Write what waits and the footer; the number of documents."""
        self.flush(self.waiting)
        docs = np.concatenate([np.zeros(0, "<i8"), *self.docs])
        for part in (docs, np.concatenate([np.zeros(0, np.uint8), *self.nulls]),
                     np.concatenate([np.zeros(0, "<i8"), *self.lengths]), np.array(self.offsets, "<u8"),
                     np.array([len(docs), self.n_ids, len(self.offsets), self.bits, self.at], "<u8")):
            self.stream.write(part.tobytes())
        self.stream.write(MAGIC)
        return len(docs)


class IdReader:
    """Reads documents or single blocks of a file."""

    def __init__(self, file):
        self.file = file
        tail = 40 + len(MAGIC)
        file.seek(file.size() - tail)
        trailer = file.read(tail)
        if trailer[40:] != MAGIC:
            raise ValueError("not a file of packed ids, or one that was cut off")
        n_docs, self.n_ids, n_blocks, self.bits, at = np.frombuffer(trailer[:40], "<u8").tolist()
        file.seek(at)
        self.docs = np.frombuffer(file.read(8 * n_docs), "<i8")
        self.nulls = np.frombuffer(file.read(n_docs), np.uint8).astype(bool)
        self.lengths = np.frombuffer(file.read(8 * n_docs), "<i8")
        self.offsets = np.frombuffer(file.read(8 * n_blocks), "<u8")
        self.ends = np.append(self.offsets[1:], np.uint64(at))
        self.starts = np.cumsum(self.lengths) - self.lengths

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks ``first`` to ``last - 1``."""
        if first >= last:
            return np.zeros(0, dtype=np.uint32)
        self.file.seek(int(self.offsets[first]))
        data = self.file.read(int(self.ends[last - 1] - self.offsets[first]))
        return unpack(np.frombuffer(data, "<u8"), self.bits, min(last * BLOCK, self.n_ids) - first * BLOCK)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from the ``start``-th of the file on; reads only the blocks that hold them."""
        first, last = start // BLOCK, -(-(start + n) // BLOCK)
        return self.blocks(first, last)[start - first * BLOCK:start - first * BLOCK + n]

    def runs(self, limit: int = 256 * BLOCK) -> Iterator[tuple[int, int, np.ndarray]]:
        """Document ranges with their ids, about ``limit`` ids at a time."""
        doc = 0
        while doc < len(self.docs):
            end = int(np.searchsorted(self.starts, self.starts[doc] + limit))
            end = max(end, doc + 1)
            n = int(self.starts[end - 1] + self.lengths[end - 1] - self.starts[doc])
            yield doc, end, self.ids(int(self.starts[doc]), n)
            doc = end


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode texts, append ``end_id`` to each, and write files in ascending order of ``key``.

    A null or empty text is only the end id; null keys come first, and rows of one key are ordered by
    their text. Texts are encoded once, after the only shuffle, in the task that writes them.
    Returns the manifest ``part, file, n_docs, n_ids``, itself a written table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        part = TaskContext.get().partitionId()
        system, root = pa.fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.bits"
        with system.open_output_stream(f"{root}/{name}") as stream:
            writer = IdWriter(stream, bits_for(max(own.vocabulary.size, end_id + 1)))
            for batch in batches:
                for start, end in slices(batch.column(1)):
                    ids, counts = own.encode(batch.column(1).slice(start, end - start))
                    ended = np.insert(ids, np.cumsum(counts), end_id)
                    writer.add(batch.column(0).slice(start, end - start), ended, counts + 1)
            n_docs = writer.close()
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "file": [name], "n_docs": pa.array([n_docs], pa.int64()),
             "n_ids": pa.array([writer.n_ids], pa.int64())})

    # Rows of one key are dealt by how their texts begin, so that many rows of a key are several ranges.
    rows = (docs.select(F.col(key).cast("long").alias(key), text)
            .repartitionByRange(F.col(key), F.substring(text, 1, RANGE_LETTERS)).sortWithinPartitions(key, text))
    return materialize(rows.mapInArrow(run, MANIFEST), "id-files")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of written files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts all ids before the document. Running totals are taken over the manifest, which
    has one narrow row per file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.where("n_docs > 0").withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n_files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_file(f"{root}/{name}") as file:
                    reader = IdReader(file)
                    for doc, end, ids in reader.runs():
                        at = reader.starts[doc:end] - reader.starts[doc]
                        crcs = [zlib.crc32(ids[a:a + n].astype("<u4").tobytes())
                                for a, n in zip(at.tolist(), reader.lengths[doc:end].tolist())]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(reader.docs[doc:end], pa.int64(), mask=reader.nulls[doc:end]),
                            "start": pa.array(reader.starts[doc:end] + start, pa.int64()),
                            "n_tokens": pa.array(reader.lengths[doc:end], pa.int64()),
                            "ids_crc32": pa.array(crcs, pa.int64())})

    return (files.select("part", "file", "start").repartition(n_files, "part")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write files into the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "ids")
    return read_ids(write_ids(docs, tokenizer, folder, end_id), folder)
