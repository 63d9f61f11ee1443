"""URL filter over a sorted array of digests.

Rules are ``host`` and ``path`` pairs with a verdict. Their 64-bit xxHash keys are kept sorted in one
file, with the full rule strings behind them; each Python worker maps the file into memory. A URL
asks for every suffix of its host with every path length that some rule has, longest rule first: one
binary search for all URLs of a batch at a time, and a hit counts only if the stored string is equal.
"""

from __future__ import annotations

import mmap
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.llm.words import schema_with
from textpack.session import scratch_root

MAGIC = b"TPRULES1"
#: Most rules of one array, about 2 GB of it; more would have to be dealt out by host.
MAX_RULES = 20_000_000
_mapped: dict[str, "RuleArray"] = {}


def rule_bytes(rules: Sequence[tuple[str, str, str]]) -> bytes:
    """The file of ``(verdict, host, path)`` rules. Of equal rules the first counts; hosts are
    lower-cased in A-Z. The rule string is host and path put together."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; one array takes {MAX_RULES}")
    seen: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict {verdict!r}")
        seen.setdefault((lower(host), path), verdict)
    entries = sorted((xxhash.xxh64_intdigest(f"{h}\n{p}"), f"{h}\n{p}".encode(), v == "block")
                     for (h, p), v in seen.items())
    strings = [s for _, s, _ in entries]
    ends = np.cumsum([len(s) for s in strings], dtype=np.int64)
    sizes = sorted({len(p) for _, p in seen})
    return b"".join([
        MAGIC, np.array([len(entries), len(sizes)], "<u8").tobytes(),
        np.array([d for d, _, _ in entries], "<u8").tobytes(), ends.astype("<i8").tobytes(),
        np.array(sizes, "<i8").tobytes(), np.array([b for _, _, b in entries], np.uint8).tobytes(), *strings])


def lower(text: str) -> str:
    """A-Z to a-z, nothing else."""
    return text.translate({c: c + 32 for c in range(65, 91)})


class RuleArray:
    def __init__(self, data):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a file of rules")
        n, k = np.frombuffer(data, "<u8", 2, 8).tolist()
        at = 24
        self.keys = np.frombuffer(data, "<u8", n, at)
        self.ends = np.frombuffer(data, "<i8", n, at + 8 * n)
        self.sizes = np.frombuffer(data, "<i8", k, at + 16 * n).tolist()[::-1]
        self.block = np.frombuffer(data, np.uint8, n, at + 16 * n + 8 * k)
        self.data, self.strings = data, at + 17 * n + 8 * k
        #: Labels of the rule host that has most; no longer suffix of a host needs to be asked for.
        self.labels = max((self.string(i).partition(b"\n")[0].count(b".") + 1 for i in range(n)), default=0)

    def string(self, i: int) -> bytes:
        start = int(self.ends[i - 1]) if i else 0
        return bytes(self.data[self.strings + start:self.strings + int(self.ends[i])])

    def find(self, texts: list[bytes]) -> np.ndarray:
        """Number of the rule equal to each string, or -1."""
        found = np.full(len(texts), -1, dtype=np.int64)
        if not len(self.keys) or not texts:
            return found
        digests = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64)
        at = np.searchsorted(self.keys, digests)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == digests).tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:  # equal digests lie together
                if self.string(k) == texts[i]:
                    found[i] = k
                    break
                k += 1
        return found

    def longest(self, hosts: list[str], paths: list[str]) -> list[int]:
        """The longest rule that fits each URL, or -1; of two of one length, that of the longer host."""
        asks, owners, order = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            labels = ".".join(host.rsplit(".", self.labels)[-self.labels:]) if self.labels else host
            while True:
                for size in self.sizes:
                    if size <= len(path):
                        asks.append(f"{labels}\n{path[:size]}".encode())
                        owners.append(i)
                        order.append((len(labels) + size, len(labels)))
                _, dot, labels = labels.partition(".")
                if not dot:
                    break
        best: list[tuple] = [(-1, -1, -1)] * len(hosts)
        found = self.find(asks)
        for j in np.flatnonzero(found >= 0).tolist():
            best[owners[j]] = max(best[owners[j]], (*order[j], int(found[j])))
        return [b[2] for b in best]


def write_rules(spark: SparkSession, rules: Sequence[tuple[str, str, str]], folder: str | None = None) -> str:
    """Write the array into the shared folder; its address."""
    system, root = pa.fs.FileSystem.from_uri(folder or scratch_root(spark))
    system.create_dir(root, recursive=True)
    path = f"{root}/textpack-rules-{uuid.uuid4().hex}"
    with system.open_output_stream(path) as stream:
        stream.write(rule_bytes(rules))
    return f"{(folder or scratch_root(spark)).rstrip('/')}/{path.rpartition('/')[2]}"


def mapped(address: str) -> RuleArray:
    """The array at ``address``: mapped where it is a file, else read once into the worker's memory."""
    if address not in _mapped:
        system, path = pa.fs.FileSystem.from_uri(address)
        if isinstance(system, pa.fs.LocalFileSystem):
            with open(path, "rb") as file:
                _mapped[address] = RuleArray(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        else:
            with system.open_input_file(path) as file:
                _mapped[address] = RuleArray(file.read())
    return _mapped[address]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up
    to ``?``, ``#`` or the end. A null URL or one without ``://`` has neither: both are empty.
    """
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], default: str = "allow",
          key: str = "page_id", url: str = "url") -> DataFrame:
    """Verdict of every URL: ``key, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. Where no rule fits
    ``rule`` is null and the verdict is ``default``. Repeated rows are judged each.
    """
    address = write_rules(pages.sparkSession, rules)
    columns = pages.select(F.col(key), F.col(url).alias("url"))
    host, path = split_url(F.col("url"))
    split = columns.select(key, host.alias("host"), path.alias("path"))
    schema = schema_with(split, "rule string, verdict string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = mapped(address)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = array.longest(hosts, paths)
            named = [array.string(i).decode().replace("\n", "", 1) if i >= 0 else None for i in found]
            verdicts = [("block" if array.block[i] else "allow") if i >= 0 else default for i in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(named, pa.string()), pa.array(verdicts, pa.string())], names=schema.names)

    return split.mapInArrow(run, schema)
