import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textpack.operators import ordering as O


def key(seed, *parts):
    return hashlib.md5(":".join(str(p) for p in (seed, *parts)).encode()).hexdigest()


def test_running_with_a_hot_partition(spark):
    rng = random.Random(1)
    rows, used = [], set()
    for _ in range(900):
        part = rng.choice(["hot", "hot", "hot", "a", "b"])
        k = rng.randrange(5000)
        if (part, k) not in used:
            used.add((part, k))
            rows.append((part, k, rng.choice([0, 0, 1, 7]), rng.random() < 0.1))
    df = spark.createDataFrame(rows, "p string, k long, w long, f boolean")
    out = O.running(df, "k", O.chunk_buckets("k", 3), ["p"], sums={"s": F.col("w")},
                    maxes={"m": F.when(F.col("f"), F.col("k"))}, totals={"t": "s"})
    got = {(r.p, r.k): (r.s, r.m, r.t) for r in out.collect()}
    assert len(got) == len(rows)
    for p in {r[0] for r in rows}:
        total, last = 0, None
        mine = sorted(r for r in rows if r[0] == p)
        whole = sum(r[2] for r in mine)
        for _, k, w, f in mine:
            assert got[p, k] == (total, last, whole)
            total += w
            last = k if f else last


def test_no_single_partition_exchange_of_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    out = O.seeded_shuffle(df.withColumn("wide", F.lit("x")), ["doc_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert all("wide" not in line for line in single)


@pytest.mark.parametrize("n", [0, 1, 10, 30, 50, 70])
def test_exact_split_rounds_half_to_even(spark, n):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = O.exact_split(df, ["doc_id"]).collect()
    order = sorted(range(n), key=lambda i: key(42, i))
    n_val = int(round(n * 0.05))
    assert sorted(r.position for r in rows) == list(range(n))
    assert {r.doc_id: r.split for r in rows} == {
        d: "val" if i < n_val else "train" for i, d in enumerate(order)}


def test_split_and_place(spark):
    rng = random.Random(2)
    rows = [(i // 5, i % 5, rng.randrange(4)) for i in range(137)]
    df = spark.createDataFrame(rows, "c long, t long, n_tokens int").withColumn(
        "ids", F.array_repeat(F.lit(1), F.col("n_tokens")))
    got = {(r.c, r.t): (r.position, r.split, r.start)
           for r in O.split_and_place(df, ["c", "t"], 0.1, 7).collect()}
    starts = {"val": 0, "train": 0}
    for i, (c, t, n) in enumerate(sorted(rows, key=lambda r: key(7, r[0], r[1]))):
        split = "val" if i < round(137 * 0.1) else "train"
        assert got[c, t] == (i, split, starts[split])
        starts[split] += n


def wide_table(spark, n=10_001):
    draw = random.Random(3)
    rows = [(i % 300, str(draw.randrange(10**6)), int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "dup long, s string, hashed long, i long").repartition(7)


@pytest.mark.parametrize("n", [1, 37, 5000, 10_000, 20_000])
@pytest.mark.parametrize("keys,places", [(["hashed"], [2]), (["s", "i"], [1, 3]), (["dup", "hashed"], [0, 2])])
def test_limit_by_any_key(spark, n, keys, places):
    rows, df = wide_table(spark)
    picked = sorted(rows, key=lambda r: [r[p] for p in places])[:n]
    assert sorted(map(tuple, O.limit_n(df, keys, n).collect())) == sorted(picked)


def test_limit_by_a_struct_and_with_ties(spark):
    rows, df = wide_table(spark)
    pairs = df.select(F.struct("dup", "i").alias("k"))
    assert sorted(r.k.i for r in O.limit_n(pairs, "k", 40).collect()) == sorted(r[3] for r in sorted(rows, key=lambda r: (r[0], r[3]))[:40])
    found = [sorted(map(tuple, O.limit_n(d, "dup", 100).collect())) for d in (df, df.repartition(3))]
    assert found[0] == found[1] and sorted(r[0] for r in found[0]) == sorted(r[0] for r in rows)[:100]
    with pytest.raises(ValueError):
        O.limit_n(df, "dup", 0)


def test_ranges_are_few_and_offsets_exact_for_hashed_keys(spark):
    rows, df = wide_table(spark)
    ranged = O.in_ranges(df.select("hashed", "i"), "hashed")
    assert ranged.select(O.RANGE).distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = O.global_offset(ranged, F.col("i"), "hashed", O.range_buckets()).collect()
    total = 0
    for r in sorted(placed, key=lambda r: r.hashed):
        assert r.start == total
        total += r.i


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_previous_row_across_chunks(spark, width):
    rng = random.Random(4)
    rows = [("hot", k) for k in rng.sample(range(300), 90)] + [("b", 5), ("c", 7), ("c", 299)]
    df = spark.createDataFrame(rows, "p string, k long")
    got = {(r.p, r.k): r.previous and r.previous.k
           for r in O.with_previous(df, "p", "k", ["k"], width).collect()}
    assert len(got) == len(rows)
    for p in ("hot", "b", "c"):
        before = None
        for k in sorted(k for q, k in rows if q == p):
            assert got[p, k] == before
            before = k


def test_concatenation_order(spark):
    a = spark.createDataFrame([(9, 2), (1, 3)], "key long, n long")
    b = spark.createDataFrame([(4, 5), (0, 1)], "key long, n long")
    whole = O.in_ranges(O.union_in_order([a, b]), "part", "key")
    out = O.running(whole, F.struct("part", "key"), O.range_buckets(), sums={"start": F.col("n")})
    assert sorted((r.part, r.key, r.start) for r in out.collect()) == [
        (0, 1, 0), (0, 9, 3), (1, 0, 5), (1, 4, 6)]


def test_a_limit_shuffles_and_writes_keys_alone(spark, tmp_path, monkeypatch):
    spark.range(5000).selectExpr("id AS k", "repeat(cast(id AS string), 50) AS text").write.parquet(f"{tmp_path}/t")
    written = []
    kept = O.materialize
    monkeypatch.setattr(O, "materialize", lambda df, name: (written.append(df.columns), kept(df, name))[1])
    cut = O.limit_n(spark.read.parquet(f"{tmp_path}/t"), "k", 1234)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in cut.select("k").collect()) == list(range(1234))
    assert all(set(columns) <= {"k", O.RANGE} for columns in written)
    assert "Exchange" not in plan and "LessThanOrEqual(k,1233)" in plan


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9, 13, 14, 15, 30])
def test_limit_of_ties_and_nulls(spark, n):
    rows = [(None, None, "a"), (None, 1, "b"), (1, None, "c"), (1, 2, "d"), (1, 2, "e"), (1, 2, "e"), (1, 2, "e"), (1, 2, "f"),
            (1, 3, None), (2, 0, "g"), (2, 0, "g"), (2, 0, "g"), (2, 0, "h"), (3, 3, "i"), (3, 3, "j")]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    got = sorted(map(tuple, O.limit_n(df, ["a", "b"], n).collect()), key=repr)
    order = [(r.a, r.b, r.c) for r in df.orderBy("a", "b", F.xxhash64("a", "b", "c")).collect()]
    assert got == sorted(order[:n], key=repr)


@pytest.mark.parametrize("width, longest", [(2, 1 << 20), (16, 1 << 48), (1 << 16, 1 << 48), (1 << 16, 1 << 62)])
def test_no_window_holds_more_than_its_share_of_chunks(spark, width, longest):
    """Sparse keys as byte offsets are: every chunk of a level has a bounded number of chunks below it."""
    rng = random.Random(width)
    keys = {rng.randrange(longest) for _ in range(3000)} | set(range(100)) | {longest - 1}
    rows = spark.createDataFrame([("a", k) for k in sorted(keys)], "src string, k long")
    levels = O.chunk_buckets("k", width, longest)
    fan_out = max(width, O.FAN_OUT)
    for low, high in zip(levels, levels[1:]):
        spread = rows.groupBy(high.alias("h")).agg((F.max(low) - F.min(low)).alias("n")).agg(F.max("n")).first()[0]
        assert spread < fan_out
    assert rows.agg(F.max(levels[-1])).first()[0] < fan_out
    got = O.running(rows, "k", levels, ["src"], sums={"n": F.lit(1).cast("long")}, maxes={"last": F.col("k")})
    order = sorted(keys)
    assert {r.k: (r.n, r.last) for r in got.collect()} == {
        k: (i, order[i - 1] if i else None) for i, k in enumerate(order)}
