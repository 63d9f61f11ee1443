from pyspark.sql import functions as F

from textpack.functions import text as T

SPACES = [chr(i) for i in range(0x110000) if chr(i).isspace()]


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in rows.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def test_whitespace_is_pythons(spark):
    assert len(SPACES) == 29
    texts = [f"{s}a{s}{s}b {s}c{s}" for s in SPACES]
    texts += ["", "".join(SPACES), " ", "a", "​a​", "﻿ b", "a\n\n b"]
    assert column(spark, texts, T.py_strip) == [t.strip() for t in texts]
    assert column(spark, texts, T.collapse_ws) == [" ".join(t.split()) for t in texts]
    assert column(spark, [None], T.clean) == [""]


# Texts and whether they look English.
VERDICTS = [
    (None, False), ("", False), ("   ", False), ("the", False), ("the and", True), ("THE And", True), ("the the", False),
    ("the zebra", False), ("the dog", False), ("zebra dog", False),
    ("one two three four", False), ("one two three four five", True), ("one two three four four", False),
    ("zip zap zop zup zep", True), ("zip zap zop zup zip", False), ("1 2 3 4 5", False), ("a1b2c3d4e", True),
    ("it's can't won't don't", False), ("x it's can't won't don't", True),
    ("the and " + "x" * 11 + "\u00e9", True),  # 19 of 20 code points are ASCII
    ("the and " + "x" * 10 + "\u00e9", False),  # 18 of 19
    ("the and \U0001f600", False), ("\u00fcber die \u00e9l\u00e8ves", False),
    ("the and " + "y " * 40 + "\u212a", True)]


def test_looks_english(spark):
    assert column(spark, [t for t, _ in VERDICTS], T.looks_english) == [v for _, v in VERDICTS]


def test_more_ascii_words_never_hurt(spark):
    texts = [t for t, v in VERDICTS if v]
    assert all(column(spark, [f"{t} more plain words" for t in texts], T.looks_english))


def test_ascii_ratio(spark):
    assert column(spark, ["", "aé", "a\U0001f600bc", "é"], T.ascii_ratio) == [None, 0.5, 0.75, 0.0]


def test_ellipsis(spark):
    assert column(spark, ["abc", "abcd", "é\U0001f600xy"], lambda t: T.ellipsis(t, 3)) == [
        "abc", "abc ...", "é\U0001f600x ..."]
    assert column(spark, ["abcd"], lambda t: T.ellipsis(t, 3, mark=False)) == ["abc"]


def test_id_lists(spark):
    rows = spark.createDataFrame([([1, 2, 3],), ([2],), ([],), ([5, 6],)], "ids array<int>")
    assert [r[0] for r in rows.select(T.cut_at_id("ids", 2)).collect()] == [[1], [], [], [5, 6]]
    assert [r[0] for r in rows.select(T.seed_empty_prompt("ids", 7)).collect()][2] == [7]
    assert [r[0] for r in rows.select(T.seed_empty_prompt("ids", None)).collect()][2] == [0]


def test_strip_eos_text(spark):
    assert column(spark, [" a<|endoftext|> b <|endoftext|> "], T.strip_eos_text) == ["a b"]
