from textpack.operators import clean, report

SCHEMA = "pair_id long, user string, assistant string"
LONG = "the dog and " * 81 + "big cat"
ROWS = [
    (1, None, "x", "empty"), (2, " \n", "　", "empty"), (3, "é" * 40, "é", "non_english"),
    (4, "12", "34", "non_english"), (5, "dog", "cat", "kept"), (6, "one", "12", "non_english"),
    (7, "the  dog", LONG, "kept"), (8, "the  dog", LONG + " x", "too_long"),
    (9, "é" * 300, LONG * 3, "non_english"),
]


def pairs(spark):
    return spark.createDataFrame([r[:3] for r in ROWS], SCHEMA)


def test_first_reason_wins(spark):
    labelled = clean.with_drop_reason(pairs(spark)).orderBy("pair_id").collect()
    assert [r.drop_reason for r in labelled] == [r[3] for r in ROWS]
    # Rows 7 and 8 sit on the limit of 250 tokens and one above it.
    assert [labelled[i].n_tokens for i in (6, 7)] == [250, 251]
    assert labelled[6].line == f"<|user|>the dog<|assistant|>{LONG}<|end|>"


def test_format_keeps_the_kept(spark):
    kept = clean.format_pairs(pairs(spark))
    assert sorted(r.pair_id for r in kept.collect()) == [5, 7]
    summary = report.filter_report(clean.with_drop_reason(pairs(spark))).first().asDict()
    assert summary == {"kept": 2, "skipped": 7, "empty": 2, "non_english": 4, "too_long": 1}
    assert report.avg_tokens(kept).first()[0] == (250 + 5) / 2
    assert report.avg_tokens(kept.where("false")).first()[0] == 0.0


def test_stories(spark):
    rows = spark.createDataFrame([(2, " b "), (1, None), (3, "\x1f"), (0, "a\n"), (5, "c")],
                                 "doc_id long, text string")
    assert clean.usable_stories(rows, "doc_id", max_rows=2).collect() == [(0, "a"), (2, "b")]
    synth = clean.synth_user_turn(rows, "doc_id").orderBy("doc_id").collect()
    assert [(r.user, r.assistant) for r in synth] == [
        ("Write a short story for me.", t) for t in "abc"]


def test_preview(spark):
    rows = spark.createDataFrame([(i, "u" * 221, "a" * (219 + i)) for i in range(5)], SCHEMA)
    shown = clean.preview_pairs(rows, ["pair_id"]).collect()
    assert [r.pair_id for r in shown] == [0, 1, 2]
    assert {r.user for r in shown} == {"u" * 220}
    assert [r.assistant for r in shown] == ["a" * 219, "a" * 220, "a" * 220 + " ..."]
