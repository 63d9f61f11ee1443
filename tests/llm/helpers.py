"""Small tables with awkward rows."""

import random
import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use for their own columns.
CLASHES = ["id", "score", "kept", "fp", "digest", "n_words", "row", "host", "_kept", "_leaked", "_key"]


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, stock=("the", "of", "lamp", "river", "stone", "élan", "so", "much", "paper", "walks")):
    draw = random.Random(seed)
    return " ".join(draw.choice(stock) + (str(draw.randrange(50)) if draw.random() < 0.6 else "") for _ in range(n))


def table(spark, rows, clashes=True, key="doc_id", text="text"):
    """Rows of key and text, with further columns named like those of operators."""
    more = [c for c in CLASHES if clashes and c not in (key, text)]
    schema = StructType([StructField(key, LongType()), StructField(text, StringType()),
                         *(StructField(c, StringType()) for c in more)])
    return spark.createDataFrame([(k, t, *("x" if i else None for i, _ in enumerate(more))) for k, t in rows], schema)


def odd_rows():
    """Null key, null, empty and blank text, one long text, repeated rows, a tie of keys."""
    long = prose(9, 30_000)
    return [(None, prose(1, 80)), (1, None), (2, ""), (3, " \t\n "), (4, long), (5, prose(1, 80)), (5, prose(1, 80)),
            (6, prose(2, 70)), (6, prose(3, 70)), (7, "one"), (8, "two words"), (9, "x" * 5000)]


def by_row(rows):
    return sorted(rows, key=repr)
