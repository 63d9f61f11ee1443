"""Spelling variants, found by walking a trie of all words level by level.

The trie is a distributed table of edges (node, letter, child); a node is known by the hash of its prefix. A state
(word, position, node, edits) says that ``node`` was reached with so many edits by the first ``position`` letters of the
word. One level joins all states with the edges below their nodes: without an edit a word follows its own path, and
at each node may leave out its next letter or take a later letter of the alphabet instead; with one edit only the
next letter itself goes on. Each pair is met once this way (an insertion is the other word's omission, a
replacement goes from the smaller letter to the larger) and is then turned round. A state that reaches a word with its last letter and one edit is a
neighbour. Below a node with a single word nothing branches, so the rest is compared at once, and words whose prefix
nobody shares leave the walk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpack.session import materialize

#: Letters of a word. A-Z are lower-cased, so a word has at most 26 + 64 different ones.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Levels walked in one job: their edges are broadcast, at most 90 ** 3 rows, however many words there are.
TOP_LEVELS = 3


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """``key, run``: every maximal run of letters of at least ``least_length``, A-Z lower-cased. A null text has none."""
    pattern = f"[{LETTERS}]{{{least_length},}}"
    found = docs.select(F.col(key).alias("key"), F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    return found.select("key", lower.alias("run"))


def with_lost_letters(found: DataFrame, every: int) -> DataFrame:
    """``word`` of each run: of those whose CRC with the key is a multiple of ``every``, one letter is left out.
    A null key counts as an empty one."""
    h = F.crc32(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough; counted before the shuffle."""
    long_enough = words.where(F.length("word") >= least_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def trie(words: DataFrame) -> DataFrame:
    """Edges of the trie of ``(wid, word)``: ``depth, node, letter, child``, how many words lie below the child
    (``below``), the word that ends there if any (``end``), and if only one lies below, that word (``only``) and the hash of what
    follows of it (``rest``)."""
    depth = F.col("depth")
    letters = words.select("wid", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("depth"))
    edges = letters.select(
        "depth", F.xxhash64(F.substring("word", F.lit(1), depth)).alias("node"),
        F.substring("word", depth + 1, F.lit(1)).alias("letter"),
        F.xxhash64(F.substring("word", F.lit(1), depth + 1)).alias("child"),
        F.when(F.length("word") == depth + 1, F.col("wid")).alias("end"), "wid", _rest(depth + 1).alias("rest"))
    return edges.groupBy("depth", "node", "letter", "child").agg(
        F.count("*").alias("below"), F.max("end").alias("end"), F.min("wid").alias("only"), F.min("rest").alias("rest"))


def _rest(pos: Column) -> Column:
    return F.xxhash64(F.substring("word", pos + 1, F.length("word")))


def _arrived(moved: DataFrame, pos: Column, was: Column | None = None) -> DataFrame:
    """States with one edit that have followed an edge; ``hit`` is the neighbour that one has reached.
    Those that had reached one before (``was``) have followed none and stay as they are."""
    was = F.lit(None).cast("long") if was is None else was
    ended = pos == F.length("word")
    now = F.when(ended, F.col("end")).when((F.col("below") == 1) & (_rest(pos) == F.col("rest")), F.col("only"))
    rows = moved.withColumns({"at": pos, "found": F.coalesce(was, now)})
    alive = F.col("found").isNotNull() | (~ended & (F.col("below") > 1))
    return rows.where(alive).select("wid", "word", F.col("at").alias("pos"), F.coalesce("child", "node").alias("node"),
                                    F.col("found").alias("hit"))


def _edits(own: DataFrame, edges: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Words without an edit at a level: those still on their own path, and what one edit makes of them."""
    moved = own.drop("end").join(edges, "node")
    mine, following = (F.substring("word", level + k, 1) for k in (1, 2))
    stay = moved.where((F.col("letter") == mine) & (F.col("below") > 1) & (F.length("word") > level + 1)).select(
        "wid", "word", F.col("child").alias("node"), "end")
    places = F.array(F.when(F.col("letter") > mine, level + 1),
                     F.when((F.col("letter") == following) & (following != mine), level + 2))
    edited = _arrived(moved.withColumn("to", F.explode(F.array_compact(places))), F.col("to"))
    # Without its last letter the word is the node it stands on.
    short = own.where((F.length("word") == level + 1) & F.col("end").isNotNull()).select(
        "wid", "word", F.lit(level + 1).alias("pos"), "node", F.col("end").alias("hit"))
    return stay, edited.unionByName(short)


def neighbours(words: DataFrame) -> DataFrame:
    """``(a, b)``: wids of all pairs of ``(wid, word)`` that differ in exactly one inserted, left out or replaced letter; each pair once.

    Takes as many levels as the longest prefix that two words share. Hash collisions can only add candidates, which
    are compared in full at the end.
    """
    table = materialize(trie(words).sortWithinPartitions("depth"), "trie")

    def edges(level: int) -> DataFrame:
        rows = table.where(F.col("depth") == level).drop("depth")
        return F.broadcast(rows) if level < TOP_LEVELS else rows

    def followed(states: DataFrame, level: int, how: str) -> DataFrame:
        """States with an edit after the next letter; those that have hit go through an outer join untouched."""
        wanted = F.when(F.col("hit").isNull(), F.substring("word", F.col("pos") + 1, F.lit(1))).alias("letter")
        asked = states.select("wid", "word", "pos", "node", F.col("hit").alias("was"), wanted)
        moved = asked.join(edges(level), ["node", "letter"], how)
        return _arrived(moved, F.col("pos") + 1, F.col("was"))

    own = words.select("wid", "word", F.xxhash64(F.lit("")).alias("node"), F.lit(None).cast("long").alias("end"))
    own, states = _edits(own, edges(0), 0)
    for level in range(1, TOP_LEVELS):
        own, edited = _edits(own, edges(level), level)
        states = followed(states, level, "left").unionByName(edited)
    own, states = materialize(own, "own"), materialize(states, "states")
    found, level = [states], TOP_LEVELS
    while not (own.isEmpty() and states.where("hit IS NULL").isEmpty()):
        on_path, edited = _edits(own, edges(level), level)
        states = materialize(followed(states.where("hit IS NULL"), level, "inner").unionByName(edited), "states")
        own = materialize(on_path, "own")
        found.append(states)
        level += 1
    pairs = reduce(DataFrame.unionByName, found).where("hit IS NOT NULL").select(
        F.col("wid").alias("a"), F.col("hit").alias("b"), F.col("word").alias("left"))
    right = words.select(F.col("wid").alias("b"), F.col("word").alias("right"))
    return pairs.join(right, "b").where(F.levenshtein("left", "right", 1) == 1).select("a", "b").distinct()


def group(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``(word, n)``, which must be distinct.

    ``form`` is the neighbour of largest ``n`` (ties: the smallest in code-point order) if that is at least ``ratio`` times the word's
    own, else null; ``root`` is where following forms ends. An empty table gives none.
    """
    words = materialize(counts.select("word", "n", F.monotonically_increasing_id().alias("wid")), "words")
    pairs = materialize(neighbours(words.select("wid", "word")), "neighbours")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("wid").alias("b"), F.struct((-F.col("n")).alias("less"), "word").alias("other"))
    best = both.join(other, "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    joined = words.join(best.withColumnRenamed("a", "wid"), "wid", "left")
    enough = -F.col("best.less") >= F.col("n") * ratio
    formed = materialize(joined.select(
        "word", F.when(enough, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    # A form has at least ``ratio`` times the count, so chains are short; each round doubles what is followed.
    roots = materialize(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        found = materialize(roots.join(above, "root", "left"), "roots")
        roots = found.select("word", F.coalesce("higher", "root").alias("root"))
        if found.where("higher IS NOT NULL").isEmpty():
            break
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
