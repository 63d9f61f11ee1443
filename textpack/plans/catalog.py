"""Every operator as a query over the tables of a data folder.

Id arrays are spelled as text and wide numbers are cast, so that results compare exactly with
another engine's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.constants import (
    BASE_VOCAB_SIZE,
    CHAT_TOKENS,
    COMMON_WORDS,
    EOS_TOKEN,
    MAX_CHAT_TOKENS,
    SEED,
    VAL_FRACTION,
)
from textpack.functions import text as T
from textpack.functions import tokens as K
from textpack.operators import (
    blocks,
    bpe,
    clean,
    context,
    counts,
    encode,
    ordering,
    pack,
    report,
    vocabulary,
)
from textpack.operators.vocabulary import Vocabulary
from textpack.plans import inputs
from textpack.plans.chat import encode_chat, pack_chat
from textpack.plans.corpus import pack_corpus
from textpack.plans.sources import Source
from textpack.plans.sources import source_pairs as make_pairs
from textpack.session import materialize, scratch_path
from textpack.sources import io
from textpack.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL statements use the same.
MERGES = 8
CONTEXT = 256
CHAT_CONTEXT = 1024
BYTE_LIMIT = 1000
BATCH, EPOCHS, ACCUM = 16, 2, 3
EVAL_BATCH, EVAL_BATCHES = 4, 5
LINE_WIDTH = 256 * inputs.LINES_PER_TURN
LIMIT_ROWS = 500
TOP_K, TEMPERATURE = 5, 0.8
NEW_ROWS, DIM = 12, 64

BYTES = Vocabulary()
CHAT_BYTES = BYTES.with_chat_tokens()
PAIR_ID = ["conv_id", "turn"]


def spell(ids: Column | str) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return ids.cast("string")


def _learn(spark: SparkSession, folder: str, size: int = 257 + MERGES) -> Vocabulary:
    stories = clean.usable_stories(inputs.documents(spark, folder), "doc_id")
    return bpe.train_vocabulary(bpe.piece_counts(stories), size)


def learned(spark: SparkSession, folder: str, size: int = 257 + MERGES) -> Vocabulary:
    """The vocabulary learned from the folder's documents, read from the table it is written to."""
    path = scratch_path(spark, "vocabulary")
    io.save_vocabulary(spark, _learn(spark, folder, size), path)
    return io.load_vocabulary(spark, path)


def _stories(spark: SparkSession, folder: str) -> DataFrame:
    return clean.usable_stories(inputs.documents(spark, folder), "doc_id")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return clean.with_drop_reason(inputs.pairs(spark, folder))


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    return clean.format_pairs(inputs.pairs(spark, folder))


def _encoded_chat(spark: SparkSession, folder: str) -> DataFrame:
    return encode_chat(inputs.pairs(spark, folder), CHAT_BYTES, BYTE_LIMIT, PAIR_ID)


def _chat_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return pack_chat(_encoded_chat(spark, folder), PAIR_ID, CONTEXT)


def _story_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return pack_corpus(inputs.documents(spark, folder), "doc_id", BYTES, CONTEXT)


def _bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return counts.bigram_counts(pack.xy_shift(_story_blocks(spark, folder), CONTEXT))


def _spelled_blocks(blocks_: DataFrame) -> DataFrame:
    return blocks_.withColumn("tokens", spell("tokens"))


# --- sources and sinks ---------------------------------------------------------------------

def scan_corpus(spark, folder):
    return _stories(spark, folder)


def scan_lines(spark, folder):
    return io.lines_of_rows(inputs.documents(spark, folder), "doc_id").withColumn(
        "line_no", F.col("line_no").cast("long"))


def source_fallback(spark, folder):
    found = io.first_readable(
        spark, [f"{folder}/stories.parquet", f"{folder}/documents.parquet"])
    return found.select("doc_id", "text",
                        F.regexp_extract("source", r"([^/]+)\z", 1).alias("source"))


def read_pairs(spark, folder):
    path = scratch_path(spark, "pairs")
    io.write_pairs(inputs.pairs(spark, folder), path)
    return io.read_pairs(spark, path, "conv_id long, turn long")


def write_pairs(spark, folder):
    path = scratch_path(spark, "pairs")
    io.write_pairs(inputs.pairs(spark, folder), path)
    written = spark.read.text(path)
    return written.select(
        *[F.get_json_object("value", f"$.{k}").cast("long").alias(k) for k in PAIR_ID],
        *[F.get_json_object("value", f"$.{k}").alias(k) for k in ("user", "assistant")])


def write_formatted(spark, folder):
    path = scratch_path(spark, "formatted")
    io.write_formatted(_kept(spark, folder), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def write_with_report(spark, folder):
    """The report of the job that writes the formatted lines, beside how many lines it wrote."""
    path = scratch_path(spark, "formatted")
    found = io.write_formatted_reporting(_labelled(spark, folder), path)
    found |= {"avg_tokens": round(found["avg_tokens"], 6), "lines": spark.read.text(path).count()}
    return spark.createDataFrame([found], "kept long, skipped long, empty long, non_english long, too_long long, "
                                          "tokens long, avg_tokens double, lines long")


def read_formatted(spark, folder):
    path = scratch_path(spark, "formatted")
    io.write_formatted(_kept(spark, folder), path)
    return io.read_formatted(spark, path)


def write_packed(spark, folder):
    path = scratch_path(spark, "packed")
    io.write_packed(_chat_blocks(spark, folder), path)
    return _spelled_blocks(io.read_packed(spark, path)).select("split", "block_id", "tokens")


def load_or_build(spark, folder):
    root = scratch_path(spark, "cache")
    arguments = dict(vocabulary=CHAT_BYTES, context_length=CONTEXT, folder=folder, max_tokens=BYTE_LIMIT,
                     seed=SEED, fraction=VAL_FRACTION)

    def build():
        return _chat_blocks(spark, folder)

    io.load_or_build(spark, root, "train", build, **arguments)
    # The second call finds the table.
    found = io.load_or_build(spark, root, "validation", build, **arguments)
    return _spelled_blocks(found).select("split", "block_id", "tokens")


def vocab_tables(spark, folder):
    return learned(spark, folder).vocab_table(spark).withColumn("id", F.col("id").cast("long"))


# --- projections and filters ---------------------------------------------------------------

def py_strip(spark, folder):
    return inputs.documents(spark, folder).select("doc_id", T.py_strip("text").alias("text"))


def collapse_ws(spark, folder):
    return inputs.documents(spark, folder).select("doc_id", T.collapse_ws("text").alias("text"))


def render_chat(spark, folder):
    return clean.clean_pairs(inputs.pairs(spark, folder)).select(
        *PAIR_ID, T.render_chat("user", "assistant").alias("line"))


def ascii_ratio(spark, folder):
    return inputs.documents(spark, folder).select(
        "doc_id", F.round(T.ascii_ratio("text"), 9).alias("ratio"))


def word_set(spark, folder):
    return inputs.documents(spark, folder).select(
        "doc_id", F.array_join(F.array_sort(T.word_set("text")), " ").alias("words"))


def looks_english(spark, folder):
    return inputs.documents(spark, folder).select(
        "doc_id", T.looks_english("text").alias("english"))


def drop_empty_turns(spark, folder):
    return clean.drop_empty_turns(inputs.pairs(spark, folder))


def token_length_filter(spark, folder):
    rendered = clean.clean_pairs(inputs.pairs(spark, folder)).select(
        *PAIR_ID, clean.piece_counter(T.render_chat("user", "assistant")).cast("long")
        .alias("n_tokens"))
    return clean.token_length_filter(rendered, MAX_CHAT_TOKENS)


def _chat_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    return learned(spark, folder).with_chat_tokens()


def token_length_filter_bpe(spark, folder):
    count = clean.bpe_counter(_chat_vocabulary(spark, folder))
    rendered = clean.computed_once(
        clean.clean_pairs(inputs.pairs(spark, folder)).select(*PAIR_ID, T.render_chat("user", "assistant").alias("line")),
        {"n_tokens": count(F.col("line")).cast("long")})
    return clean.token_length_filter(rendered, MAX_CHAT_TOKENS).select(*PAIR_ID, "n_tokens")


def pack_chat_bpe(spark, folder):
    """The chat chain on the learned vocabulary: filter by its tokens, shuffle, split and pack."""
    encoded = encode_chat(inputs.pairs(spark, folder), _chat_vocabulary(spark, folder), BYTE_LIMIT, PAIR_ID)
    return _spelled_blocks(pack_chat(encoded, PAIR_ID, CONTEXT)).select("split", "block_id", "tokens")


def drop_reason(spark, folder):
    return _labelled(spark, folder).select(*PAIR_ID, "drop_reason")


def synth_user_turn(spark, folder):
    return clean.synth_user_turn(inputs.documents(spark, folder), "doc_id")


def preview(spark, folder):
    lines = _kept(spark, folder).withColumn("id", F.struct(*PAIR_ID))
    shown = clean.preview_lines(lines, "id").select("id.*", "line")
    pairs = clean.preview_pairs(inputs.pairs(spark, folder), PAIR_ID)
    return shown.select(*PAIR_ID, F.lit("line").alias("what"), F.col("line").alias("text")) \
        .unionByName(pairs.select(*PAIR_ID, F.lit("user").alias("what"),
                                  F.col("user").alias("text"))) \
        .unionByName(pairs.select(*PAIR_ID, F.lit("assistant").alias("what"),
                                  F.col("assistant").alias("text")))


def render_transcript(spark, folder):
    shown = context.render_transcript(
        inputs.conversations(spark, folder), CHAT_BYTES, CHAT_CONTEXT)
    return shown.withColumn("n_pairs", F.col("n_pairs").cast("long"))


def cut_at_id(spark, folder):
    # The id of the line feed: what comes before the first line break.
    newline = K.byte_ids()[ord("\n")]
    ids = K.encode_ids("text", BYTES)
    return inputs.documents(spark, folder).select("doc_id", ids.alias("ids")).select(
        "doc_id", spell(T.cut_at_id("ids", newline)).alias("ids"))


def strip_eos_text(spark, folder):
    # Documents with the control token in place of every line feed.
    marked = F.replace(F.col("text"), F.lit("\n"), F.lit(EOS_TOKEN))
    return inputs.documents(spark, folder).select("doc_id", T.strip_eos_text(marked).alias("text"))


def seed_empty_prompt(spark, folder):
    # Every document as a prompt, and an empty prompt beside it.
    docs = inputs.documents(spark, folder)
    prompts = docs.select("doc_id", T.py_strip("text").alias("p")).unionByName(
        docs.select("doc_id", F.lit("").alias("p")))
    ids = prompts.select("doc_id", K.encode_ids("p", BYTES).alias("ids"))
    return ids.select("doc_id", spell(T.seed_empty_prompt("ids", BYTES.eos_id)).alias("ids"))


# --- tokens --------------------------------------------------------------------------------

def pretokenize(spark, folder):
    return inputs.documents(spark, folder).select("doc_id", K.pretokenize("text").alias("p")) \
        .select("doc_id", F.size("p").cast("long").alias("n_pieces"),
                F.array_join("p", "\x1f").alias("pieces"))


def byte_alphabet(spark, folder):
    return inputs.documents(spark, folder).select("doc_id", K.byte_text("text").alias("text"))


def piece_counts(spark, folder):
    return bpe.piece_counts(_stories(spark, folder))


def pair_counts(spark, folder):
    symbols = bpe.with_symbols(bpe.piece_counts(_stories(spark, folder)))
    return bpe.pair_counts(symbols).select(
        F.col("lhs").cast("long"), F.col("rhs").cast("long"), "n")


def bpe_train(spark, folder):
    vocab = _learn(spark, folder)
    ids = spark.createDataFrame(
        [(r, a, b, m) for r, (a, b, m) in enumerate(vocab.merges)],
        "rank long, lhs_id long, rhs_id long, merged_id long")
    return ids.join(vocab.merges_table(spark), "rank")


def add_special_tokens(spark, folder):
    return vocabulary.add_special_tokens(learned(spark, folder).vocab_table(spark)).withColumn(
        "id", F.col("id").cast("long"))


def token_to_id(spark, folder):
    vocab = learned(spark, folder).with_chat_tokens().vocab_table(spark)
    return vocabulary.token_ids(vocab, [EOS_TOKEN, *CHAT_TOKENS]).withColumn(
        "id", F.col("id").cast("long"))


def bpe_encode(spark, folder):
    encoded = encode.encode_rows(inputs.documents(spark, folder), learned(spark, folder))
    return encoded.select("doc_id", F.col("n_tokens").cast("long"), spell("ids").alias("ids"))


def assert_vocab_fits(spark, folder):
    vocab = learned(spark, folder).with_chat_tokens().vocab_table(spark)
    return vocabulary.assert_vocab_fits(vocab).select(F.col("vocab_size").cast("long"))


def append_eos(spark, folder):
    encoded = encode.encode_rows(_stories(spark, folder), BYTES, append_eos=True)
    return encoded.select("doc_id", F.col("n_tokens").cast("long"), spell("ids").alias("ids"))


def bpe_decode(spark, folder):
    vocab = learned(spark, folder)
    encoded = encode.encode_rows(inputs.documents(spark, folder), vocab)
    return encoded.select("doc_id", K.decode_ids("ids", vocab).alias("text"))


def roundtrip_check(spark, folder):
    # Its statement spells no merge, so the vocabulary has full size.
    vocab = learned(spark, folder, BASE_VOCAB_SIZE).with_chat_tokens()
    stories = encode.roundtrip_check(inputs.documents(spark, folder), vocab)
    lines = clean.clean_pairs(inputs.pairs(spark, folder)).select(
        T.render_chat("user", "assistant").alias("text"))
    chats = encode.roundtrip_check(lines, vocab)
    controls = encode.special_token_check(vocab, lines).select(
        F.concat(F.lit("control "), "token").alias("what"),
        F.col("n_text").alias("n_rows"), (F.col("n_text") - F.col("n_ids")).alias("n_bad"))
    return stories.withColumn("what", F.lit("documents")).unionByName(
        chats.withColumn("what", F.lit("chat lines"))).unionByName(controls)


# --- aggregations --------------------------------------------------------------------------

def filter_report(spark, folder):
    return report.filter_report(_labelled(spark, folder))


def avg_tokens(spark, folder):
    return report.avg_tokens(_kept(spark, folder)).select(
        F.round("avg_tokens", 6).alias("avg_tokens"))


def _split_lengths(spark, folder):
    lengths = _encoded_chat(spark, folder).select(*PAIR_ID, "n_tokens")
    return ordering.exact_split(lengths, PAIR_ID)


def split_totals(spark, folder):
    return report.split_totals(_split_lengths(spark, folder))


def n_sequences(spark, folder):
    return report.n_sequences(_split_lengths(spark, folder), BATCH, ACCUM, EPOCHS, CONTEXT)


def dataset_manifest(spark, folder):
    encoded = _encoded_chat(spark, folder)
    split = ordering.exact_split(encoded.select(*PAIR_ID, "n_tokens"), PAIR_ID)
    return report.dataset_manifest({
        "pairs": inputs.pairs(spark, folder), "formatted": encoded,
        "train": split.where("split = 'train'"), "val": split.where("split = 'val'"),
    }, CHAT_BYTES.size)


def corpus_count(spark, folder):
    return report.corpus_count(_stories(spark, folder), "stories")


# --- ordered operators ---------------------------------------------------------------------

def parse_blocks(spark, folder):
    return blocks.parse_blocks(inputs.instruction_lines(spark, folder), LINE_WIDTH)


def pair_turns(spark, folder):
    return inputs.pairs(spark, folder)


def seeded_shuffle(spark, folder):
    return ordering.seeded_shuffle(inputs.documents(spark, folder).select("doc_id"), ["doc_id"])


def exact_split(spark, folder):
    return ordering.exact_split(inputs.documents(spark, folder).select("doc_id"), ["doc_id"])


def global_offset(spark, folder):
    lengths = _stories(spark, folder).select(
        "doc_id", (K.byte_count("text", [EOS_TOKEN]) + 1).cast("long").alias("n_tokens"))
    placed = ordering.global_offset(
        ordering.in_ranges(lengths, "doc_id"), "n_tokens", "doc_id", ordering.range_buckets())
    return placed.drop(ordering.RANGE)


def pack_blocks(spark, folder):
    return _spelled_blocks(_story_blocks(spark, folder))


def pack_corpus_bpe(spark, folder):
    packed = pack_corpus(
        inputs.documents(spark, folder), "doc_id", learned(spark, folder), CONTEXT)
    return _spelled_blocks(packed)


def xy_shift(spark, folder):
    shifted = pack.xy_shift(_story_blocks(spark, folder), CONTEXT)
    return shifted.select("block_id", spell("x").alias("x"), spell("y").alias("y"))


def _story_block_ids(spark: SparkSession, folder: str, batch_size: int = 1) -> DataFrame:
    """Block ids of the story corpus, from the lengths of its texts alone."""
    lengths = _stories(spark, folder).select((K.byte_count("text", [EOS_TOKEN]) + 1).alias("n_tokens"))
    return pack.numbered_blocks(spark, pack.block_count(lengths, CONTEXT), batch_size)


def batch_plan(spark, folder):
    return pack.batch_plan(_story_block_ids(spark, folder, BATCH), BATCH, EPOCHS, ACCUM)


def batch_plan_permuted(spark, folder):
    lengths = _stories(spark, folder).select((K.byte_count("text", [EOS_TOKEN]) + 1).alias("n_tokens"))
    return pack.batch_plan_permuted(spark, pack.block_count(lengths, CONTEXT), BATCH, EPOCHS, ACCUM)


def eval_plan(spark, folder):
    return pack.eval_plan(_story_block_ids(spark, folder), EVAL_BATCH, EVAL_BATCHES)


def chat_context(spark, folder):
    shown = context.chat_context(
        inputs.conversations(spark, folder), CHAT_BYTES, CHAT_CONTEXT)
    return shown.select("conv_id", "turn", F.col("n_pairs").cast("long"),
                        spell("ids").alias("ids"))


# --- top-k, set operations -----------------------------------------------------------------

def limit_n(spark, folder):
    return ordering.limit_n(_stories(spark, folder), "doc_id", LIMIT_ROWS)


def topk_ties(spark, folder):
    return _as_long(counts.topk_ties(_bigrams(spark, folder), TOP_K), "x", "y")


def argmax(spark, folder):
    return _as_long(counts.argmax(_bigrams(spark, folder)), "x", "y")


def concat_streams(spark, folder):
    first = inputs.documents(spark, folder).select(F.col("doc_id").alias("key"), "text")
    second = inputs.conversations(spark, folder).select(
        (F.col("conv_id") * F.lit(1 << 20) + F.col("turn")).alias("key"), "text")
    whole = ordering.union_in_order([first, second]).select(
        "part", "key",
        (K.byte_count("text", [EOS_TOKEN]) + 1).cast("long").alias("n_tokens"))
    placed = ordering.running(
        ordering.in_ranges(whole, "part", "key"), F.struct("part", "key"), ordering.range_buckets(),
        sums={"start": F.col("n_tokens")})
    return placed.drop(ordering.RANGE)


def limit_pairs(spark, folder):
    """The first pairs of the line stream, by source and closing line."""
    return ordering.limit_n(parse_blocks(spark, folder), ["src", "end_line"], LIMIT_ROWS)


def source_pairs(spark, folder):
    """Pairs of the first source that opens: the instruction files aren't there, the stories get the default turn."""
    wanted = [Source(f"{folder}/instructions.parquet", "instructions"), Source(f"{folder}/documents.parquet")]
    found = make_pairs(spark, wanted, LIMIT_ROWS, scratch_path(spark, "pairs"))
    return found.withColumn("source", F.regexp_extract("source", r"([^/]+)\z", 1))


def source_pairs_parsed(spark, folder):
    """The same, with the instruction source there."""
    path = scratch_path(spark, "instructions")
    inputs.instruction_lines(spark, folder).write.parquet(path)
    wanted = [Source(f"{path}-missing", "instructions"), Source(path, "instructions"), Source(f"{folder}/documents.parquet")]
    return make_pairs(spark, wanted, LIMIT_ROWS, scratch_path(spark, "pairs"), LINE_WIDTH).drop("source")


def word_intersect(spark, folder):
    common = F.array_intersect(T.word_set("text"), F.array(*[F.lit(w) for w in COMMON_WORDS]))
    return inputs.documents(spark, folder).select(
        "doc_id", F.array_join(F.array_sort(common), " ").alias("words"))


# --- streams -------------------------------------------------------------------------------

def _staged(spark: SparkSession, rows: DataFrame, late: Column, key: str) -> DataFrame:
    """The rows as a folder that grew in two steps, read back as a stream."""
    path = scratch_path(spark, "stream")
    for i, part in enumerate((rows.where(~late), rows.where(late))):
        part.repartition(key).write.mode("append").parquet(f"{path}/step={i}")
    return jobs.read_table_stream(spark, f"{path}/step=*", rows.schema, files_per_batch=16)


def _routed(stream: DataFrame, key: str, hot: list, keyed: Callable, chunked: Callable) -> list[tuple[DataFrame, Callable]]:
    """The job of most keys, and that of hot ones if there are any, each with its part of the stream."""
    if not hot:
        return [(stream, keyed)]
    return [(stream.where(~F.col(key).isin(hot)), keyed), (stream.where(F.col(key).isin(hot)), chunked)]


def stream_format(spark, folder):
    pairs = inputs.pairs(spark, folder)
    out = scratch_path(spark, "out")
    stream = _staged(spark, pairs, F.col("turn") >= 2, "conv_id")
    jobs.stream_format(stream, out, scratch_path(spark, "query")).awaitTermination()
    done = spark.read.parquet(out)
    return done.select(*PAIR_ID, "line", F.col("n_tokens").cast("long"))


def stream_parse_blocks(spark, folder):
    lines = inputs.instruction_lines(spark, folder)
    out = scratch_path(spark, "out")
    # Cut inside blocks: turn 3 is a reply whose request came with the first step.
    stream = _staged(spark, lines, F.col("line_no") >= 3 * inputs.LINES_PER_TURN, "src")
    hot = jobs.hot_keys(lines, "src")
    for i, (part, job) in enumerate(_routed(stream, "src", hot, jobs.stream_parse_blocks, partial(
            jobs.stream_parse_blocks_chunked, width=LINE_WIDTH))):
        job(part, f"{out}/part={i}", scratch_path(spark, "query")).awaitTermination()
    return spark.read.parquet(f"{out}/part=*/batch=*")


def stream_chat_context(spark, folder):
    turns = inputs.conversations(spark, folder)
    out = scratch_path(spark, "out")
    stream = _staged(spark, turns, F.col("turn") >= 3, "conv_id")
    for i, (part, job) in enumerate(_routed(stream, "conv_id", jobs.hot_keys(turns, "conv_id"),
                                            jobs.stream_chat_context, jobs.stream_chat_context_chunked)):
        job(part, CHAT_BYTES, f"{out}/part={i}", scratch_path(spark, "query"), CHAT_CONTEXT).awaitTermination()
    shown = spark.read.parquet(f"{out}/part=*/batch=*")
    return shown.select("conv_id", "turn", F.col("n_pairs").cast("long"),
                        spell("ids").alias("ids"))


# --- next-token statistics -----------------------------------------------------------------

def _as_long(df: DataFrame, *columns: str) -> DataFrame:
    return reduce(lambda d, c: d.withColumn(c, F.col(c).cast("long")), columns, df)


def bigram_counts(spark, folder):
    return _as_long(_bigrams(spark, folder), "x", "y")


def next_token_dist(spark, folder):
    drawn = counts.next_token_dist(_bigrams(spark, folder), TEMPERATURE, TOP_K, BYTES.size)
    return _as_long(drawn, "x", "y").withColumn("p", F.round("p", 6))


def heldout_loss(spark, folder):
    packed = materialize(_chat_blocks(spark, folder), "blocks")
    train = pack.xy_shift(packed.where("split = 'train'"), CONTEXT)
    val = packed.where("split = 'val'").drop("split")
    chosen = val.join(pack.eval_plan(val.select("block_id"), EVAL_BATCH, EVAL_BATCHES),
                      "block_id")
    loss = counts.heldout_loss(
        counts.bigram_counts(train), pack.xy_shift(chosen, CONTEXT), CHAT_BYTES.size)
    return loss.select(F.round("loss", 6).alias("loss"), "n_tokens")


def resize_embeddings(spark, folder):
    old = inputs.embeddings(spark, folder)
    # A dozen rows more than the table has, as when control tokens are added.
    size = old.agg(F.max("id")).first()[0] + 1 + NEW_ROWS
    new = counts.resize_embeddings(old, size, DIM)
    cells = new.select("id", F.posexplode("embedding").alias("dim", "value"))
    return cells.select("id", F.col("dim").cast("long"),
                        F.round(F.col("value").cast("double"), 5).alias("value"))


# --- the vocabulary of full size: no statement spells thousands of merges, so these are tested against a library ----

_full_vocabularies: dict[tuple[str, str], str] = {}


def full_vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    """BASE_VOCAB_SIZE tokens learned from the folder's stories, and the chat tokens.

    Learned by the first query of an application that asks, into a table that the others read.
    """
    key = spark.sparkContext.applicationId, folder
    if key not in _full_vocabularies:
        path = scratch_path(spark, "full-vocabulary")
        io.save_vocabulary(spark, bpe.train_vocabulary(bpe.piece_counts(_stories(spark, folder)), BASE_VOCAB_SIZE), path)
        _full_vocabularies[key] = path
    return io.load_vocabulary(spark, _full_vocabularies[key]).with_chat_tokens()


def bpe_train_full(spark, folder):
    return full_vocabulary(spark, folder).vocab_table(spark).withColumn("id", F.col("id").cast("long"))


def bpe_encode_full(spark, folder):
    encoded = encode.encode_rows(inputs.documents(spark, folder), full_vocabulary(spark, folder))
    return encoded.select("doc_id", F.col("n_tokens").cast("long"), spell("ids").alias("ids"))


def _encoded_chat_full(spark: SparkSession, folder: str) -> DataFrame:
    return encode_chat(inputs.pairs(spark, folder), full_vocabulary(spark, folder), MAX_CHAT_TOKENS, PAIR_ID)


def pack_chat_full(spark, folder):
    packed = pack_chat(_encoded_chat_full(spark, folder), PAIR_ID, CONTEXT)
    return _spelled_blocks(packed).select("split", "block_id", "tokens")


def dataset_manifest_full(spark, folder):
    encoded = _encoded_chat_full(spark, folder)
    split = materialize(ordering.exact_split(encoded.select(*PAIR_ID, "n_tokens"), PAIR_ID), "split")
    return report.dataset_manifest({
        "pairs": inputs.pairs(spark, folder), "formatted": encoded,
        "train": split.where("split = 'train'"), "val": split.where("split = 'val'"),
    }, full_vocabulary(spark, folder).size)


def chat_context_full(spark, folder):
    shown = context.chat_context(inputs.conversations(spark, folder), full_vocabulary(spark, folder), CONTEXT)
    return shown.select("conv_id", "turn", F.col("n_pairs").cast("long"), spell("ids").alias("ids"))


def render_transcript_full(spark, folder):
    shown = context.render_transcript(inputs.conversations(spark, folder), full_vocabulary(spark, folder), CONTEXT)
    return shown.withColumn("n_pairs", F.col("n_pairs").cast("long"))


def full_size() -> dict[str, Query]:
    """Queries on the vocabulary of full size."""
    listed = [bpe_train_full, bpe_encode_full, pack_chat_full, dataset_manifest_full, chat_context_full, render_transcript_full]
    return {q.__name__: q for q in listed}


def check_embeddings(spark, folder):
    """The embedding table, resized to the learned vocabulary with its control tokens, fits that vocabulary."""
    vocab = learned(spark, folder).with_chat_tokens()
    resized = counts.resize_embeddings(inputs.embeddings(spark, folder), vocab.size, DIM)
    return counts.check_embeddings(resized, vocab.vocab_table(spark))


def queries() -> dict[str, Query]:
    listed = [
        scan_corpus, scan_lines, source_fallback, read_pairs, write_pairs, write_formatted, write_with_report,
        read_formatted, write_packed, load_or_build, vocab_tables,
        py_strip, collapse_ws, render_chat, ascii_ratio, word_set, looks_english,
        drop_empty_turns, token_length_filter, token_length_filter_bpe, drop_reason, synth_user_turn, preview,
        render_transcript, cut_at_id, strip_eos_text, seed_empty_prompt,
        pretokenize, byte_alphabet, piece_counts, pair_counts, bpe_train, add_special_tokens,
        token_to_id, bpe_encode, assert_vocab_fits, append_eos, bpe_decode, roundtrip_check,
        filter_report, avg_tokens, split_totals, n_sequences, dataset_manifest, corpus_count,
        parse_blocks, pair_turns, seeded_shuffle, exact_split, global_offset, pack_blocks,
        pack_corpus_bpe, pack_chat_bpe, xy_shift, batch_plan, batch_plan_permuted, eval_plan, chat_context,
        limit_n, limit_pairs, source_pairs, source_pairs_parsed, topk_ties, argmax, concat_streams, word_intersect,
        stream_format, stream_parse_blocks, stream_chat_context,
        bigram_counts, next_token_dist, heldout_loss, resize_embeddings, check_embeddings,
    ]
    return {q.__name__: q for q in listed}
