"""Operators over documents, against brute force on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textpack.llm import bpe, decontam, packing, quality, secrets, simhash, substring, toxicity, words
from textpack.session import scratch_path
from tests.llm.helpers import by_row, odd_rows, prose, table, words as split

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# Words and pieces

@given(st.lists(st.text(alphabet="ab é\t\n\x0b\x1c\x85 漢", max_size=12), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    raw, bounds = words.buffers_of(pa.array(texts, pa.string()))
    starts, lengths, first = words.word_spans(raw, bounds)
    found = [bytes(raw[s:s + n]).decode() for s, n in zip(starts, lengths)]
    assert found == [w for t in texts for w in split(t)]
    assert np.diff(first).tolist() == [len(split(t)) for t in texts]


@given(st.lists(st.text(alphabet="aBs'tre vml d1٣é漢🙂\u00a0\u3000\n\t!-<|>", max_size=25), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_encoding_is_that_of_the_library(texts):
    ids, counts = bpe.coder(PATH).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [
        e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", [
    "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|", "aaaa" * 200, "=" * 700, "\r\n \r\n", "ing" * 40])
def test_encoding_of_control_tokens_and_long_pieces(text):
    assert bpe.coder(PATH).encode(pa.array([text]))[0].tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_exact_path_gives_the_same():
    texts = pa.array([prose(4, 200), "", "a<|endoftext|>"])
    plain, exact = (bpe.coder(PATH)._encode(texts, exact=e) for e in (False, True))
    assert plain[0].tolist() == exact[0].tolist() and plain[1].tolist() == exact[1].tolist()


def test_bpe_round_trip(spark):
    rows = odd_rows()
    docs = table(spark, rows)
    found = by_row(tuple(r) for r in bpe.digests(docs, PATH).collect())
    expected = []
    for key, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        expected.append((key, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    assert found == by_row(expected)
    decoded = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert by_row(tuple(r) for r in decoded.collect()) == by_row((k, t or "") for k, t in rows)
    assert bpe.digests(docs.limit(0), PATH).count() == 0


# Packed ids

@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000)
    for n in (0, 1, 63, 64, 65, 1000):
        assert packing.unpack(packing.pack(ids[:n], bits), bits, n).tolist() == ids[:n].tolist()
    assert packing.pack(ids[:64], bits).nbytes == 8 * bits


def test_files_hold_all_ids_in_order(spark):
    rows = odd_rows()
    folder = scratch_path(spark, "ids-test")
    manifest = packing.write_ids(table(spark, rows), PATH, folder)
    found = [tuple(r) for r in packing.read_ids(manifest, folder).orderBy("start").collect()]
    start, expected = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected
    assert packing.round_trip(table(spark, []), PATH).count() == 0


def test_rows_of_one_key_are_several_ranges(spark):
    rows = [(None if i % 2 else 7, f"text {i * 7919 % 1000:03d}") for i in range(400)]
    folder = scratch_path(spark, "ids-test")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one range
    try:
        manifest = packing.write_ids(table(spark, rows), PATH, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.where("n_docs > 0").count() > 2 and manifest.agg(F.max("n_docs")).first()[0] < 200
    found = [r.n_tokens for r in packing.read_ids(manifest, folder).orderBy("start").collect()]
    assert found == [len(LIBRARY.encode(t).ids) + 1 for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[1]))]


def test_any_ids_can_be_read_alone(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50257, 20_000)
    with pa.OSFile(str(tmp_path / "f"), "wb") as stream:
        writer = packing.IdWriter(stream, 16)
        writer.add(pa.array([3, None]), ids, np.array([15_000, 5_000]))
        writer.close()
    with pa.OSFile(str(tmp_path / "f"), "rb") as file:
        reader = packing.IdReader(file)
        for start, n in ((0, 1), (4095, 2), (12_345, 5000), (19_999, 1)):
            assert reader.ids(start, n).tolist() == ids[start:start + n].tolist()
    (tmp_path / "cut").write_bytes((tmp_path / "f").read_bytes()[:-3])
    with pytest.raises(ValueError):
        packing.IdReader(pa.OSFile(str(tmp_path / "cut"), "rb"))


# Substrings

def deduplicated(rows, window):
    first = {}
    last = (1 << 63) - 1
    for key, text in rows:
        w = split(text)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, last), last if key is None else key)
    out = []
    for key, text in rows:
        w = split(text)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (last if key is None else key):
                gone[p:p + window] = [True] * window
        out.append((key, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return by_row(out)


def shared_passages():
    passage, rows = prose(5, 90), odd_rows()
    for i in range(40):
        rows.append((100 + i, f"{prose(50 + i, 30)} {passage} {prose(90 + i, i)}"))
    rows += [(200 + i, prose(7, 120).replace("lamp", f"lamp{i}", 1)) for i in range(20)]
    rows += [(230, " ".join(["Is onhe."] * 200)), (231, " ".join(["Is onhe."] * 90))]
    return rows


@pytest.mark.parametrize("many", [500, 3])
def test_substrings(spark, monkeypatch, many):
    monkeypatch.setattr(substring, "MANY", many)
    monkeypatch.setattr(substring, "SHARD_WORDS", 2000)
    rows = shared_passages()
    found = substring.deduplicate(table(spark, rows))
    assert by_row(tuple(r) for r in found.collect()) == deduplicated(rows, 50)


def test_substrings_of_nothing(spark):
    assert substring.deduplicate(table(spark, [])).count() == 0


# Secrets

@pytest.mark.parametrize("text, spans", [
    ("password=abcdef123456", [(0, 21, "assign")]),
    ("API_KEY: 'ABCDEF123456+/'", [(0, 24, "assign")]),
    ("password: token:abcdefghijklmnop", []),  # the first match takes the word token and fails
    ("password=short", []),
    ("é AKIA0123456789ABCD", [(2, 20, "access")]),
    ("AKIA012345678 AKIAAKIA0123456789", [(14, 32, "access")]),
    ("0123456789abcdef 0123456789abcde", [(0, 16, "hex")]),
    ("token=0123456789abcdef", [(0, 22, "assign"), (6, 22, "hex")]),
    ("pa\u017f\u017fword=abcdef123456", []), ("", [])])
def test_fixed_patterns(text, spans):
    assert [(a, b, k) for a, b, k, _ in secrets.base_spans(text)] == spans


def key_like(seed):
    draw = random.Random(seed)
    return "".join(draw.choice("0123456789abcdef") for _ in range(40))


class SlowState:
    """Knows all strings that were read from it on, and nothing else."""

    def __init__(self):
        self.strings, self.moves = [], {}

    def add(self, string):
        self.strings.append(string)
        if string:
            self.moves.setdefault(string[0], SlowState()).add(string[1:])

    def share(self, of):
        """How many of the strings end here, or go on with a class."""
        return sum(s[:1] == of for s in self.strings)


def slow_compatible(a, b):
    n1, n2 = len(a.strings), len(b.strings)
    if min(n1, n2) < secrets.LEAST_VISITS:
        return True
    bound = math.sqrt(0.5 * math.log(2 / secrets.ALPHA)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    symbols = ["", *map(str, range(secrets.N_CLASSES))]
    if any(abs(a.share(x) / n1 - b.share(x) / n2) > bound for x in symbols if x == "" or a.share(x) or b.share(x)):
        return False
    return all(a.moves[x] is b.moves[x] or slow_compatible(a.moves[x], b.moves[x]) for x in a.moves if x in b.moves)


def slow_automaton(strings):
    """Kept states in order, by reading strings anew for every merge."""
    kept = [SlowState()]
    for s in strings:
        kept[0].add(s)
    at = 0
    while at < len(kept):
        for c in sorted(kept[at].moves):
            state = kept[at].moves[c]
            if any(state is k for k in kept):
                continue
            same = next((k for k in kept if slow_compatible(k, state)), None)
            if same is None:
                kept.append(state)
            else:
                kept[at].moves[c] = same
                for s in list(state.strings):
                    same.add(s)
        unknown = any(all(t is not k for k in kept) for k in kept[:at + 1] for t in k.moves.values())
        at = 0 if unknown else at + 1
    return kept


@pytest.mark.parametrize("seed", range(8))
def test_automata_are_those_of_a_slow_merge(seed):
    draw = random.Random(seed)
    kinds = [lambda: "".join(draw.choice("01") for _ in range(draw.randrange(12, 20))),
             lambda: "2" * 3 + "".join(draw.choice("012") for _ in range(8)),
             lambda: "".join(draw.choice(("01", "20", "3")) for _ in range(draw.randrange(4, 9)))]
    strings = [draw.choice(kinds[:1 + seed % 3])() for _ in range(draw.choice((0, 1, 40, 250)))]
    automaton, slow = secrets.Automaton(strings), slow_automaton(strings)
    assert len(automaton.kept) == len(slow)
    for state, other in zip(automaton.kept, slow):
        assert automaton.visits[state] == len(other.strings) and automaton.ends[state] == other.share("")
        assert {str(c): n for c, n in automaton.passes[state].items()} == {c: other.share(c) for c in other.moves}
        assert {str(c): automaton.kept.index(t) for c, t in automaton.moves[state].items()} == {
            c: next(i for i, k in enumerate(slow) if k is t) for c, t in other.moves.items()}
    text, table = "".join(draw.choice("0123") for _ in range(15)), automaton.table()
    state, total = slow[0] if slow else None, 0.0
    for c in text:
        logs = [math.log(state.share(str(x)) + secrets.ADDED) for x in range(secrets.N_CLASSES)] if state else None
        if state is None:
            total += table[-1][0][int(c)]
            continue
        total += logs[int(c)] - math.log(len(state.strings) + secrets.ADDED * (secrets.N_CLASSES + 1))
        state = state.moves.get(c)
    if state:
        total += math.log(state.share("") + secrets.ADDED) - math.log(len(state.strings) + secrets.ADDED * (secrets.N_CLASSES + 1))
    else:
        total += table[-1][0][secrets.END]
    assert secrets.log_likelihood(table, text) == pytest.approx(total)


def slow_base_spans(text):
    """By trying every start; one kind after the other."""
    found = []
    for kind, pattern, fits in (
            ("assign", r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
                       r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[1]) >= 12),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)):
        at = 0
        while at < len(text):
            m = re.compile(pattern).match(text, at)
            if m and fits(m):
                found.append((m.start(), m.end(), kind))
            at = m.end() if m else at + 1
    return sorted(found, key=lambda f: (f[0], ("assign", "access", "hex").index(f[2])))


@given(st.lists(st.sampled_from(["password", "PassWd", "api_key", "APIKEY", "token", "secret", "AKIA", "=", ": ", "'", '"', " ", "\n", "é",
                                 "0123456789", "abcdef", "ABCDEF12345678", "x", "-", "\u212a"]), max_size=14).map("".join))
@settings(max_examples=300, deadline=None)
def test_fixed_patterns_by_brute_force(text):
    assert [(a, b, k) for a, b, k, _ in secrets.base_spans(text)] == slow_base_spans(text)


def test_formats_tell_keys_from_words():
    ordinary = [prose(i, 3, ("andonheonly", "thetionwhich", "streedlyso")).replace(" ", "") for i in range(300)]
    formats = secrets.Formats({"assign": [key_like(i) for i in range(300)], "access": [], "hex": [], "format": ordinary})
    text = f"see {key_like(1000)[:9]}g{key_like(1001)[:25]} andonheonlythetionwhich"
    assert secrets.base_spans(text)[0][2] == "hex"
    assert len(formats.tables[0]) < 60  # merged: the prefix tree has thousands of states
    assert formats.ratio("01" * 12) > formats.threshold > formats.ratio("12" * 12)


def test_scan_and_redact(spark):
    rows = odd_rows() + [(20, "x password=abcdef123456 y"), (21, "AKIA0123456789ABCD"), (21, "AKIA0123456789ABCD")]
    docs = table(spark, rows)
    formats = secrets.learn(docs)
    found = secrets.scan(docs, formats).select("doc_id", secrets.joined("found", secrets.KINDS))
    expected = [(k, ",".join(f"{c}:{a}:{b}" for a, b, c, _ in secrets.base_spans(t or ""))) for k, t in rows]
    assert by_row(tuple(r) for r in found.collect()) == by_row(expected)
    clean = secrets.redact(docs, formats)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert [r.text for r in clean.where("doc_id = 20").collect()] == ["x [assign] y"]
    assert clean.where("doc_id = 1 AND text IS NULL").count() == 1
    assert secrets.scan(docs.limit(0), secrets.learn(docs.limit(0))).count() == 0


@pytest.mark.parametrize("n_bare", [1, 60])
def test_bare_keys_are_found_among_the_words(spark, n_bare):
    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    keys = ["".join(draw.choice(letters) for _ in range(32)) for _ in range(300 + n_bare)]
    parts = ("and", "on", "he", "only", "tion", "which", "streed", "ly", "lamp", "river", "the", "ed")
    rows = [(i, f"word {''.join(draw.choice(parts) for _ in range(6))} token={k}") for i, k in enumerate(keys[:300])]
    rows += [(300 + i, f"see {k} there") for i, k in enumerate(keys[300:])]
    docs = table(spark, rows)
    formats = secrets.learn(docs)
    found = {r.doc_id: [(s.start, s.end, s.kind) for s in r.found] for r in secrets.scan(docs, formats).collect()}
    assert sum(found[300 + i] == [(4, 36, "format")] for i in range(n_bare)) >= 0.9 * n_bare
    assert sum(any(s[2] == "format" for s in found[i]) for i in range(300)) <= 3


def listed_values(texts):
    """All distinct strings by kind, in the order that halves are taken by."""
    found = {kind: set() for kind in (*secrets.KINDS, secrets.FORMAT)}
    for text in texts:
        spans = secrets.base_spans(text)
        for _, _, kind, value in spans:
            found[kind].add(value)
        found[secrets.FORMAT].update(m[0] for m in secrets.candidates(text, spans))
    return {kind: sorted(v, key=lambda s: (secrets.xxhash.xxh64_intdigest(s) >> 1, s)) for kind, v in found.items()}


def mixed_texts(n):
    draw = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    parts = ("and", "on", "he", "only", "tion", "which", "streed", "ly", "lamp", "river", "the", "ed", "A", "x-", "/", "4")
    key, word = (lambda: "".join(draw.choice(letters) for _ in range(draw.choice((14, 16))))), (lambda: "".join(
        draw.choice(parts) for _ in range(draw.randrange(4, 7))))
    return [f"{word()} token={key()} {word()} {draw.choice(('', key_like(i), key()))}" for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 150, 2300])
def test_formats_are_those_of_lists_of_all_strings(spark, monkeypatch, n):
    texts = mixed_texts(n)
    if n > 2000:  # every prefix is a state before merging, as with fewer strings
        monkeypatch.setattr(secrets, "PREFIX_SHARE", 1 << 20, raising=False)
    formats = secrets.learn(table(spark, list(enumerate(texts)) + [(n, texts[0])]))
    listed = secrets.Formats(listed_values(texts))
    assert formats.tables == listed.tables and formats.ordinary == listed.ordinary


def test_automata_count_all_strings_whole(spark):
    """More strings than prefixes can be told apart by, and strings longer than such prefixes."""
    texts = mixed_texts(2300) + [f"secret: {prose(i, 60).replace(' ', '').replace('é', 'e')}" for i in range(5)]
    strings = secrets.labelled_strings(table(spark, list(enumerate(texts))))
    total, values = secrets.sizes(strings), listed_values(texts)
    assert total == {kind: len(v) for kind, v in values.items() if v} and total["assign"] > 2000
    made = secrets.automata(strings, total, [(k, p) for k in ("assign", "hex") for p in (secrets.WHOLE, secrets.EVEN, secrets.ODD)])
    for (kind, part), automaton in made.items():
        own = values[kind][{secrets.ODD: 1}.get(part, 0)::1 if part == secrets.WHOLE else 2]
        counts, machine = [[0] * (secrets.END + 1) for _ in automaton.kept], automaton.machine()
        for value in own:
            state = 0
            for c in value.translate(secrets._TO_CLASSES):
                counts[state][int(c)] += 1
                state = machine[state][int(c)]
            counts[state][secrets.END] += 1
        assert sum(row[secrets.END] for row in counts) == len(own)
        for row, state in zip(counts, automaton.kept):
            assert automaton.visits[state] == sum(row) and automaton.ends[state] == row[secrets.END]
            assert automaton.passes[state] == {c: n for c, n in enumerate(row[:secrets.END]) if n}


def test_long_keys_are_learned_from(spark):
    draw = random.Random(15)
    keys = ["".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(150)) for _ in range(220)]
    parts = ("and", "on", "he", "only", "tion", "which", "streed", "ly", "lamp", "river", "the", "ed")
    rows = [(i, f"word {''.join(draw.choice(parts) for _ in range(6))} token={k}") for i, k in enumerate(keys[:200])]
    docs = table(spark, rows + [(200 + i, f"see {k} there") for i, k in enumerate(keys[200:])])
    found = {r.doc_id: [tuple(s) for s in r.found] for r in secrets.scan(docs, secrets.learn(docs)).collect()}
    assert sum(found[200 + i] == [(4, 154, "format")] for i in range(20)) >= 18


# Toxicity

def test_toxicity_learns_sentences(spark):
    draw = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        sentences = [prose(1000 * i + j, draw.randrange(4, 9)) for j in range(draw.randrange(1, 6))]
        toxic = i % 6 == 0
        if toxic:
            sentences[draw.randrange(len(sentences))] += draw.choice([" you scum", " an idiot here", " moron"])
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(toxic)))
    docs, marks = table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    odd = [(10_000, None), (10_001, ""), (None, "Plain words. what an idiot you are. fine")]
    scored = {r.doc_id: r for r in toxicity.score(table(spark, rows + odd), model).collect()}
    held = {r[0] for r in docs.where(toxicity.held_out(docs.doc_id)).select("doc_id").collect()}
    assert held == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum((scored[i].score >= 0.5) == bool(labels[i][1]) for i in held)
    assert right >= 0.97 * len(held)
    assert scored[10_000].score == scored[10_001].score == 0
    text = odd[2][1]
    assert [text[s.start:s.end].strip() for s in scored[None].sentences] == ["what an idiot you are."]
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {i for i in range(1500) if scored[i].score < 0.5}


def test_toxicity_without_labels(spark):
    docs = table(spark, odd_rows())
    model = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 0.5 for r in toxicity.score(docs, model).select("score").collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


def slow_noisy_or(texts, labels):
    """Weights and bias by the same gradient steps, sentence by sentence. ``texts`` has lists of sentences of features."""
    names = sorted({f for t in texts for s in t for f in s})
    weights, bias = dict.fromkeys(names, 0.0), toxicity.START_BIAS
    moment, power = ({k: 0.0 for k in [*names, None]} for _ in range(2))

    def soft(x):
        return math.log1p(math.exp(-abs(x))) + max(x, 0)

    def chance(x):
        return 1 / (1 + math.exp(-x))

    positive = sum(labels)
    for step in range(1, toxicity.STEPS + 1):
        grad = {k: 0.0 for k in [*names, None]}
        for sentences, label in zip(texts, labels):
            logits = [sum(weights[f] for f in s) + bias for s in sentences]
            clean = soft(bias) + sum(soft(z) - soft(bias) for z in logits if z >= bias)
            pull = (-math.exp(-clean) / max(1 - math.exp(-clean), 1e-9) if label else 1.0) * 0.5 / (
                positive if label else len(labels) - positive)
            grad[None] += pull * chance(bias)
            for s, z in zip(sentences, logits):
                if z >= bias:
                    grad[None] += pull * (chance(z) - chance(bias))
                    for f in s:
                        grad[f] += pull * chance(z)
        for k in [*names, None]:
            g = grad[k] + (toxicity.DECAY * weights[k] if k is not None else 0)
            moment[k] = 0.9 * moment[k] + 0.1 * g
            power[k] = 0.99 * power[k] + 0.01 * g * g
            change = toxicity.RATE * (moment[k] / (1 - 0.9 ** step)) / (math.sqrt(power[k] / (1 - 0.99 ** step)) + 1e-9)
            if k is None:
                bias -= change
            else:
                weights[k] -= change
    return weights, bias


def test_noisy_or_is_fitted_as_by_hand():
    draw = random.Random(2)
    texts = [[[draw.randrange(12) for _ in range(draw.randrange(1, 4))] for _ in range(draw.randrange(4))] for _ in range(60)]
    labels = [int(any(0 in s or 1 in s for s in t)) for t in texts]
    flat = [f for t in texts for s in t for f in s]
    sentences = [s for t in texts for s in t]
    model = toxicity.fit(np.array(flat), np.repeat(np.arange(len(sentences)), [len(s) for s in sentences]),
                         np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.array(labels))
    weights, bias = slow_noisy_or(texts, labels)
    assert model.bias == pytest.approx(bias, rel=1e-6, abs=1e-6)
    assert {f: model.weights[f] for f in weights} == pytest.approx(weights, rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("telling", [True, False])
def test_length_alone_makes_no_text_toxic(spark, telling):
    n = 600 if telling else 40
    rows = [(i, f"lamp river stone. the {'filthyword' if i % 2 else 'goodword'} walks. paper and much") for i in range(n)]
    model = toxicity.learn(table(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int"))
    long = table(spark, [(k, "plain words here. " * k) for k in (1, 5, 50, 500, 5000)] + [(0, "plain. filthyword. plain. " * 3)])
    scores = {r.doc_id: r.score for r in toxicity.score(long, model).collect()}
    assert len({round(scores[k], 9) for k in (1, 5, 50, 500, 5000)}) == 1 and scores[5000] < 0.5
    assert (scores[0] > 0.9) == telling


# SimHash

def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    w = [x.decode() for x in w]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    base = prose(11, 400)
    rows = odd_rows() + [(50 + i, base.replace("lamp", f"lump{i}", 1) + " tail" * (i % 3)) for i in range(25)]
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(table(spark, rows)).collect()}
    prints = [(k, brute_fingerprint(t)) for k, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                parent[root(i)] = root(j)
    for i, (key, value) in enumerate(prints):
        members = [k for j, (k, _) in enumerate(prints) if root(j) == root(i) and k is not None]
        assert found[key, f"{value:016x}"] == min(members, default=None)
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = table(spark, odd_rows() + [(60, "b c d e"), (61, "b c d e"), (62, "q r s t")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = [r[0] for r in kept.select("doc_id").collect()]
    assert {60, 62} <= set(found) and 61 not in found
    # One row of each group, by brute force; rows that share a key but not a group are both there.
    rows = odd_rows() + [(60, "b c d e"), (61, "b c d e"), (62, "q r s t")]
    parent = list(range(len(rows)))

    def root(i):
        return i if parent[i] == i else root(parent[i])
    prints = [brute_fingerprint(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least.setdefault(root(i), []).append((k is None, k or 0))
    assert sorted(found, key=lambda k: (k is None, k or 0)) == sorted(
        (None if n else k for n, k in map(min, least.values())), key=lambda k: (k is None, k or 0))
    shared = simhash.keep_one(table(spark, [(6, "alpha beta gamma delta"), (6, "totally other words here"), (7, "alpha beta gamma delta")]))
    assert sorted(r.text for r in shared.collect()) == ["alpha beta gamma delta", "totally other words here"]
    assert simhash.keep_one(table(spark, [])).count() == 0


# Decontamination

def edit_distance_to_stretch(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=70), st.lists(st.integers(0, 3), max_size=80))
@settings(max_examples=150, deadline=None)
def test_exact_edit_verification(item, text):
    assert decontam.best_match(item, text)[0] == edit_distance_to_stretch(item, text)


def fold(text):
    """Words with A-Z lower-cased, nothing else."""
    return [w.encode().lower().decode() for w in split(text)]


def test_leaks(spark):
    items = [(i, prose(300 + i, 12 + i)) for i in range(40)] + [(90, "too short"), (91, None), (None, prose(1, 30))]
    draw, rows = random.Random(5), odd_rows()
    for n, (k, item) in enumerate(items[:40]):
        w = item.split()
        for _ in range(int(len(w) * 0.15)):
            w[draw.randrange(len(w))] = "changed"
        rows.append((500 + n, f"{prose(n, 60)} {' '.join(w).upper() if n % 5 == 0 else ' '.join(w)} {prose(n + 70, 40)}"))
    docs, benchmark = table(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(docs, benchmark).collect()}
    lower = [(k, fold(t)) for k, t in rows]
    found = {k: r for k, r in found.items() if k[1] < 90}
    expected = {(k, i) for k, text in lower if len(text) < 1000 for i, item in items[:40]
                if edit_distance_to_stretch(fold(item), text) <= int(len(item.split()) * 0.15)}
    assert set(found) <= expected and len(found) >= 0.95 * len(expected)
    for (k, i), r in found.items():
        text = next(t for key, t in lower if key == k)
        assert edit_distance_to_stretch(fold(items[i][1]), text[r.start:r.end]) == r.edits
    kept = decontam.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({k for k, _ in found})
    assert decontam.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontam.find_leaks(docs, benchmark.limit(0)).count() == 0


def edit(words, n, draw):
    words = list(words)
    for _ in range(n):
        at, kind = draw.randrange(len(words)), draw.randrange(3)
        words[at:at + (kind != 1)] = [] if kind == 2 else [f"new{draw.randrange(10**6)}"]
    return words


def recall_of(searcher, items, draw, kinds):
    """Share of edited items that are found between other words, by kind."""
    seen, caught = Counter(), Counter()
    for k, (kind, words) in enumerate(zip(kinds, items)):
        text = " ".join([*prose(10**6 + k, 50).split(), *edit(words, int(len(words) * 0.15), draw), *prose(2 * 10**6 + k, 40).split()])
        hashes, first = decontam.folded_words(pa.array([text]))
        seen[kind] += 1
        caught[kind] += any(item == k for _, item, *_ in searcher.find(hashes, first))
    return {kind: caught[kind] / seen[kind] for kind in seen}


def hashed(items):
    flat, first = decontam.folded_words(pa.array([" ".join(w) for w in items]))
    return [flat[a:b] for a, b in zip(first, first[1:])]


@pytest.mark.parametrize("size", [7, 8, 9, 15, 16, 17, 20, 31, 32, 33, 40, 63, 64, 65, 300])
def test_edited_items_of_any_size_are_found(size):
    items = [[f"w{(i * size + j) * 7919 % 4001}" for j in range(size)] for i in range(300)]
    searcher = decontam.Searcher(hashed(items), 0.15, 0.95, 3)
    assert all(r >= 0.95 for r in searcher.recall.values())
    assert recall_of(searcher, items, random.Random(size), [size] * 300)[size] >= 0.92


def test_recall_holds_for_every_size_of_a_mixed_benchmark():
    kinds = [300] * 400 + [k for k in (12, 16, 20, 32, 40, 70) for _ in range(200)]
    draw = random.Random(9)
    items = [[f"w{draw.randrange(5000)}" for _ in range(k)] for k in kinds]
    searcher = decontam.Searcher(hashed(items), 0.15, 0.95, 3)
    found = recall_of(searcher, items, draw, kinds)
    assert all(found[k] >= 0.92 for k in found) and np.mean(list(found.values())) >= 0.95


def test_short_items_are_found_word_for_word(spark):
    items = [(1, "solitary"), (2, "Two Words"), (3, "three of them"), (4, "just four words here"), (6, "six words make a short item"), (7, " \t ")]
    rows = odd_rows() + [(100, "a solitary one"), (101, "here are two words"), (102, "three of these"), (103, "x just four words here y"),
                         (104, "SIX words make a short item"), (105, "six words make one short item"), (106, "solitary")]
    found = decontam.find_leaks(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    lower = [(k, fold(t)) for k, t in rows]
    expected = {(k, i, j, j + len(w), 0) for k, text in lower for i, item in items[:5] if (w := fold(item))
                for j in range(len(text)) if text[j:j + len(w)] == w}
    assert {tuple(r) for r in found.collect()} == expected


def test_rows_are_judged_by_their_own_text(spark):
    item = prose(77, 20)
    rows = [(1, f"x {item} y"), (1, "clean words under the same key"), (None, "clean too"), (None, item)]
    kept = decontam.without_leaks(table(spark, rows), spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert sorted(r.text for r in kept.collect()) == ["clean too", "clean words under the same key"]


def test_more_items_take_more_passes(spark, monkeypatch):
    items = [(i, prose(300 + i, 30)) for i in range(10)]
    docs, benchmark = table(spark, items), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "PASS_WORDS", 70)
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, benchmark).collect()} == {(i, i) for i in range(10)}


# Quality

def brute_measure(text):
    text = text or ""
    w = split(text)
    lines = [x for x in text.split("\n") if split(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(marked))


@given(st.text(alphabet="ab é\n\t#|<", max_size=60))
@settings(max_examples=150, deadline=None)
def test_counts(text):
    assert quality.measure(text.encode()) == brute_measure(text)


def test_quality(spark):
    good = [(i, prose(i, 80)) for i in range(60)]
    bad = [(100 + i, prose(i, 80, ("zz%", "qq$", "kk#", "ww*", "xx&"))) for i in range(60)]
    docs = table(spark, good + bad + odd_rows())
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in good[:40] + bad[:40]] + [(None, 1), (3, None)],
                                   "doc_id long, quality int")
    found = quality.judge(docs, labels)
    rows = found.collect()
    assert len(rows) == 120 + len(odd_rows())
    texts = dict(good + bad)
    for r in rows:
        if r.doc_id in texts and r.doc_id >= 10:
            assert tuple(r)[1:6] == brute_measure(texts[r.doc_id])
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed and r.doc_id < 100)
    assert all(not r.kept for r in rows if r.n_words < 50)
    assert quality.judge(docs.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["long", "int"])
def test_target_counts_all_trusted_texts(spark, kind):
    rows = [(i, prose(i, 80)) for i in range(60)] + odd_rows()
    docs = table(spark, rows)
    labels = spark.createDataFrame([(k, k % 3 and 1) for k in range(60)] + [(None, 1)], f"doc_id {kind}, quality int")
    odd = [r[0] for r in labels.where("pmod(xxhash64(doc_id), 2) = 1 AND doc_id IS NOT NULL")
           .orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
    for most in (40_000, 3):
        held_out = set(odd[:most])
        total = np.full((2, quality.BUCKETS), quality.SMOOTHING)
        for k, text in rows:
            found, _ = quality.bucket_runs(pa.array([text], pa.string()))
            np.add.at(total[0], found, 1)
            if k in range(60) and k not in held_out and k % 3:
                np.add.at(total[1], found, 1)
        shares = np.log(total[1] / total[1].sum()) - np.log(total[0] / total[0].sum())
        expected = {k: [] for k, _ in rows}
        for k, text in rows:
            found, _ = quality.bucket_runs(pa.array([text], pa.string()))
            expected[k].append(shares[found].mean() if len(found) else 0.0)
        judged = quality.judge(docs, labels, max_labelled=most).select("doc_id", "score").collect()
        for k in expected:
            assert sorted(s for i, s in judged if i == k) == pytest.approx(sorted(expected[k]), abs=1e-8)


def test_all_labelled_texts_count(spark, monkeypatch):
    """The target holds every trusted text, and the threshold is fitted on every labelled one."""
    rows = [(i, prose(i, 80)) for i in range(80)]
    labels = spark.createDataFrame([(k, k % 3 and 1) for k in range(80)], "doc_id long, quality int")
    total = np.full((2, quality.BUCKETS), quality.SMOOTHING)
    for k, text in rows:
        found, _ = quality.bucket_runs(pa.array([text], pa.string()))
        np.add.at(total[0], found, 1)
        if k % 3:
            np.add.at(total[1], found, 1)
    shares = np.log(total[1] / total[1].sum()) - np.log(total[0] / total[0].sum())
    fitted = []
    best = quality.best_threshold
    monkeypatch.setattr(quality, "best_threshold", lambda scored, good: fitted.append(scored.count()) or best(scored, good))
    judged = {r.doc_id: r.score for r in quality.judge(table(spark, rows), labels).collect()}
    for k, text in rows:
        found, _ = quality.bucket_runs(pa.array([text], pa.string()))
        assert judged[k] == pytest.approx(shares[found].mean(), abs=1e-8)
    assert fitted == [80]


# The pipeline

def test_the_pipeline_by_brute_force(spark, tmp_path):
    """All stages over one small folder: what each drops and changes, found by comparing everything with everything."""
    import corpus_pipeline

    draw = random.Random(21)
    item = prose(900, 24)
    texts = {i: prose(i, draw.randrange(60, 90)) for i in range(60)}
    for i in range(10):
        texts[100 + i] = texts[i]  # copies
        texts[200 + i] = f"{texts[10 + i]} filthyword you filthyword"
        words = item.split()
        words[i + 2] = "changed"
        texts[300 + i] = f"{prose(i + 5000, 40)} {' '.join(words)} {prose(i + 6000, 30)}"
        texts[400 + i] = f"{prose(i + 7000, 50)} password=abcdef12345{i} and 0123456789abcdef{i} {prose(i + 8000, 20)}"
    texts |= {500: "", 501: " \n", 502: "short"}
    docs = [(k, t, "en", "web", len(t)) for k, t in texts.items()]
    marked = {k: int(200 <= k < 210) for k in texts}
    for name, rows, schema in (
            ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", [(k, 1, v) for k, v in marked.items() for _ in range(1)], "doc_id long, quality int, toxic int"),
            ("benchmark", [(1, item), (2, prose(901, 30))], "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    folder = str(tmp_path)
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}

    table_ = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.learn(table_, spark.read.parquet(f"{folder}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(table_, model).collect()}
    left = {k: t for k, t in texts.items() if scores[k] < 0.5}
    prints = {k: brute_fingerprint(t) for k, t in left.items()}
    parent = {k: k for k in left}

    def root(k):
        return k if parent[k] == k else root(parent[k])
    for a in left:
        for b in left:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2 and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    left = {k: t for k, t in left.items() if root(k) == k}
    left = {k: t for k, t in left.items() if edit_distance_to_stretch(fold(item), fold(t)) > int(24 * 0.15)}
    assert not any(k in left for k in (*range(100, 110), *range(300, 310))) and set(range(400, 410)) <= set(left)
    for k, text in left.items():
        spans = [(a, b, kind) for a, b, kind, _ in secrets.base_spans(text)]
        out, at = [], 0
        for a, b, kind in spans:
            if a >= at:
                out.append(text[at:a] + f"[{kind}]")
            at = max(at, b)
        left[k] = "".join(out) + text[at:]
    expected = {}
    for k, text in left.items():
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        expected[k] = (len(ids), sha(",".join(map(str, ids))), sha(text))
    assert {k: tuple(r)[1:] for k, r in found.items()} == expected
