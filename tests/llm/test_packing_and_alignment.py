"""Best-fit packing, alignment of tokenizers and spelling variants, against brute force on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textpack.llm import align, bestfit, variants
from tests.llm.helpers import by_row, odd_rows, prose, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(PATH)
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)


# Best-fit packing

def brute_pieces(rows, capacity=1024):
    made = []
    for key, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // capacity)
        cuts = [0, *(len(ids) - capacity * k for k in range(n - 1, -1, -1))]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            made.append((key, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]))
    return made


def test_every_piece_has_its_place(spark):
    rows = odd_rows() + [(20 + i, prose(i, 37 * i)) for i in range(40)] + [(90, "a<|endoftext|>b")]
    docs = table(spark, rows)
    found = bestfit.pack(docs, PATH).collect()
    assert by_row((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == by_row(p[:5] for p in brute_pieces(rows))
    by_sequence = defaultdict(list)
    for r in found:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
    pieces = bestfit.cut(docs, PATH, with_ids=True)
    placed = bestfit.place(pieces)
    made, bound = bestfit.certificate(pieces, placed)
    assert made == len(by_sequence) and bound <= made <= bound + 1
    whole = Counter(tuple(r.ids) for r in bestfit.sequences(pieces, placed).collect())
    assert sum(map(len, whole.elements())) == sum(p[3] for p in brute_pieces(rows)) and max(map(len, whole)) <= 1024
    assert bestfit.pack(docs.limit(0), PATH).count() == 0


def fewest_bins(lengths, capacity):
    """By trying every way."""
    best = len(lengths)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[k] <= capacity and bins[i] not in bins[:i]:
                go(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1:]])
        go(k + 1, [*bins, lengths[k]])

    go(0, [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_bound_never_exceeds_the_fewest_bins(lengths):
    fewest = fewest_bins(sorted(lengths, reverse=True), 20)
    bins, offsets = bestfit.best_fit_decreasing(np.array(lengths), 20)
    bound = bestfit.lower_bound(*np.unique(lengths, return_counts=True), 20)
    assert -(-sum(lengths) // 20) <= bound <= fewest <= max(bins) + 1
    for b in set(bins.tolist()):
        own = sorted((o, n) for o, n, c in zip(offsets.tolist(), lengths, bins) if c == b)
        assert all(o + n == p for (o, n), (p, _) in zip(own, own[1:])) and sum(own[-1]) <= 20


@pytest.mark.parametrize("sizes, bound", [([11, 11, 11], 3), ([7] * 6, 3), ([10, 11, 9, 10], 2), ([20], 1)])
def test_bounds_of_known_cases(sizes, bound):
    assert bestfit.lower_bound(*np.unique(sizes, return_counts=True), 20) == bound


def test_partitions_with_gaps_exchange_pieces(spark):
    draw = random.Random(4)
    lengths = [(i, draw.choice((340, 345, 500, 520, 600, 333, 90))) for i in range(3000)]
    pieces = spark.createDataFrame(lengths, "piece_id long, length long")
    apart = bestfit.place(pieces, part_pieces=60, rounds=0)
    placed = bestfit.place(pieces, part_pieces=60)
    made, bound = bestfit.certificate(pieces, placed)
    assert bound <= made < apart.where("offset = 0").count()
    assert sorted(r[0] for r in placed.select("piece_id").collect()) == list(range(3000))
    filled = placed.join(pieces, "piece_id").groupBy("sequence_id").agg({"length": "sum", "offset": "min"}).collect()
    assert all(r["sum(length)"] <= 1024 and r["min(offset)"] == 0 for r in filled)


# Alignment of tokenizers

def token_bytes():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    of_a = {i: bytes(letters[c] for c in t) for t, i in PLAIN.get_vocab(with_added_tokens=False).items() if i != 50256}
    of_b = {i: bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i)
            else PIECES.id_to_piece(i).replace("▁", " ").encode() for i in range(32000)}
    return of_a, of_b


OF_A, OF_B = token_bytes()


def brute_links(text):
    """Tokens of both sides, groups and links, or nothing."""
    if not text:
        return None
    a, b = PLAIN.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    whole = (" " + text).encode()
    if b"".join(OF_A[i] for i in a) != whole or b"".join(OF_B[i] for i in b) != whole:
        return None

    def spans(ids, of):
        at, made = 0, []
        for i in ids:
            made.append((at, at + len(of[i]), i))
            at += len(of[i])
        return made
    sa, sb = spans(a, OF_A), spans(b, OF_B)
    common = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
    groups, start = [], 0
    for end in common:
        groups.append(([i for s, e, i in sa if start <= s < end], [i for s, e, i in sb if start <= s < end]))
        start = end
    links = [(x, y) for s, e, x in sa for t, u, y in sb if s < u and t < e]
    return a, b, groups, links


def brute_alignment(rows):
    made = [brute_links(t) for _, t in rows]
    counts = Counter(pair for m in made if m for pair in set(m[3]))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for (key, _), m in zip(rows, made):
        if m is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = m
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((key, len(a), len(b), len(groups), len(links), sum(counts[p] == top[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest()))
    return out


def texts_to_align():
    rows = [r for r in odd_rows() if r[1] is None or len(r[1]) < 6000] + [
        (30, "a▁b piece"), (31, "   spaces  inside\n\n and\tends  "), (32, "élan 漢字 🙂 naïve <0x41> <s></s> <|endoftext|>"),
        (33, "\u0000 nul"), (34, "Straße ﬁne é"), (35, " " * 40 + "x"), (36, "aaaaaaaaaaaa aaaaa"), (37, "\r\n\r\n")]
    return rows + [(40 + i, prose(i, 30, ("don't", "token", "isation", "Überall", "x_y=3;", "1234567"))) for i in range(30)]


@pytest.mark.parametrize("head", [1 << 18, 20, 0])
def test_alignment(spark, head):
    rows = texts_to_align()
    found = align.align(table(spark, rows), PATH, MODEL, head_pairs=head)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert by_row(tuple(r) for r in found.collect()) == by_row(brute_alignment(rows))


def test_alignment_of_nothing(spark):
    assert align.align(table(spark, []), PATH, MODEL).count() == 0


def test_groups_are_given_as_ids(spark):
    rows = texts_to_align()
    found = align.groups(table(spark, rows), PATH, MODEL)
    expected = [(k, (m[2] if (m := brute_links(t)) else [])) for k, t in rows]
    assert by_row((r.doc_id, [(list(g.a), list(g.b)) for g in r.groups]) for r in found.collect()) == by_row(expected)


@given(st.lists(st.text(alphabet="ab é\n\t▁ 漢<0x>", max_size=30), min_size=1, max_size=6))
@settings(max_examples=100, deadline=None)
def test_alignment_of_any_text(texts):
    own, _ = align.aligner(PATH, MODEL)
    found = own.align(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        a, b, groups, links = brute_links(text) or ([], [], [], [])
        s, e = found.link_at[k:k + 2]
        assert sorted(zip(found.link_a[s:e].tolist(), found.link_b[s:e].tolist())) == sorted(links)
        assert found.group_at[k + 1] - found.group_at[k] == len(groups)
        assert found.b[found.b_at[k]:found.b_at[k + 1]].tolist() == b


# Spelling variants

def brute_counts(rows, every=199):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 6
    return {w: n for w, n in counts.items() if n >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts):
    others = defaultdict(list)
    for a, b in combinations(counts, 2):
        if near(a, b):
            others[a].append(b)
            others[b].append(a)
    form = {}
    for w in counts:
        best = min(others[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(others[w]), counts.get(form[w])))
    return by_row(out)


def spelled(spark, rows, every=199):
    found = variants.with_lost_letters(variants.runs(table(spark, rows)), every)
    return variants.word_counts(found)


@pytest.mark.parametrize("every", [199, 3])
def test_word_counts(spark, every):
    rows = odd_rows() + [(30 + i, "Überallhin ÉCLAIR×Éclair naïveté_naïveté abcdef ABCDEFG " * 3) for i in range(20)]
    found = {r.word: r.n for r in spelled(spark, rows, every).collect()}
    assert found == brute_counts(rows, every)


def test_spelling_variants(spark):
    draw = random.Random(6)
    stems = ["".join(draw.choice(("ta", "ri", "on", "lé", "s", "be", "gra")) for _ in range(draw.randrange(3, 8))) for _ in range(60)]
    stems += ["banana", "bananas", "bandana", "aaaaaa", "aaaaaaa", "aaaaaaab", "x" * 30, "x" * 29 + "y", "x" * 31, "abcdefg"]
    words = list(stems)
    for _ in range(500):
        w = draw.choice(stems)
        i, letter = draw.randrange(len(w)), draw.choice("abresÿ")
        words.append(draw.choice((w[:i] + w[i + 1:], w[:i] + letter + w[i + 1:], w[:i] + letter + w[i:])))
    counts = {w: draw.choice((5, 6, 30, 200, 6000)) for w in words if len(w) >= 6}
    found = variants.group(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert by_row(tuple(r) for r in found.collect()) == brute_variants(counts)


def test_spelling_variants_of_texts(spark):
    rows = odd_rows() + [(100 + i, f"wandering wanderinng Wandering {'wandering ' * 20}{prose(i, 50)} rivers{'e' * (i % 3)} " * 2)
                         for i in range(150)]
    found = variants.group(spelled(spark, rows, 7))
    assert by_row(tuple(r) for r in found.collect()) == brute_variants(brute_counts(rows, 7))


@pytest.mark.parametrize("words", [[], [("single", 5)], [("abcdef", 5), ("zzzzzz", 9)], [("abcdef", 5), ("abcdefg", 25)]])
def test_few_words(spark, words):
    found = variants.group(spark.createDataFrame(words, "word string, n long"))
    assert by_row(tuple(r) for r in found.collect()) == brute_variants(dict(words))
