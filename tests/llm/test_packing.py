"""Packing: ids against the library, cuts against a plain dynamic program, pieces against the texts."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimweft.llm import packing, tokencount

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_equal_the_library(library, rows_of):
    rnd = random.Random(5)
    encoder = packing.Encoder(tokencount.prove(PATH))
    bits = [" ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "　", "'", "'s", "'LL", "don't", "It's", "9", "12.5", "...", ".\"", "É", "é", "́", "Σ", "ß", "“", "”", "。", "！", "文字", "—",
            "<", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "word", "WORD", "\x00", "�", "𝒳", "x" * 200]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(1500)] + [None, ""]
    texts += [t for (t,) in rows_of("documents", "text", "doc_id")]
    for a in range(0, len(texts), 97):
        ids, at, _ = encoder.encode([None if t is None else t.encode() for t in texts[a : a + 97]])
        for i, text in enumerate(texts[a : a + 97]):
            assert [*ids[at[i] : at[i + 1]].tolist(), 2] == ids_of(library, text), text


def test_pieces_of_one_hash_are_told_apart(library, monkeypatch):
    encoder = packing.Encoder(tokencount.prove(PATH))
    texts = [b"one two. three", None, b"one one", b"", b"four"]
    want = encoder.encode(texts)
    encoder.forget()
    monkeypatch.setattr(packing.grams, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    for got, wanted in zip(encoder.encode(texts), want, strict=True):
        assert got.tolist() == wanted.tolist()


def test_common_pieces_survive_thinning(library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 50)
    encoder = packing.Encoder(tokencount.prove(PATH))
    for i in range(40):
        text = " ".join(f"w{i}x{j}. the" for j in range(20))
        assert encoder.encode([text.encode()])[0].tolist() == ids_of(library, text)[:-1]
    assert encoder.known.n <= 100 and encoder.known.find(packing.grams.span_hashes(np.frombuffer(b"the", np.uint8), np.array([0]), np.array([3])))[0] >= 0


def test_pieces_kept_stay_in_bounds(library):
    """640,000 different pieces and their words: the worker's arrays stay below 80 MB, and thinning ends."""
    encoder = packing.Encoder(tokencount.prove(PATH))
    for start in range(0, 640_000, 40_000):
        encoder.encode([" ".join(f"w{i}" for i in range(start, start + 40_000)).encode()])
    lists = [x for y in (encoder.bytes, encoder.ids, encoder.ends, encoder.merged) for x in (y.starts, y.counts, y.flat)]
    held = [*lists, encoder.uses, encoder.words.uses, encoder.known.keys, encoder.known.slots, encoder.known.hashes]
    assert sum(x.nbytes for x in held) < 80e6 and encoder.known.n < 2 * packing.KEPT


def test_sentences_end_where_their_tokens_do(library):
    encoder = packing.Encoder(tokencount.prove(PATH))
    text = 'One two. "Three!" four e.g. this 3.5 end? 文字。文「字！」x'
    ids, _, places = encoder.encode([text.encode()])
    ends = ["One two.", 'One two. "Three!"', 'One two. "Three!" four e.g.', 'One two. "Three!" four e.g. this 3.5 end?', text[: text.index("。") + 1], text[: text.index("！") + 1]]
    want = [len(ids_of(library, e)) - 1 for e in ends]
    assert places.tolist()[:5] == want[:5] and set(places.tolist()[5:]) <= set(want)


def plain_cost(at, kind, limit):
    points, penalty = [0, *at], [0, *[(0, packing.SENTENCE, packing.FORCED)[k] for k in kind]]
    cost = [0] + [10**12] * len(at)
    for j in range(1, len(points)):
        for i in range(j):
            n = points[j] - points[i]
            if n <= limit:
                free = n == limit or (n & (n - 1) == 0 and n >= packing.SHORTEST)
                cost[j] = min(cost[j], cost[i] + (0 if free else limit - n) + penalty[j] + packing.WINDOW)
    return cost[-1]


def cost_of(at, kind, cuts, limit):
    total, last = 0, 0
    for c in cuts:
        n = at[c] - last
        last = at[c]
        free = n == limit or (n & (n - 1) == 0 and n >= packing.SHORTEST)
        total += (0 if free else limit - n) + (0, packing.SENTENCE, packing.FORCED)[kind[c]] + packing.WINDOW
    return total


def test_cuts_cost_no_more_than_those_of_a_plain_program():
    rnd = random.Random(11)
    for _ in range(60):
        at = np.cumsum([rnd.choice([1, 3, 16, 64, 128, 500, rnd.randint(1, 512)]) for _ in range(rnd.randint(1, 120))])
        kind = np.array([rnd.choice([0, 1, 1, 1, 2]) for _ in at])
        kind[-1] = 0
        cuts = packing.best_cuts(at, kind, 1024)
        assert cuts[-1] == len(at) - 1 and np.diff([0, *at[cuts]]).max() <= 1024
        assert cost_of(at.tolist(), kind.tolist(), cuts, 1024) == plain_cost(at.tolist(), kind.tolist(), 1024)


def test_places_to_cut():
    at, kind = packing.cut_points(np.array([0, 40]), np.array([40, 1700]), np.array([10, 39, 40 + 600, 1699, 1700]))
    assert at.tolist() == [10, 40, 552, 640, 1152, 1664, 1700] and kind.tolist() == [1, 0, 2, 1, 2, 2, 0]


def checked(rows, docs, library, limit=4096):
    """Every id of every document in one piece; sequences without gaps, in order. Returns the padded share."""
    sequences, by_doc = collections.defaultdict(list), collections.defaultdict(collections.Counter)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    padded = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= limit
        padded += end if end & (end - 1) == 0 else limit
    want = collections.defaultdict(list)
    for number, text in docs:
        want[number].append(ids_of(library, text))
    for r in rows:
        by_doc[r.doc_id][(r.doc_tokens, r.start, r.length, zlib.crc32(r.ids))] += 1
        assert len(r.ids) == 4 * r.length
    for number, lists in want.items():
        left = by_doc.pop(number)
        assert sum(n * c for (_, _, n, _), c in left.items()) == sum(map(len, lists))
        for ids in lists:
            raw = np.array(ids, "<u4").tobytes()
            at = 0
            while at < len(ids):
                fits = [k for k, c in left.items() if c and k[0] == len(ids) and k[1] == at and zlib.crc32(raw[4 * at : 4 * (at + k[2])]) == k[3]]
                assert fits, (number, at)
                left[fits[0]] -= 1
                at += fits[0][2]
    assert not by_doc
    return padded / sum(len(ids) for lists in want.values() for ids in lists) - 1


def test_pieces_of_the_table(spark, rows_of, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    share = checked(packing.pack(docs, PATH).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], library)
    assert share < 0.03  # the last window of each of eight tasks is short of choice


def test_pieces_of_odd_rows(spark, odd_docs, no_docs, library):
    clashing = odd_docs.selectExpr("*", "1 as digest", "2 as tie", "3 as length")
    checked(packing.pack(clashing, PATH).collect(), [tuple(r) for r in odd_docs.select("doc_id", "text").collect()], library)
    assert packing.pack(no_docs, PATH).count() == 0


def test_long_texts_go_in_part_by_part(spark, library):
    rnd = random.Random(2)
    words = "alpha beta. gamma delta! epsilon\n".split(" ")
    text = " ".join(rnd.choice(words) for _ in range(900_000)) + " " * 3_000_000
    rows = [(2, text), (1, "before."), (3, "y" * 200), (4, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH).collect()
    assert len(text) > 4 * packing._CHARS
    assert checked(got, rows, library) < 0.02


def test_runs_follow_each_other_without_loss(library):
    """Small runs: most windows are settled before the stream's end."""
    rnd = random.Random(4)
    encoder, packer = packing.Encoder(tokencount.prove(PATH)), packing.Packer(5, 64, 1000)
    out = []
    texts = [" ".join(rnd.choice(["one", "two.", "three"]) for _ in range(rnd.randint(0, 90))) for _ in range(200)]
    for i, t in enumerate(texts):
        ids, _, places = encoder.encode([t.encode()])
        ids = np.append(ids, 2)
        at = np.array([len(ids)])
        points = np.unique(np.concatenate([places[places < len(ids) - 1], np.arange(40, len(ids), 40), at]))
        kind = np.where(points == len(ids), 0, 1)
        out += packer.add(ids, points, kind, (np.array([0]), at, np.array([i]), np.array([False])))
    out += packer.finish()
    rows = [collections.namedtuple("R", packing._NAMES)(*r.values()) for b in out for r in b.to_pylist()]
    assert len(out) > 5
    checked(rows, list(enumerate(texts)), library, 64)
