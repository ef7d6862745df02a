"""Each operator against a brute-force version, an exact round trip or held-out labels."""

import collections
import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zlib

from claimweft.llm import chatformat, grams, importance, leaks, minhash, mixing, neardup, queries, secretscan, sharding, tokencount, topk, urlfilter
from pyspark.sql import functions as F

Q = queries.QUERIES


@pytest.fixture(scope="module")
def docs(rows_of):
    return rows_of("documents", "doc_id, text, source")


# --- words and grams ---------------------------------------------------------------------


def test_tokens_do_not_depend_on_how_texts_are_cut(monkeypatch):
    texts = ["The quick, BROWN fox's 12 x-y", None, "", "été " * 50, "a b c"]
    whole = grams.tokens(texts)
    monkeypatch.setattr(grams, "PIECE", 40)
    pieces = grams.tokens(texts)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()
    words = [w for t in texts for w in re.findall(r"[^\W_]+", (t or "").lower())]
    assert len(whole[0]) == len(words)
    assert len(set(whole[0].tolist())) == len(set(words))
    runs, at = grams.ngrams(*whole, 5)
    assert np.diff(at).tolist() == [4, 0, 0, 46, 1]
    assert len(set(runs.tolist())) == 4 + 1 + 1


# --- 1 quality ---------------------------------------------------------------------------


def test_log_weights_leave_the_document_out(rows_of):
    texts = [r[0] for r in rows_of("documents", "text", "doc_id")[:30]] + ["so so so", None]
    good = np.arange(32) % 3 == 0
    count = lambda t: collections.Counter(importance._buckets([t])[1].tolist())
    each = [count(t) for t in texts]
    raw, target = np.zeros(2 * importance.BUCKETS), np.zeros(2 * importance.BUCKETS)
    for c, g in zip(each, good, strict=True):
        for b, n in c.items():
            raw[b] += n
            target[b] += n * g
    got = importance._log_weights(texts, good.astype(int), raw, target, 3.0)
    ratio = target.sum() / raw.sum()
    for i, c in enumerate(each):
        want = sum(n * math.log((target[b] - n * good[i] + 3) / ((raw[b] - n) * ratio + 3)) for b, n in c.items())
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_quality_on_labels(spark, sf_dir, rows_of):
    kept = {r.doc_id for r in Q["op1_importance_resampling"](spark, sf_dir).collect()}
    labels = rows_of("labels", "doc_id, quality")
    clean = [d for d, q in labels if q == 1]
    junk = [d for d, q in labels if q == 0]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert sum(d in kept for d in junk) < 0.6 * len(junk) + 3  # few labels here: k is generous


def test_held_out_quality(spark, docs, rows_of):
    """Labels of half the documents train; the other half is judged by the sign of the weight."""
    folder = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    good = importance.good_documents(train)
    scored = importance.score(d, good, importance.fit(d, good), ["doc_id"]).join(test, "doc_id").select("quality", "log_weight").collect()
    pos = [r.log_weight for r in scored if r.quality == 1]
    neg = [r.log_weight for r in scored if r.quality == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.95


# --- 2 chat ------------------------------------------------------------------------------


def test_chat_digests(spark, sf_dir, rows_of):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows_of("conversations", "conv_id, turn, role, text", "1, 2, 3, 4"):
        turns[c].append((r, x or ""))
    probe = "</s>[INST] ok [/INST]"
    turns[-1] = [("user", probe), ("assistant", probe)]
    got = {r.conv_id: r for r in Q["op2_typed_chat_parts"](spark, sf_dir).collect()}
    assert got.keys() == turns.keys()
    for c, t in turns.items():
        loss = "".join(x for r, x in t if r == "assistant")
        assert got[c].n_turns == len(t) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_typed_parts_round_trip():
    rnd = random.Random(3)
    bits = ["<", "[", "|", "\\", "/", "s>", "INST]", "end|>", "image:0|>", "a", "\n", "é"]
    for _ in range(3000):
        s = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
        k = rnd.randint(0, len(s))
        parts = [{"type": "text", "text": s[:k]}, {"type": "text", "text": s[k:]}, {"type": "image", "ref": "r1", "width": 100, "height": 30},
                 None, {"type": "audio", "ref": "r2", "seconds": 1.5}, {"type": "text", "text": s}, {"type": "document", "pages": 3}]
        formatted, found = chatformat.format_turn("us|>er\n", parts)
        assert not re.search(r"<\||</?s>|\[/?INST\]", chatformat.escape(s))
        role, back = chatformat.read_turn(formatted)
        text = [("text", s)] if s else []
        assert role == "us|>er\n" and back == [*text, ("image", 0), ("audio", 1), *text, ("document", 2)]
        assert [(a["ref"], a["tokens"]) for a in found] == [("r1", 8), ("r2", 38), (None, 2400)]


# --- 3 tokens ----------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, sf_dir, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in Q["op3_whole_token_counts"](spark, sf_dir).collect()}
    for d, text, _ in docs:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[d].n_tokens, got[d].n_bytes, got[d].over_limit) == (n, len((text or "").encode()), n > 2048)
    proof = tokencount.prove(path)
    counter = tokencount.Counter(proof)
    letters = "aAbBéÉßİıſKΣς ​\t\n\x0b\x1c\x85\xa0\u3000'’sStTrevmldDL019²½٣,.!?#<|>🙂́à中ǅŉ\x00\u2028ªº"
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14))) + rnd.choice(["", "<|endoftext|>", "<|ENDOFTEXT|>'ll", "'S!!'ve"]) for _ in range(2000)]
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in sorted(proof.whole)[::97])


# --- 4 leaks -----------------------------------------------------------------------------


def test_leaks_of_whole_and_changed_passages(spark, sf_dir, docs, rows_of):
    got = {(r.doc_id, r.item_id) for r in Q["op4_latent_leaks"](spark, sf_dir).collect()}
    items = rows_of("benchmark", "item_id, text")
    want = {(d, i) for d, text, _ in docs for i, t in items if t in (text or "")}
    assert want <= got and len(got) <= len(want) + 3
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    space = leaks.latent_space(d, b)
    (block,) = leaks._item_blocks(b)
    searcher = leaks.Searcher(block, space)
    rnd = random.Random(2)
    vocabulary = [w for _, text, _ in docs[:50] for w in text.split()[:40]]
    found = 0
    for i, t in items:
        words = t.split()
        body = len(words) - max(3, len(words) // 5)
        words = [rnd.choice(vocabulary) if k < body and rnd.random() < 0.2 else w for k, w in enumerate(words)]
        host = rnd.choice(docs)[1].split()[:400]
        at = rnd.randint(0, len(host))
        found += i in [x[1] for x in searcher.leaks([" ".join(host[:at] + words + host[at:])])]
    assert found >= 0.9 * len(items)


def test_space_is_fitted_on_all_documents(spark, monkeypatch):
    """A'(A X) and the number of passages against dense matrices, over more documents than a sample of 20,000."""
    monkeypatch.setattr(leaks, "FIT_WORDS", 1 << 14)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(2500)]
    texts = [" ".join(rnd.choice(words[: rnd.choice([20, 2500])]) for _ in range(rnd.randint(1, 9))) for _ in range(20_500)]
    texts += [None, "", " ".join(rnd.choice(words) for _ in range(3 * leaks.PASSAGE)), " ".join(rnd.choice(words) for _ in range(leaks.PASSAGE + 1))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    fitted = leaks.fit_documents(docs)
    idf, y, n = fitted
    listed = [leaks._ids(grams.tokens([t])[0]) for t in texts]
    df = np.bincount(np.concatenate([np.unique(w) for w in listed]), minlength=leaks.VOCABULARY)
    assert np.allclose(idf, np.log((1 + len(texts)) / (1 + df)), rtol=1e-6)
    passages = [w[i : i + leaks.PASSAGE] for w in listed for i in range(0, len(w), leaks.PASSAGE)]
    assert n == len(passages) > 20_000
    used = np.flatnonzero(df)
    x, want = leaks._sketch()[used].astype(float), np.zeros((len(used), leaks.SKETCH))
    for a in range(0, n, 500):
        rows = np.array([np.bincount(np.searchsorted(used, p), minlength=len(used)) for p in passages[a : a + 500]]) * idf[used].astype(float)
        norm = np.sqrt([max(float((idf[p].astype(float) ** 2).sum()), 1e-9) for p in passages[a : a + 500]])
        rows /= norm[:, None]
        want += rows.T @ (rows @ x)
    assert np.abs(y[used] - want).max() < 1e-5 * np.abs(want).max() and not y[df == 0].any()
    # the same in one process, summed more often
    monkeypatch.setattr(leaks, "_SUMMED", 3000)
    alone = leaks._Moments(idf)
    for part in (listed[:7000], listed[7000:]):
        alone.add(np.concatenate(part), leaks._passage_lengths(np.cumsum([0, *map(len, part)])))
    assert alone.n == n and np.allclose(alone.result(), y, atol=1e-5 * np.abs(want).max())
    # blocks of items share the documents' part
    monkeypatch.setattr(leaks, "fit_documents", lambda _: pytest.fail("fitted again"))
    assert leaks.latent_space(docs, docs.limit(5), fitted).shape == (leaks.VOCABULARY, leaks.RANK)


def test_driver_holds_the_space_and_no_matrix_of_its_fit(spark, sf_dir):
    """Python's peak in the driver, and the space against one made in one process from the whole matrix."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    tracemalloc.start()
    space = leaks.latent_space(docs, bench)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert space.dtype == np.float16 and space.shape == (leaks.VOCABULARY, leaks.RANK) and np.abs(space).max() <= 10_000
    assert peak < 2 * space.nbytes
    idf, y, n = leaks.fit_documents(docs)
    words, at = grams.tokens([r.text for r in bench.collect()])
    items = leaks._Moments(idf)
    items.add(leaks._ids(words), leaks._passage_lengths(at))
    y, x = np.asarray(y).astype(float) + max(1.0, n / items.n) * items.result(), leaks._sketch().astype(float)
    y += np.finfo(np.float32).eps * np.linalg.norm(y) * x
    core = x.T @ y
    axes, lengths, _ = np.linalg.svd(y @ np.linalg.inv(np.linalg.cholesky((core + core.T) / 2)).T, full_matrices=False)
    keep = lengths[: leaks.RANK] ** 2 > 1e-6 * lengths[0] ** 2
    want = idf[:, None] * (axes[:, : leaks.RANK] * np.where(keep, lengths[: leaks.RANK] ** -0.5, 0))
    words, at = grams.tokens([r.text for r in docs.limit(60).collect()])
    ids, at = leaks._ids(words), np.unique(at[:-1])
    cosines = []
    for s in (space.astype(float), want):
        v = np.add.reduceat(s[ids], at, axis=0)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        cosines.append(v @ v.T)
    assert np.abs(cosines[0] - cosines[1]).max() < 1e-3


def test_frequencies_of_more_texts_than_buckets():
    """Sums of one piece of 70,000 short texts, in half the room that 64-bit cells take."""
    texts = pa.array([f"a{i % 7} a{i % 7} b" if i % 3 else None for i in range(leaks.VOCABULARY + 4464)])
    tracemalloc.start()
    found = next(leaks._frequencies(iter([pa.RecordBatch.from_arrays([texts], ["text"])])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = collections.Counter({-1: len(texts)})
    for t in texts.to_pylist():
        want.update(set(leaks._ids(grams.tokens([t])[0]).tolist()))
    assert dict(zip(found["word"].to_pylist(), found["n"].to_pylist(), strict=True)) == want
    assert peak < 20e6


def test_recall_with_thousands_of_items(spark, monkeypatch):
    """Passages at shares of 0.6 to 1, against the longest common subsequence of every region."""
    rnd = random.Random(12)
    read = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").select("text").collect()
    long = [w for r in read if len(w := (r.text or "").split()) > 80]
    texts = []
    for _ in range(1500):
        w, n = rnd.choice(long), rnd.choice([rnd.randint(8, 14), rnd.randint(15, 24), rnd.randint(25, 59)])
        start = rnd.randint(0, len(w) - n)
        texts.append(w[start : start + n])
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "item_id long, text string")
    planted, want = [], collections.defaultdict(set)
    for d in range(400):
        share, i = (1.0, 0.8, 0.7, 0.6)[d % 4], rnd.randrange(len(texts))
        words, host = list(texts[i]), rnd.choice(long)[:300]
        body = len(words) - max(3, len(words) // 5)
        for k in rnd.sample(range(body), min(body, len(words) - math.ceil(share * len(words)))):
            words[k] = rnd.choice(host)
        at = rnd.randint(0, len(host))
        planted.append((d, " ".join(host[:at] + words + host[at:])))
        item, found = leaks.Item(i, grams.tokens([" ".join(texts[i])])[0]), grams.tokens([planted[-1][1]])[0]
        if any(item.shares(found[j : j + item.width * leaks.STRIDE]) for j in range(0, len(found), leaks.STRIDE)):
            want[share].add((d, i))
    docs = spark.createDataFrame(planted, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(docs, bench).select("doc_id", "item_id").collect()}
    assert {s: len(w & got) / len(w) >= 0.97 for s, w in want.items()} == dict.fromkeys(want, True)
    assert min(map(len, want.values())) > 50
    # several passes drop what one pass finds
    few = bench.filter("item_id < 60")
    leaked = {r.doc_id for r in leaks.find_leaks(docs, few).collect()}
    monkeypatch.setattr(leaks, "ITEM_BLOCK", 30)
    monkeypatch.setattr(leaks, "PASS_BLOCKS", 1)
    kept = {r.doc_id for r in leaks.decontaminate(docs, few).collect()}
    assert len(kept & leaked) <= 1 and len(kept) >= 400 - len(leaked) - 2 and leaked


def test_brief_items_are_looked_up_by_their_words():
    """Even in a space where nothing is near anything."""
    words = [f"w{i}" for i in range(400)]
    brief = [words[10:19], words[30:41], words[50:54]]
    items = [leaks.Item(i, grams.tokens([" ".join(w)])[0]) for i, w in enumerate(brief)]
    searcher = leaks.Searcher(items, np.zeros((leaks.VOCABULARY, leaks.RANK), np.float16))
    searcher.gate[:] = 1.0
    host = words[100:180]
    texts = [" ".join([*host[:k], *brief[i][: 5 + i], "other", *brief[i][6 + i :], *host[k:]]) for i in (0, 1) for k in (0, 7, 33, 80)]
    texts += [" ".join([*host[:k], *brief[2], *host[k:]]) for k in (0, 15, 80)] + ["", " ".join(host)]
    assert sorted((d, i) for d, i, *_ in searcher.leaks(texts)) == [(d, d // 4 if d < 8 else 2) for d in range(11)]


def test_common_subsequence_and_its_bounds():
    rnd = random.Random(4)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], (last + 1 if x == y else max(row[j + 1], row[j]))
        return row[-1]

    for _ in range(300):
        a, b = ([rnd.randint(0, 6) for _ in range(rnd.randint(1, 20))] for _ in range(2))
        assert leaks.longest_common(a, leaks.masks_of(b), len(b)) == slow(a, b)


def test_word_bound_before_the_cosine_loses_nothing(monkeypatch):
    """Leaks with the bound equal those without it, for brief, usual and very long items."""
    rnd = random.Random(9)
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(3000)]
    draw = lambda n: [words[int(3000 * rnd.random() ** 3)] for _ in range(n)]
    texts = [draw(n) for n in (3, 8, 12, 15, 20, 40, 60, 250)]
    items = [leaks.Item(i, grams.tokens([" ".join(t)])[0]) for i, t in enumerate(texts)]
    docs = [" ".join(draw(rnd.randint(0, 400))) for _ in range(30)]
    for t in texts:
        for share in (1.0, 0.8, 0.66):
            kept = [w if rnd.random() < share else rnd.choice(words) for w in t]
            docs.append(" ".join(draw(rnd.randint(0, 50)) + kept + draw(rnd.randint(0, 50))))
    space = rng.standard_normal((leaks.VOCABULARY, leaks.RANK))
    found = leaks.Searcher(items, space).leaks(docs)
    assert {f[1] for f in found} >= {2, 3, 4, 5, 6, 7}
    monkeypatch.setattr(leaks.Searcher, "_holding", lambda self, ids, often, width, first, last: np.ones((len(first), len(self.by_width[width][0])), bool))
    whole = leaks.Searcher(items, space).leaks(docs)
    assert {(f[0], f[1], f[3], f[4]) for f in found} == {(f[0], f[1], f[3], f[4]) for f in whole}


# --- 5 near duplicates -------------------------------------------------------------------


def brute_classes(texts):
    """doc -> smallest doc of its class, by comparing all pairs that share a run of words."""
    sets = {d: neardup._multiset(t) for d, t in texts}
    whole = {d: tuple(grams.tokens([t])[0].tolist()) or t for d, t in texts}
    head = {d: d for d, _ in texts}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = [d for d, _ in texts]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = whole[a] == whole[b]
            if not same and len(sets[a][0]) and len(sets[b][0]):
                low, high = neardup.overlap(sets[a], sets[b])
                same = low * 5 >= high * 4
            if same:
                x, y = sorted((root(a), root(b)))
                head[y] = x
    return {d: root(d) for d in ids}


def test_near_duplicates_against_all_pairs(spark, sf_dir, docs):
    got = {r.doc_id: r.class_id for r in Q["op5_bag_minhash"](spark, sf_dir).collect()}
    assert got == brute_classes([(d, t) for d, t, _ in docs])


def test_chains_hot_groups_and_shared_passages(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(80):  # a group of near copies
        w = list(base)
        w[rnd.randrange(120)] = word()
        texts.append(" ".join(w))
    chain = [word() for _ in range(200)]
    for k in range(0, 60, 4):  # each like the next, the ends unlike
        texts.append(" ".join([word() for _ in range(k)] + chain[k:]))
    passage = [word() for _ in range(60)]
    for _ in range(60):  # one passage in otherwise different texts
        texts.append(" ".join(passage + [word() for _ in range(rnd.randint(10, 60))]))
    texts += [texts[3]] * 20 + ["", "", None, None, "?", "?", "!"]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    want = brute_classes(sorted((d, t) for d, t in rows if t is not None))
    assert {d: c for d, c in got.items() if texts[d] is not None} == want
    assert all(got[d] == d for d, t in rows if t is None)


def test_linked_multisets_share_a_rare_key():
    """Any order of the runs will do, as long as it is one for all."""
    rng = np.random.default_rng(8)
    met = 0
    for _ in range(600):
        n = int(rng.integers(1, 400))
        runs = rng.choice(5000, n, replace=False)
        a = dict(zip(runs.tolist(), rng.integers(1, 4, n).tolist(), strict=True))
        b = dict(a)
        for r in rng.choice(runs, int(rng.integers(0, 1 + n // 7)), replace=False).tolist():
            b.pop(r, None)
            if rng.random() < 0.7:
                b[int(rng.integers(5000, 9000))] = 1
        if not b:
            continue
        sets = [(np.array(sorted(x), np.uint64), np.array([x[r] for r in sorted(x)])) for x in (a, b)]
        low, high = neardup.overlap(*sets)
        if 5 * low < 4 * high:
            continue
        met += 1
        (k1, s1), (k2, s2) = (neardup.rare_keys(neardup._elements(*x)) for x in sets)
        theirs = dict(zip(k2.tolist(), s2.tolist(), strict=True))
        assert any(k in theirs and (x != theirs[k] or x == neardup.BOTH) for k, x in zip(k1.tolist(), s1.tolist(), strict=True))
    assert met > 200


def test_passage_shared_by_many_short_texts(spark, monkeypatch):
    """2,000 texts that share a passage, and copies of one text changed here and there, are not paired with each other."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    passage, base = [word() for _ in range(60)], [word() for _ in range(150)]
    texts = [" ".join(passage + [word() for _ in range(rnd.randint(14, 30))]) for _ in range(2000)]
    for _ in range(300):
        w = list(base)
        for i in rnd.sample(range(150), rnd.randint(0, 5)):
            w[i] = word()
        texts.append(" ".join(w))
    pairs = []
    compare = neardup._Linker.compare
    monkeypatch.setattr(neardup._Linker, "compare", lambda self, rows: (pairs.append(rows.count()), compare(self, rows)))
    monkeypatch.setattr(neardup, "CELL", 16)  # many cells
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert sum(pairs) < 4 * len(texts)
    want = brute_classes([(d, t) for d, t in enumerate(texts) if d >= 2000])
    assert {d: c for d, c in got.items() if d >= 2000} == want and len(set(want.values())) > 1
    assert all(got[d] == d for d in range(2000))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    error = []
    for most in (1, 4, 100):
        for _ in range(30):
            e = rng.integers(0, 2**63, 150).astype(np.uint64)
            a = rng.integers(1, most + 1, 150)
            b = np.where(rng.random(150) < 0.8, a, rng.integers(0, most + 1, 150))
            has = b > 0
            owner = np.repeat([0, 1], [150, has.sum()])
            s = minhash.signatures(2, owner, np.concatenate([e, e[has]]), np.concatenate([a, b[has]]))
            error.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.05


# --- 6 secrets ---------------------------------------------------------------------------


def slow_base(text):
    """The contract's patterns, word for word."""
    out = []
    assign = r"""((?:p|P)(?:a|A)(?:s|S)(?:s|S)(?:w|W)(?:o|O)(?:r|R)(?:d|D)|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secret_spans(spark, sf_dir, docs):
    got = {r.doc_id: r for r in Q["op6_markov_secrets"](spark, sf_dir).collect()}
    for d, text, _ in docs:
        base = slow_base(text or "")
        r = got[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        line = ",".join(f"{secretscan.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == [x for x in line.split(",") if x]
    rnd = random.Random(7)
    bits = ["token", "SECRET", "api_key", "ApiKey", "=", ":", " ", '"', "abc", "AKIA", "ABCDEFGH0123", "0123456789abcdef", "ſ", "K", "é", ".-_/+"]
    for _ in range(3000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
        assert [s[:3] for s in secretscan.base_spans(t)] == slow_base(t), t


def test_markov_models_on_held_out_strings(spark):
    rnd = random.Random(8)
    syllables = ["the", "tion", "er", "an", "config", "value", "get", "set", "user", "name", "ing", "on"]
    identifier = lambda: "_".join("".join(rnd.choice(syllables) for _ in range(2)) for _ in range(4))
    secret = lambda: "".join(rnd.choice(secretscan.ALPHABET[:62]) for _ in range(32))
    text = lambda: " ".join(identifier() for _ in range(60)) + f' password = "{secret()}"'
    docs = spark.createDataFrame([(i, text()) for i in range(60)], "doc_id long, text string")
    ratio = secretscan.train(docs)
    found = [bool(secretscan.markov_spans(f"key {secret()} end", [], ratio)) for _ in range(200)]
    wrong = [bool(secretscan.markov_spans(f"key {identifier()} end", [], ratio)) for _ in range(200)]
    assert np.mean(found) > 0.95 and np.mean(wrong) < 0.02


# --- 7 shards ----------------------------------------------------------------------------


def test_shards_are_even_and_gapless(spark, sf_dir, docs):
    rows = Q["op7_histogram_sort"](spark, sf_dir).collect()
    text = {d: t or "" for d, t, _ in docs}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    assert all(r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in rows)
    even = sum(size.values()) / 40
    assert all(abs(size[s] - even) <= largest + 0.01 * even for s in range(40))


def test_splitters_against_sorted_keys(spark):
    rnd = random.Random(9)
    keys = [(rnd.getrandbits(63) - (1 << 62), rnd.getrandbits(63) - (1 << 62), rnd.randint(1, 50)) for _ in range(3000)]
    keys += [(77, rnd.getrandbits(63) - (1 << 62), 20) for _ in range(2000)]  # one hot text
    keys += [(-5, 3, 10)] * 500  # equal rows can't be divided
    total = sum(k[2] for k in keys)
    df = spark.createDataFrame(keys, "h1 long, h2 long, size long")
    splitters = sharding.find_splitters(df, 16, 0.01)
    assert splitters == sorted(splitters) and len(splitters) == 15
    error = [abs(sum(k[2] for k in keys if k[:2] < s) - i * total / 16) for i, s in enumerate(splitters, 1)]
    # the equal rows make up less than a shard, so two boundaries at most are held up by them
    assert max(error) <= 2500 and sum(e > max(0.01 * total / 16, 25) for e in error) <= 2


# --- 8 top-k -----------------------------------------------------------------------------


def test_bounds_hold_and_results_are_exact():
    rng = np.random.default_rng(2)
    q, c = rng.integers(-300, 300, (40, 37)), rng.integers(-300, 300, (500, 37))
    c[::7] = c[0]
    for s in (1, 4, 16, 37):
        bound = topk.segment_statistics(q.astype(float), s) @ topk.segment_statistics(c.astype(float), s).T
        assert (bound >= q @ c.T - 1e-6).all()
    qid, cid = np.arange(40), np.arange(500)
    qi, ci, score = topk.best_in_cell(qid, q, cid, c, 5)
    for i in range(40):
        want = sorted((-int(q[i] @ c[j]), j) for j in range(500) if j != i)[:5]
        assert [(-int(s), int(j)) for s, j in zip(score[qi == i], ci[qi == i], strict=True)] == want


# --- 9 urls ------------------------------------------------------------------------------


def slow_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(x) for x in "/?#" if x in rest] or [len(rest)])
    host = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in rest[:end])
    path = re.split(r"[?#]", rest[end:], maxsplit=1)[0]
    return host, path


def test_url_rules(spark, sf_dir, rows_of):
    got = {r.page_id: r for r in Q["op9_path_templates"](spark, sf_dir).collect()}
    for p, url in rows_of("pages", "page_id, url"):
        host, path = slow_url(url)
        fits = [r for r in queries.URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        assert (got[p].host, got[p].path, got[p].rule) == (host, path, best and best[1] + best[2])
        assert got[p].verdict == best[0] if best else got[p].verdict in ("allow", "block")


def slow_tree(shapes, support):
    """The tree of ``urlfilter.template_tree`` with plain dictionaries."""
    template = {k: "" for k in shapes}
    depth = max(len(s.split("/")) for _, s in shapes)
    for level in range(depth):
        branch = collections.defaultdict(lambda: np.zeros(3))
        for (host, s), v in shapes.items():
            seg = s.split("/")
            if level < len(seg):
                branch[host, template[host, s], seg[level]] += v
        node = collections.defaultdict(lambda: np.zeros(3))
        for (host, t, _), v in branch.items():
            node[host, t] += v
        stays = set()
        for (host, t, seg), (n, labelled, bad) in branch.items():
            _, all_labelled, all_bad = node[host, t]
            a, b, c = bad, labelled - bad, all_bad - bad
            d = all_labelled - labelled - c
            product = (a + b) * (c + d) * (a + c) * (b + d)
            if n >= support and product > 0 and all_labelled * (a * d - b * c) ** 2 / product > urlfilter.SIGNIFICANT:
                stays.add((host, t, seg))
        for host, s in shapes:
            seg = s.split("/")
            if level < len(seg):
                t = template[host, s]
                template[host, s] = f"{t}/{seg[level] if (host, t, seg[level]) in stays else '*'}"
    return template


def test_template_tree(spark):
    rnd = random.Random(10)
    shapes = {}
    for host in ("a.com", "b.org"):
        for first in ("shop", "blog", "en", "x"):
            for second in ("#", "p-#", "tag", ""):
                n = rnd.randint(1, 60)
                labelled = rnd.randint(0, n)
                bad = labelled if first == "shop" else rnd.randint(0, labelled // 3)
                shapes[host, "/".join([first, second])] = np.array([n, labelled, bad])
        shapes[host, "lone"] = np.array([30, 30, 30])
    rows = [(h, s, *map(int, v)) for (h, s), v in shapes.items()]
    df = spark.createDataFrame(rows, "host string, shape string, n long, labelled long, bad long")
    tree = urlfilter.template_tree(df)
    assert {(r.host, r.shape): r.template for r in tree.collect()} == slow_tree(shapes, urlfilter.MIN_SUPPORT)
    purity = {(r.host, r.template): r.purity for r in urlfilter.template_purity(tree).collect()}
    for (host, t), p in purity.items():
        bad = sum(v[2] for k, v in shapes.items() if k[0] == host and slow_tree(shapes, urlfilter.MIN_SUPPORT)[k] == t)
        labelled = sum(v[1] for k, v in shapes.items() if k[0] == host and slow_tree(shapes, urlfilter.MIN_SUPPORT)[k] == t)
        assert p == pytest.approx((bad + 1) / (labelled + 10))


def test_branches_without_labels_are_not_blocked(spark):
    rules = [("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "net", "/it/"), ("block", "net", "/shop/1")]
    paths = [f"/{p}/{i}" for p, n in (("es", 30), ("fr", 30), ("en", 60), ("de", 5), ("it", 3), ("shop", 40)) for i in range(n)]
    paths += [f"/{p}/{i}" for p in ("it", "de") for i in range(3)]
    rows = [(i, f"http://a.net{p}") for i, p in enumerate(paths)]
    got = urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    verdicts = collections.defaultdict(set)
    for r in got:
        verdicts[r.path.split("/")[1], r.rule is not None].add(r.verdict)
    assert len(got) == len(rows)
    assert verdicts["es", True] == verdicts["fr", True] == {"block"} and verdicts["it", True] == {"allow"}
    assert verdicts["en", False] == verdicts["de", False] == {"allow"}
    # 11 of 40 pages have blocked labels of their own, which is what the others are judged by
    assert verdicts["shop", False] == {"block"}
    prior = {r.purity for r in got if r.path.startswith("/en/")}
    assert prior == {urlfilter.PRIOR}


def test_registered_rules_block_no_branch_without_labels(spark, rows_of):
    """Under these rules /en/ and /de/ pages of .net hosts have no labels."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    got = urlfilter.judge(pages, queries.URL_RULES)
    unruled = got.filter("rule is null and host like '%.net'").groupBy("verdict").count().collect()
    assert [r.verdict for r in unruled] == ["allow"] and unruled[0]["count"] > 500


def test_shapes(spark):
    rows = [("/en/853/",), ("/a/0f3c9d2e8b7a6c5d/x.html",), ("",), ("/1/2/3/4/5/6/7/8/9/10",), ("/en/474.html",)]
    got = [r[0] for r in spark.createDataFrame(rows, "p string").select(urlfilter.shape(F.col("p"))).collect()]
    assert got == ["en/#/", "a/{hex}/x.html", "", "#/#/#/#/#/#/#/#/**", "en/#.html"]


# --- 10 mix ------------------------------------------------------------------------------


def test_mix_meets_targets(spark, sf_dir, docs):
    rows = Q["op10_block_mix"](spark, sf_dir).collect()
    again = {r.doc_id: r.taken for r in Q["op10_block_mix"](spark, sf_dir).collect()}
    assert {r.doc_id: r.taken for r in rows} == again
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in docs}
    sizes = collections.Counter()
    for d, _, s in docs:
        sizes[s] += words[d]
    names = sorted(sizes)
    want = dict(zip(names, mixing.targets([sizes[n] for n in names]), strict=True))
    taken = collections.Counter()
    for r in rows:
        assert r.size == words[r.doc_id] and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[n] - want[n]) <= 0.02 * want[n] + 3 * mixing.BLOCK_WORDS for n in names)


def test_targets_are_capped_and_shared_again():
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    got = mixing.targets([10, 1000, 10, 0])
    assert got[0] == 30 and got[2] == 30 and got[3] == 0 and got[1] == pytest.approx(960)


def test_permutations_are_permutations():
    for n in (1, 2, 3, 17, 1000, 4097):
        a = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 12345))
        assert sorted(a.tolist()) == list(range(n))
    a, b = (mixing.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, k)) for k in (1, -2))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def test_draws_have_the_multinomial_mean():
    shares = np.array([0.5, 0.3, 0.15, 0.05])
    drawn = np.array([mixing.draw_counts(33 * 2000, shares, j, 33) for j in range(2000)])
    assert (drawn.sum(axis=1) == 33).all()
    assert np.abs(drawn.mean(axis=0) - 33 * shares).max() < 0.05
