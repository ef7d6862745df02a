"""Ranked search against plain integer arithmetic."""

import collections
import math
import re

import numpy as np
import pytest

from claimweft.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    tfs = [(d, collections.Counter(words(t))) for d, t in docs]
    tfs = [(d, c) for d, c in tfs if c]
    n_docs, n_terms = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = collections.Counter(w for _, c in tfs for w in c)
    out = []
    for item, text in set(items):
        asked = collections.Counter(words(text))
        found = []
        for d, c in tfs:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w, q in asked.items() if w in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, k=10, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as places", "3 as score").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as slot", "2 as part")
    return sorted((tuple(r) for r in lexical.search(d, i, k, **more).collect()), key=str)


def test_ranks_equal_plain_arithmetic(spark, rows_of):
    docs = rows_of("documents", "doc_id, text")
    docs = docs + docs[:7] + [(None, docs[3][1]), (None, None), (-5, ""), (900, "ÀÉ àé İ ß 9٣ a_b É")] + [(10_000 + i, "tie tie") for i in range(40)]
    items = rows_of("benchmark", "item_id, text")[:12] + [(100, None), (101, "?!"), (None, docs[0][1]), (102, "tie"), (102, "tie"), (102, "Tie unknownword"), (103, "àé ÀÉ É a_b"),
             (104, " ".join(["tie"] * 9)), (105, docs[1][1])]
    wanted = plain(docs, items, 10)
    assert got(spark, docs, items) == wanted
    assert got(spark, docs, items, group_terms=60) == wanted  # many groups
    assert got(spark, docs, items, k=25) == plain(docs, items, 25)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == [] and got(spark, [(1, None)], [(1, "")]) == []


def test_heavy_weights_and_many_terms_stay_exact():
    """Repeats beyond one matrix entry and more terms than a block has: equal to whole-number products."""
    rnd = np.random.default_rng(1)
    n_terms = 3 * lexical.TILE_TERMS + 5
    items = [(np.arange(n_terms), rnd.integers(0, 10**9, n_terms)), (np.array([4, n_terms - 1]), np.array([10**12, 3])), (np.empty(0, int), np.empty(0, int))]
    owner, place = np.nonzero(rnd.random((9, n_terms)) < 0.3)
    impact = rnd.integers(0, lexical.IMPACT, len(owner)).astype(float)
    total = np.zeros((9, 3), object)
    for tile in lexical.tiles_of(items, n_terms):
        total[:, tile.items] += lexical.scores(tile, owner, place, impact, 9)
        assert all(np.abs(b.weights).sum(axis=0).max() * lexical.IMPACT < 2**53 and len(b.terms) <= lexical.TILE_TERMS for b in tile.blocks)
    for i, (places, weights) in enumerate(items):
        by_place = dict(zip(places.tolist(), weights.tolist(), strict=True))
        for d in range(9):
            mine = owner == d
            assert total[d, i] == sum(by_place.get(p, 0) * int(x) for p, x in zip(place[mine].tolist(), impact[mine].tolist(), strict=True))


@pytest.mark.parametrize("k", [1, 3, 50])
def test_lists_of_the_best_with_many_ties(k):
    rnd = np.random.default_rng(k)
    found, doc, none = rnd.integers(0, 4, (200, 6)), rnd.permutation(200), rnd.random(200) < 0.1
    best = lexical.Best(6, k)
    for a in range(0, 200, 33):
        best.add(found[a : a + 33], doc[a : a + 33], none[a : a + 33])
    for item in range(6):
        want = sorted((-s, bool(o), d) for s, d, o in zip(found[:, item].tolist(), doc.tolist(), none.tolist(), strict=True) if s > 0)[:k]
        mine = best.item == item
        assert sorted(zip((-best.score[mine]).tolist(), best.none[mine].tolist(), best.doc[mine].tolist(), strict=True)) == want
