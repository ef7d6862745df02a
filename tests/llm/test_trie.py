"""The conversation trie against a plain dictionary of prefixes."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from claimweft.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", x or ""))
    conv = {c: [turn[2:] for turn in sorted(turns)] for c, turns in conv.items()}
    rebuilt, members, children = {}, collections.defaultdict(list), collections.defaultdict(list)
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = conv.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[b] for b in below)
        ends = ",".join(map(str, sorted(c for c in members[node] if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def nodes_of(df):
    return sorted((tuple(r) for r in trie.prefix_trie(df).select(COLUMNS).collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls in every column, equal turns, a hot conversation, long paths that part late, missing families."""
    rnd = random.Random(7)
    rows = [
        (c, rnd.choice([i, i, None, 3]), rnd.choice(["user", "assistant", None]), rnd.choice(["x y", "z", None, "", " \n", "é" * 70 + "a", "é" * 70 + "b"]))
        for c in [*range(-25, 45), 2**40]
        for i in range(rnd.choice([1, 2, 3, 5, 9, 17, 40]))
    ]
    rows += [(c, i, "user", "same words" if i < end else f"end {c}") for c, end in ((1000, 290), (1010, 300), (1020, 20)) for i in range(300)]
    return rows + [(None, 1, "user", "x")] * 3 + [rows[0]] * 4


def test_nodes_equal_a_plain_trie(spark, odd_rows, monkeypatch):
    df = spark.createDataFrame(odd_rows, "conv_id long, turn long, role string, text string").repartition(5)
    wanted = plain(odd_rows)
    assert nodes_of(df) == wanted
    monkeypatch.setattr(trie, "BAND", 4)  # five levels of bands
    clashing = df.selectExpr("*", "1 as place", "2 as depth", "'x' as k1", "0 as words", "9 as h")
    assert nodes_of(clashing) == wanted


def test_empty_and_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert nodes_of(spark.createDataFrame([], schema)) == []
    assert nodes_of(spark.createDataFrame([(None, 0, "user", "x")], schema)) == []
    rows = [(c, 0, "user", "x") for c in range(1, 15)]  # no conversation 0: those with h > 0 have no turn left
    assert nodes_of(spark.createDataFrame(rows, schema)) == plain(rows)


def test_long_lists_are_digested_in_pieces(spark):
    rows = spark.range(20000).selectExpr("1L as depth", "2L as k1", "id % 2 as k2", "cast(id * 7919 % 20011 as long) as conv_id")
    want = collections.defaultdict(list)
    for r in rows.collect():
        want[r.k2].append(r.conv_id)
    got = {r.k2: r.digest for r in trie.digest_of_lists(rows.repartition(6)).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
