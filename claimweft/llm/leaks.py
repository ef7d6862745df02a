"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words are counted over all documents.
2. A randomised SVD of TF-IDF passages gives a latent space for each block of about ``ITEM_BLOCK``
   items, as many as its axes can tell apart. Its fit reads every passage of all documents, once for
   all blocks, together with the block's items, whose passages weigh as much as the documents' in
   all, so that the space keeps what tells them apart. Tasks return A'(A X) for a random X, all that
   the single-pass form needs. It is staged by blocks of words, and tasks take it from there to the
   axes: the driver holds sums of 144 by 144 numbers and the finished half-precision space. Axes are
   divided by the root of their singular values, so that common words don't make unrelated passages alike.
3. Every document is indexed: overlapping windows of each width a benchmark item needs, compared
   with the items by cosine. The least cosine follows from the share of words an item needs and
   from its length in the window. Windows with too few of the rarer words of a group of items to hold a
   leak of any of them are not compared with the group; this loses nothing. Items of less than
   ``EXACT`` words are looked up by their words besides. A pass over the documents takes
   ``PASS_BLOCKS`` blocks of items.
4. A candidate is a leak if the longest common subsequence of its words and the item's is long
   enough, or, for paraphrases, if it is fairly long and the item's ending (its answer) is there too.

Words are as in the other operators (lower case, letters, digits and whatever is not ASCII). Null
or empty texts have no windows and items without words match nothing. Repeated rows and equal
items each count. Texts and items of any length are taken whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.llm import grams
from claimweft.llm.common import pieces_of, stage_table

VOCABULARY = 1 << 16
RANK, SKETCH = 128, 144
PASSAGE = 64
#: Words (different ones of each document) that a task of the fit takes: each task sends a matrix.
FIT_WORDS = 1 << 23
ITEM_BLOCK, PASS_BLOCKS = 256, 8
#: Words between window starts; a window is at least this much wider than its items.
STRIDE = 16
#: Least cosine: this, or less where a leak would have less: words kept are a part ``least`` of the
#: item's and the item a part of its window's, so about least * root(length / width), and a margin.
MIN_COSINE, MARGIN = 0.5, 0.6
#: Least share of an item's words in the common subsequence: alone, and with the answer.
LEAK, PARAPHRASE, ANSWER = 0.7, 0.6, 0.8
#: Shorter items have to be there whole.
SHORT = 8
#: Items with fewer words are also looked up by their words, as a few say little in the latent space.
EXACT = 16
SEED = 11
#: Words of a block of A'(A X), and the blocks.
_WORDS_BLOCK = 256
_WORD_BLOCKS = VOCABULARY // _WORDS_BLOCK
#: Tasks that go over these blocks, which are as many for any input; each makes X and the items' part.
_AXES_TASKS = 3
_CHARS = 1 << 20
#: Words of candidates compared at a time.
_WORDS_AT_ONCE = 1 << 21
#: Passages projected at a time, and summed at a time; words that go through products of whole matrices.
_PASSAGES, _SUMMED, _COMMON = 250, 1 << 15, 512
#: Words gathered at a time in either step, few enough to stay in the processor's cache.
_GATHERED, _SPREAD = 512, 1024
#: Items of a group, and the part of an item's words that a window must hold of its rarest ones.
_GROUP, _RARE = 8, 0.2
_BLOCKS_AT_ONCE = 256


def _ids(words: np.ndarray) -> np.ndarray:
    return (words % np.uint64(VOCABULARY)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(VOCABULARY, np.int64), 0
    for batch in batches:
        texts = batch.column(0).to_pylist()
        n += len(texts)
        for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
            words, at = grams.tokens(texts[a:b])
            for first in range(0, b - a, VOCABULARY):  # a text's place and a word's bucket fit 32 bits
                last = min(first + VOCABULARY, b - a)
                place = np.arange(last - first, dtype=np.uint32) * np.uint32(VOCABULARY)
                cell = np.repeat(place, np.diff(at[first : last + 1])) + _ids(words[at[first] : at[last]]).astype(np.uint32)
                cell.sort()
                once = cell[np.diff(cell, prepend=~cell[:1]) != 0]
                total += np.bincount(once % np.uint32(VOCABULARY), minlength=VOCABULARY)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], ["word", "n"])


def inverse_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(weight by word bucket, number of different words of each document in all), counted over all documents."""
    found = docs.select("text").mapInArrow(_frequencies, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    word, counts = (c.to_numpy() for c in found.columns)
    n, df = int(counts[word < 0].sum()), np.zeros(VOCABULARY)
    df[word[word >= 0]] = counts[word >= 0]
    return np.log((1.0 + n) / (1.0 + df)).astype(np.float32), int(df.sum())


def _passage_lengths(at: np.ndarray) -> np.ndarray:
    """Lengths of the passages of texts whose words begin at ``at``: PASSAGE, and what is left of each text."""
    words = np.diff(at)
    counts = -(-words // PASSAGE)
    lengths = np.full(int(counts.sum()), PASSAGE, np.int64)
    some = counts > 0
    lengths[np.cumsum(counts)[some] - 1] = (words - (counts - 1) * PASSAGE)[some]
    return lengths


class _Moments:
    """A'(A X) of a task's passages: A has their normalised TF-IDF rows.

    The weights of words and the norms of passages are put on X, on A X and on the end's sums, so words are
    only gathered and added; the commonest ones, a large part of all, go through matrix products instead.
    """

    def __init__(self, idf: np.ndarray) -> None:
        self.idf, self.x = idf, _sketch() * idf[:, None]
        self.square = idf.astype(float) ** 2
        self.common = np.argpartition(idf, _COMMON)[:_COMMON]
        self.place = np.full(VOCABULARY, _COMMON, np.int64)  # the rest have a column that is left out
        self.place[self.common] = np.arange(_COMMON)
        self.x_common = self.x[self.common]
        self.total = np.zeros((VOCABULARY, SKETCH), np.float32)
        self.total_common = np.zeros((_COMMON, SKETCH), np.float32)
        self.n = 0
        self._clear()

    def _clear(self) -> None:
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Passages of the given lengths, none empty, that stand one after another in ``ids``."""
        at = np.concatenate([[0], np.cumsum(lengths)])
        for a in range(0, len(lengths), _PASSAGES):
            b = min(a + _PASSAGES, len(lengths))
            self._project(ids[at[a] : at[b]], lengths[a:b])
            if self.waiting >= _SUMMED:
                self._spread()

    def _project(self, words: np.ndarray, lengths: np.ndarray) -> None:
        n = len(lengths)
        owner, place = np.repeat(np.arange(n), lengths), self.place[words]
        norm = np.maximum(np.add.reduceat(self.square[words], np.cumsum(lengths) - lengths), 1e-9)
        counts = np.bincount(owner * (_COMMON + 1) + place, minlength=n * (_COMMON + 1)).reshape(n, _COMMON + 1)
        rare = place == _COMMON
        word, of = words[rare].astype(np.uint16), owner[rare].astype(np.int32)
        some = np.flatnonzero(counts[:, _COMMON])
        ends = np.cumsum(counts[some, _COMMON])
        counts = counts[:, :_COMMON].astype(np.float32)
        y = counts @ self.x_common
        i = start = 0
        while i < len(some):
            j = max(i + 1, int(ends.searchsorted(start + _GATHERED, "right")))
            begins = np.concatenate([[0], ends[i : j - 1] - start])
            y[some[i:j]] += np.add.reduceat(self.x.take(word[start : ends[j - 1]], axis=0, mode="clip"), begins, axis=0)
            i, start = j, int(ends[j - 1])
        y /= norm[:, None].astype(np.float32)
        self.total_common += counts.T @ y
        self.held.append((word, of + np.int32(self.waiting), y))
        self.waiting += n
        self.n += n

    def _spread(self) -> None:
        """Add what the held passages give their words, the same words together."""
        if not self.held:
            return
        word, of, y = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self._clear()
        order = np.argsort(word, kind="stable")
        word, of = word[order], of[order]
        for a in range(0, len(word), _SPREAD):
            part = word[a : a + _SPREAD]
            first = np.flatnonzero(np.diff(part, prepend=~part[:1]))
            self.total[part[first]] += np.add.reduceat(y.take(of[a : a + _SPREAD], axis=0, mode="clip"), first, axis=0)

    def result(self) -> np.ndarray:
        self._spread()
        self.total[self.common] += self.total_common
        return self.total * self.idf[:, None]


def _sum_blocks(rows: pa.Table) -> pa.Table:
    total = np.zeros(_WORDS_BLOCK * SKETCH, np.float32)
    for part in rows.column("part").drop_null():
        total += np.frombuffer(part.as_buffer(), np.float32)
    n = sum(rows.column("n").to_pylist())
    return pa.table({"block": rows.column("block").slice(0, 1), "n": pa.array([n], pa.int64()), "part": pa.array([total.tobytes()], pa.binary())})


@dataclass
class Sums:
    """A'(A X), staged as a row (block, n, part) for each block of words; numpy sees the whole matrix."""

    rows: DataFrame

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        out = np.zeros((_WORD_BLOCKS, _WORDS_BLOCK * SKETCH), np.float32)
        for row in self.rows.toLocalIterator():
            out[row.block] = np.frombuffer(row.part, np.float32)
        return out.reshape(VOCABULARY, SKETCH).astype(dtype or np.float32, copy=False)

    def __getitem__(self, words: np.ndarray) -> np.ndarray:
        return np.asarray(self)[words]


def _sketch() -> np.ndarray:
    """The random matrix X; every task makes the same one from the seed."""
    return np.random.default_rng(SEED).standard_normal((VOCABULARY, SKETCH), dtype=np.float32)


def moments(texts: DataFrame, idf: np.ndarray, tasks: int) -> tuple[Sums, int]:
    """(A'(A X), number of passages) of all passages of ``texts`` (text), read by at most ``tasks`` tasks."""
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(idf)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Moments(sent.value)
        for batch in batches:
            listed = batch.column(0).to_pylist()
            for a, b in pieces_of([len(t or "") for t in listed], _CHARS):
                words, at = grams.tokens(listed[a:b])
                found.add(_ids(words), _passage_lengths(at))
        blocks = found.result().reshape(-1, _WORDS_BLOCK * SKETCH)
        used = np.flatnonzero(blocks.any(axis=1)) if found.n else []
        for k, i in enumerate(used):  # the first block tells the task's passages
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([0 if k else found.n], pa.int64()), pa.array([blocks[i].tobytes()], pa.binary())], ["block", "n", "part"]
            )

    schema = "block int, n long, part binary"
    parts = texts.select("text").coalesce(tasks).mapInArrow(add, schema)
    every = spark.range(0, _WORD_BLOCKS, numPartitions=1).selectExpr("cast(id as int) as block", "0L as n", "cast(null as binary) as part")
    rows = stage_table(parts.union(every).groupBy("block").applyInArrow(_sum_blocks, schema), "moments")
    return Sums(rows), rows.agg(F.sum("n")).first()[0]


def longest_common(region: list[int], masks: dict[int, int], length: int) -> int:
    """Length of the longest common subsequence; ``masks`` has the item's positions of each word."""
    row = full = (1 << length) - 1
    for word in region:
        hit = row & masks.get(word, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass
class Item:
    """A benchmark passage ready for comparison."""

    item_id: int | None
    words: np.ndarray

    def __post_init__(self) -> None:
        listed = self.words.tolist()
        self.length, self.masks, self.sorted = len(listed), masks_of(listed), np.unique(self.words)
        self.answer_length = min(self.length, max(3, self.length // 5))
        self.answer = masks_of(listed[self.length - self.answer_length :])
        self.least = 1.0 if self.length < SHORT else PARAPHRASE
        self.width = -(-self.length // STRIDE) + 1
        self.gate = min(MIN_COSINE, MARGIN * self.least * math.sqrt(self.length / (self.width * STRIDE)))

    def shares(self, region: np.ndarray) -> tuple[float, float] | None:
        """(share of the item, share of its answer) in common, or none if it can't be a leak."""
        known = region[np.isin(region, self.sorted)]
        if len(known) < self.least * self.length:
            return None
        listed = known.tolist()
        share = longest_common(listed, self.masks, self.length) / self.length
        if share < self.least:
            return None
        answer = longest_common(listed, self.answer, self.answer_length) / self.answer_length
        return (share, answer) if share >= LEAK or answer >= ANSWER else None


class Searcher:
    """Windows of documents against one block of items; made once in each task."""

    def __init__(self, items: list[Item], space: np.ndarray) -> None:
        self.items, self.space = items, space.astype(np.float32)
        self.need = np.array([math.ceil(i.least * i.length) for i in items])
        self.has = np.zeros((len(items), VOCABULARY), bool)
        for k, i in enumerate(items):
            self.has[k, _ids(i.words)] = True
        self.by_width: dict[int, tuple[list[int], np.ndarray]] = {}
        for width in sorted({i.width for i in items}):
            chosen = [k for k, i in enumerate(items) if i.width == width]
            vectors = np.stack([self.space[_ids(items[k].words)].sum(axis=0) for k in chosen])
            self.by_width[width] = chosen, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        self.gate = np.array([i.gate for i in items])
        self.brief = np.array([i.length < EXACT for i in items])
        self.groups = {width: self._groups(chosen) for width, (chosen, _) in self.by_width.items()}

    def _groups(self, chosen: list[int]) -> list[list[int]]:
        """Positions in ``chosen`` of items that are alike in need and kind, few at a time."""
        order = sorted(range(len(chosen)), key=lambda c: (self.brief[chosen[c]], self.need[chosen[c]]))
        cuts = [i for i in range(len(order)) if i and self.brief[chosen[order[i]]] != self.brief[chosen[order[i - 1]]]]
        parts = np.split(np.array(order), cuts)
        return [part[i : i + _GROUP].tolist() for part in parts for i in range(0, len(part), _GROUP)]

    def _holding(self, ids: np.ndarray, often: np.ndarray, width: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """(window, item of the width): whether the words [first, last) may hold a leak of the item's group.

        A leak lacks at most length - need of an item's words; of its rarest length - need + q words it
        has q or more. Words of a group are counted together, several groups in one number: a count
        never reaches past its bits, as no window has as many words.
        """
        chosen, groups = self.by_width[width][0], self.groups[width]
        kind = next(k for k in (np.uint8, np.uint16, np.uint32) if (width + 1) * STRIDE < np.iinfo(k).max)
        lanes, bits = 8 // np.dtype(kind).itemsize, 8 * np.dtype(kind).itemsize
        out = np.empty((len(first), len(chosen)), bool)
        for g in range(0, len(groups), lanes):
            table, wanted = np.zeros(VOCABULARY, np.uint64), []
            for lane, group in enumerate(groups[g : g + lanes]):
                marked, least = np.zeros(VOCABULARY, bool), []
                for c in group:
                    item = self.items[chosen[c]]
                    own, need = _ids(item.words), int(self.need[chosen[c]])
                    q = 1 if self.brief[chosen[c]] else max(1, min(need, round(_RARE * item.length)))
                    marked[own[np.argsort(often[own], kind="stable")][: item.length - need + q]] = True
                    least.append(q)
                table |= marked.astype(np.uint64) << np.uint64(lane * bits)
                wanted.append(min(least))
            upto = np.concatenate([[np.uint64(0)], np.cumsum(table[ids], dtype=np.uint64)])
            counts = (upto[last] - upto[first]).view(kind).reshape(-1, lanes)
            for lane, group in enumerate(groups[g : g + lanes]):
                out[:, group] = (counts[:, lane] >= wanted[lane])[:, None]
        return out

    def _enough(self, ids: np.ndarray, k: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Which candidates can be leaks, by two upper bounds of the common subsequence.

        The words of the region that the item has, and the item's words that the region has (by
        bucket, so bounds still hold); many candidates at once, as most fail here.
        """
        out = np.zeros(len(k), bool)
        order = np.argsort(k, kind="stable")  # an item's words at a time
        spread = np.arange(int((last - first).max(initial=0)))
        step = max(1, _WORDS_AT_ONCE // max(1, len(spread)))
        for start in range(0, len(k), step):
            part = order[start : start + step]
            at = first[part, None] + spread
            word = ids[np.minimum(at, len(ids) - 1)]
            known = self.has[k[part, None], word] & (at < last[part, None])
            good = np.flatnonzero(known.sum(axis=1) >= self.need[k[part]])
            for item in np.unique(k[part[good]]):
                rows = good[k[part[good]] == item]
                own, times = np.unique(_ids(self.items[item].words), return_counts=True)
                few = max(1, _WORDS_AT_ONCE // len(own))
                for some in (rows[i : i + few] for i in range(0, len(rows), few)):
                    row, column = np.nonzero(known[some])
                    seen = np.zeros((len(some), len(own)), bool)
                    seen[row, np.searchsorted(own, word[some][row, column])] = True
                    out[part[some[seen @ times >= self.need[item]]]] = True
        return out

    def candidates(self, words: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, item, first word, last word, cosine) arrays of the windows near an item."""
        counts = -(-np.diff(at) // STRIDE)
        block_at = np.concatenate([[0], np.cumsum(counts)])
        if not block_at[-1]:
            return
        owner = np.repeat(np.arange(len(counts)), counts)
        inner = np.arange(block_at[-1]) - block_at[owner]
        first_word = at[owner] + inner * STRIDE
        ids, edges = _ids(words), np.append(first_word, len(words))
        often = np.bincount(ids, minlength=VOCABULARY)
        left = counts[owner] - inner
        windows = {}
        needed = np.zeros(len(first_word) + 1, np.int32)  # up at a window's first block, down behind its last
        for width in self.by_width:
            whole = np.flatnonzero((inner == 0) | (left >= width))
            first = np.maximum(at[owner[whole]], first_word[whole] - STRIDE // 2)
            last = np.minimum(at[owner[whole] + 1], first_word[whole] + width * STRIDE + STRIDE // 2)
            holding = self._holding(ids, often, width, first, last)
            some = np.flatnonzero(holding.any(axis=1))
            start = whole[some]
            windows[width] = start, first[some], last[some], holding[some]
            np.add.at(needed, start, 1)
            np.add.at(needed, start + np.minimum(left[start], width), -1)
        blocks = np.flatnonzero(np.cumsum(needed)[:-1] > 0)
        place = np.cumsum(np.cumsum(needed)[:-1] > 0) - 1
        lengths = edges[blocks + 1] - edges[blocks]
        word = np.arange(lengths.sum()) + np.repeat(edges[blocks] - (np.cumsum(lengths) - lengths), lengths)
        cuts = np.concatenate([[0], np.cumsum(lengths)])
        sums = np.empty((len(blocks), RANK), np.float32)
        for b in range(0, len(sums), _BLOCKS_AT_ONCE):  # few enough to stay in the processor's cache
            e = min(b + _BLOCKS_AT_ONCE, len(sums))
            np.add.reduceat(self.space[ids[word[cuts[b] : cuts[e]]]], cuts[b:e] - cuts[b], axis=0, out=sums[b:e])
        for width, (start, first, last, holding) in windows.items():
            chosen, vectors = self.by_width[width]
            if not len(start):
                continue
            window = sums[place[start]]
            for t in range(1, width):  # never past its text
                more = np.flatnonzero(left[start] > t)
                window[more] += sums[place[start[more]] + t]
            norm = np.sqrt(np.einsum("ij,ij->i", window, window))
            near = window @ vectors.T
            w, c = np.nonzero(((near >= self.gate[chosen] * np.maximum(norm, 1e-9)[:, None]) | self.brief[chosen]) & holding)
            yield owner[start[w]], np.array(chosen)[c], first[w], last[w], near[w, c] / np.maximum(norm[w], 1e-9)

    def leaks(self, texts: list[str | None]) -> list[tuple[int, int | None, float, float, float]]:
        """(text, item_id, cosine, share, answer share) of the leaks of some texts."""
        words, at = grams.tokens(texts)
        ids = _ids(words)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for found in self.candidates(words, at):
            alive = self._enough(ids, found[1], found[2], found[3])
            for doc, k, first, last, cosine in zip(*(x[alive].tolist() for x in found), strict=True):
                shares = self.items[k].shares(words[first:last])
                if shares and ((doc, k) not in best or shares > best[doc, k][1:]):
                    best[doc, k] = (cosine, *shares)
        return [(doc, self.items[k].item_id, *x) for (doc, k), x in sorted(best.items())]


def _blocks(benchmark: DataFrame) -> Iterator[DataFrame]:
    """The benchmark in blocks of about ``ITEM_BLOCK`` items, whatever its size."""
    blocks = max(1, math.ceil(benchmark.count() / ITEM_BLOCK))
    for b in range(blocks):
        yield benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)


def _items(block: DataFrame) -> list[Item]:
    items = [Item(r.item_id, grams.tokens([r.text])[0]) for r in block.select("item_id", "text").collect()]
    return [i for i in items if i.length]


def _item_blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    yield from filter(None, map(_items, _blocks(benchmark)))


def fit_documents(docs: DataFrame) -> tuple[np.ndarray, Sums, int]:
    """(weight by word bucket, A'(A X) of all documents' passages, their number), the same for all blocks."""
    idf, words = inverse_frequencies(docs)
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(words / FIT_WORDS))
    return idf, *moments(docs, idf, tasks)


def _word_blocks(batches: Iterator[pa.RecordBatch], idf: np.ndarray, ids: np.ndarray, lengths: np.ndarray, weight: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block of words, its rows of X, its rows of A'(A X)) in doubles, the items' passages added with their weight."""
    items = _Moments(idf)
    items.add(ids, lengths)
    own = items.result()
    own *= np.float32(weight)
    del items
    x = _sketch()
    for batch in batches:
        for block, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            at = slice(block * _WORDS_BLOCK, (block + 1) * _WORDS_BLOCK)
            y = np.frombuffer(part.as_buffer(), np.float32).reshape(-1, SKETCH) + own[at]
            yield block, x[at].astype(float), y.astype(float)


def _sum_over(y: Sums, fitting: Broadcast, term: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of term(rows of X, rows of A'(A X)), as one row of numbers; each task sends as much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(term(x, own) for _, x, own in _word_blocks(batches, *fitting.value))
        yield pa.RecordBatch.from_arrays([pa.array([np.asarray(total, float).tobytes()], pa.binary())], ["total"])

    found = [np.frombuffer(r.total) for r in y.rows.select("block", "part").coalesce(_AXES_TASKS).mapInArrow(run, "total binary").collect()]
    return sum(t for t in found if len(t) > 1)  # a task without rows has nothing but a zero


def latent_space(docs: DataFrame, benchmark: DataFrame, fitted: tuple[np.ndarray, Sums, int] | None = None) -> np.ndarray:
    """(VOCABULARY, RANK) weights that take word counts to latent coordinates, for a block of items.

    These are the leading eigenvectors of A'A, from Y = A'A X in one pass (Nystrom form), half whitened:
    each axis is divided by the square root of its singular value. Tasks go over the blocks of words,
    in doubles. Half precision, and scaled as a whole, which no cosine sees: it goes to every task.
    """
    idf, y, n = fitted or fit_documents(docs)
    words, at = grams.tokens([r.text for r in benchmark.select("text").collect()])
    lengths = _passage_lengths(at)
    fitting = docs.sparkSession.sparkContext.broadcast((idf, _ids(words), lengths, max(1.0, n / max(1, len(lengths)))))
    xy, xx, yy = _sum_over(y, fitting, lambda x, own: np.stack([x.T @ own, x.T @ x, own.T @ own])).reshape(3, SKETCH, SKETCH)
    size = math.sqrt(np.trace(yy))
    space = np.zeros((_WORD_BLOCKS, _WORDS_BLOCK * RANK), np.float16)
    if not size:
        return space.reshape(VOCABULARY, RANK)
    shift = float(np.finfo(np.float32).eps) * size
    core = xy + shift * xx
    solve = np.linalg.inv(np.linalg.cholesky((core + core.T) / 2)).T
    gram = _sum_over(y, fitting, lambda x, own: (h := (own + shift * x) @ solve).T @ h).reshape(SKETCH, SKETCH)
    values, vectors = np.linalg.eigh(gram)
    values, vectors = values[::-1][:RANK], vectors[:, ::-1][:, :RANK]
    # columns of (y + shift x) @ solve @ vectors have the square root of the value as their length
    scale = np.where(values > 1e-6 * values[0], np.maximum(values, 1e-30) ** -0.75, 0.0)
    # so no weight is above the root of all columns' squares times the largest idf, which becomes 10,000
    scale *= 1e4 / max(float(idf.max()) * math.sqrt(float((scale**2 * np.maximum(values, 0)).sum())), 1e-30)
    turn = solve @ (vectors * scale)

    def axes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = fitting.value[0].reshape(_WORD_BLOCKS, _WORDS_BLOCK, 1)
        for block, x, own in _word_blocks(batches, *fitting.value):
            part = (idf[block] * ((own + shift * x) @ turn)).astype(np.float16)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "part"])

    for row in y.rows.select("block", "part").coalesce(_AXES_TASKS).mapInArrow(axes, "block int, part binary").toLocalIterator():
        space[row.block] = np.frombuffer(row.part, np.float16)
    return space.reshape(VOCABULARY, RANK)


def _passes(docs: DataFrame, benchmark: DataFrame) -> Iterator[list[Broadcast]]:
    """The blocks of items with their spaces, as they go through the documents together."""
    fitted, held = None, []
    for block in _blocks(benchmark):
        items = _items(block)
        if items:
            fitted = fitted or fit_documents(docs)
            held.append(docs.sparkSession.sparkContext.broadcast((items, latent_space(docs, block, fitted))))
        if len(held) == PASS_BLOCKS:
            yield held
            held = []
    if held:
        yield held


def _searchers(sent: list[Broadcast]) -> Callable[[], Iterator[Searcher]]:
    """A way to go through the blocks' searchers; of several, a task holds one at a time."""
    if len(sent) > 1:
        return lambda: (Searcher(*b.value) for b in sent)
    only = [Searcher(*sent[0].value)]
    return lambda: iter(only)


_FOUND = [("item_id", T.LongType()), ("cosine", T.DoubleType()), ("lcs_share", T.DoubleType()), ("answer_share", T.DoubleType())]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answer_share): a row for each row and item that leaked into it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = [n for n, _ in _FOUND]
    schema = T.StructType([rows.schema["doc_id"], *[T.StructField(n, k) for n, k in _FOUND]])
    out = None
    for sent in _passes(docs, benchmark):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searchers = _searchers(sent)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for searcher in searchers():
                    for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
                        found = searcher.leaks(texts[a:b])
                        columns = list(zip(*found, strict=True)) if found else [()] * 5
                        ids = batch.column(0).take(pa.array([a + i for i in columns[0]], pa.int64()))
                        rest = [pa.array(c, pa.int64() if n == "item_id" else pa.float64()) for c, n in zip(columns[1:], names, strict=True)]
                        yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", *names])

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that a benchmark item leaked into; nothing is shuffled.

    With more items than a pass takes, what each pass keeps is written before the next one reads it.
    """
    at, kept = docs.columns.index("text"), None
    for sent in _passes(docs, benchmark):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searchers = _searchers(sent)
            for batch in batches:
                texts = batch.column(at).to_pylist()
                bad = np.zeros(len(texts), bool)
                for searcher in searchers():
                    for a, b in pieces_of([len(t or "") for t in texts], _CHARS):
                        bad[[a + leak[0] for leak in searcher.leaks(texts[a:b])]] = True
                yield batch.filter(pa.array(~bad))

        kept = (docs if kept is None else stage_table(kept, "decontaminated")).mapInArrow(run, docs.schema)
    return docs if kept is None else kept
