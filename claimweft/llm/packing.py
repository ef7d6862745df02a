"""Packing of documents, in order, into sequences of a fixed length by dynamic programming.

Documents follow each other by doc_id (null first), each as its token ids and an end id. Windows cut
this stream where a document ends (free), where a sentence ends (``SENTENCE``) or, where no sentence
ends for ``STEP`` tokens, at every ``STEP``-th token (``FORCED``). A window of a power of two is not
padded, any other is padded to ``LIMIT``; the cuts are those with the least sum of padding, penalties and
``WINDOW`` a window. The best window to end at a cut is the least of cost + position over the cuts of
the last ``LIMIT`` tokens, which a monotone queue gives at once, or one of the few cuts exactly a power
of two before it.

The stream is dealt out in ranges of (doc_id, text), one task each. A task packs about ``RUN`` tokens
at a time and takes the unsettled end of a run into the next one, so only its last window is short
of choice, and memory is bounded by ``RUN`` and the longest text.

Token ids are those of the tokenizer library: white space always separates its pre-tokens (tried
when an encoder is made), so a text's ids are those of its pieces between white space. A worker keeps the
ids of up to ``KEPT`` pieces that it has met, finds them by 64-bit hashes and compares their bytes. New
pieces of proven code points are cut here and merged by the library's model, others are encoded whole by
the library.

A null text is empty: one end id. Repeated rows are separate documents. An empty table has no pieces.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.llm import grams
from claimweft.llm.common import fresh, pieces_of
from claimweft.llm.tokencount import PLAIN_END, Proof, _load, prove

LIMIT, END = 4096, 2
#: Penalties, in padded tokens.
SENTENCE, FORCED, WINDOW = 8, 64, 1
#: Longest run of tokens without a place to cut; shortest unpadded window that is looked for.
STEP, SHORTEST = 512, 256
RUN = 1 << 20
#: Bytes encoded at a time, and pieces between white space and pre-tokens kept in a task's memory.
_CHARS, KEPT = 1 << 19, 300_000
_CLOSERS, _ENDS, _INNER_ENDS = "\"')]}»”’」』", tuple(".!?…。！？"), "。！？"
_TAIL = frozenset((*_CLOSERS, *_ENDS))
_SOLID = np.ones(256, bool)
_SOLID[list(b" \t\n\r\x0b\x0c")] = False
_DOCUMENT, _SENTENCE, _FORCED = 0, 1, 2


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranges [start, start + count), one after the other."""
    before = np.cumsum(counts, dtype=starts.dtype) - counts
    out = np.repeat(starts - before, counts)
    out += np.arange(len(out), dtype=out.dtype)
    return out


class _Lists:
    """A list of numbers for each of the numbers 0, 1, ..."""

    def __init__(self, kind: type) -> None:
        self.size = 0
        self.starts, self.counts = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, kind)

    def put(self, numbers: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        """The list of ``numbers[i]`` is the next ``counts[i]`` of ``flat``."""
        while len(numbers) and numbers[-1] >= len(self.counts):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        while self.size + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.counts[numbers] = counts
        self.starts[numbers] = self.size + np.cumsum(counts) - counts
        self.flat[self.size : self.size + len(flat)] = flat
        self.size += len(flat)

    def put_lists(self, numbers: np.ndarray, lists: Sequence[Sequence[int]]) -> None:
        flat = np.fromiter(itertools.chain.from_iterable(lists), self.flat.dtype)
        self.put(numbers, np.fromiter(map(len, lists), np.int32, len(lists)), flat)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the lists of ``numbers`` one after the other, their counts)."""
        counts = self.counts[numbers]
        return self.flat[ragged(self.starts[numbers], counts)], counts

    def only(self, numbers: np.ndarray) -> _Lists:
        out = _Lists(self.flat.dtype.type)
        flat, counts = self.take(numbers)
        out.put(np.arange(len(numbers)), counts, flat)
        return out


class _Numbers:
    """Numbers 64-bit hashes in the order in which they are added (open addressing)."""

    def __init__(self, bits: int = 16) -> None:
        self.n = 0
        self.keys, self.slots = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.hashes = np.zeros(1 << bits, np.uint64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Their numbers, -1 for unknown ones."""
        mask = np.uint64(len(self.keys) - 1)
        at = (hashes & mask).astype(np.int64)
        out = self.slots[at]
        far = np.flatnonzero((out >= 0) & (self.keys[at] != hashes))
        while len(far):
            at[far] = (at[far] + 1) & int(mask)
            out[far] = self.slots[at[far]]
            far = far[(out[far] >= 0) & (self.keys[at[far]] != hashes[far])]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """New, distinct hashes get the next numbers."""
        while 3 * (self.n + len(hashes)) > len(self.keys):
            bigger = _Numbers(len(self.keys).bit_length())
            bigger.add(self.hashes[: self.n])
            self.keys, self.slots, self.hashes = bigger.keys, bigger.slots, bigger.hashes
        mask = len(self.keys) - 1
        at = (hashes & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.slots[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            done = free[first]
            self.keys[at[done]], self.slots[at[done]] = hashes[done], self.n + done
            left = left[self.slots[at[left]] != self.n + left]
            at[left] = (at[left] + 1) & mask
        self.hashes[self.n : self.n + len(hashes)] = hashes
        self.n += len(hashes)


class _Words(dict):
    """Numbers words in order of their first use; counts uses."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []
        self.uses = np.zeros(1 << 16, np.int64)

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number

    def numbers(self, keys: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, keys), np.int32, len(keys))
        while len(self) > len(self.uses):
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.uses[: len(self)] += np.bincount(out, minlength=len(self))
        return out


def _most_used(uses: np.ndarray, limit: int) -> np.ndarray:
    """At most ``limit`` of those used more than once, the most used ones."""
    chosen = np.flatnonzero(uses > 1)
    return chosen if len(chosen) <= limit else np.sort(chosen[np.argpartition(-uses[chosen], limit)[:limit]])


class Encoder:
    """Ids of whole texts as the library gives them, and the token places where sentences end."""

    def __init__(self, proof: Proof) -> None:
        from tokenizers import pre_tokenizers

        self.tokenizer = _load(proof.path)
        for space in " \t\n\r\x0b\x0c":
            if self._whole(f"a,{space}b") != self._whole("a,") + self._whole("b"):
                raise ValueError(f"white space {space!r} does not separate this tokenizer's pre-tokens")
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # how the library writes the bytes of each plain character
        self.written = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(PLAIN_END)}
        self.find = re.compile(f"{proof.split}|\n").findall
        special = "" if not proof.special else f"|{proof.special}"
        self.odd = re.compile(r"[^\n]" if proof.special is None else f"{proof.unproven}{special}").search
        self.forget()

    def forget(self) -> None:
        #: pieces between white space: their numbers, bytes, ids, and token places behind which a sentence ends
        self.known, self.uses = _Numbers(), np.zeros(1 << 16, np.int64)
        self.bytes, self.ids, self.ends = _Lists(np.uint8), _Lists(np.int32), _Lists(np.int32)
        self.words, self.merged = _Words(), _Lists(np.int32)

    def _thin(self) -> None:
        """Common pieces and words stay, those met once go."""
        chosen = _most_used(self.uses[: self.known.n], KEPT // 2)
        hashes, uses = self.known.hashes[chosen], np.zeros(max(len(chosen), 1 << 16), np.int64)
        uses[: len(chosen)] = self.uses[chosen] // 2
        self.known, self.uses = _Numbers(), uses
        self.known.add(hashes)
        self.bytes, self.ids, self.ends = (x.only(chosen) for x in (self.bytes, self.ids, self.ends))
        chosen = _most_used(self.words.uses[: len(self.words)], KEPT // 2)
        words, keys = _Words(), list(self.words)
        words.numbers([keys[i] for i in chosen.tolist()])
        words.new, words.uses[: len(chosen)] = [], self.words.uses[chosen] // 2
        self.words, self.merged = words, self.merged.only(chosen)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _inner_ends(self, text: str) -> list[int]:
        """Places inside a piece after which a sentence of a script without white space ends."""
        offsets = self.tokenizer.encode(text, add_special_tokens=False).offsets
        return [i + 1 for i, (a, b) in enumerate(zip(offsets, offsets[1:])) if text[a[1] - 1] in _INNER_ENDS and b[0] >= a[1]]

    def _learn(self, raw: list[bytes], numbers: np.ndarray) -> None:
        """Ids and sentence ends of new pieces."""
        self.bytes.put(numbers, np.fromiter(map(len, raw), np.int32, len(raw)), np.frombuffer(b"".join(raw), np.uint8))
        joined = b"\n".join(raw).decode("utf-8", "replace")
        texts = joined.split("\n")
        odd = [i for i, t in enumerate(texts) if self.odd(t)] if self.odd(joined) else []
        plain = texts.copy()
        for i in odd:
            plain[i] = ""
        words = self.words.numbers(self.find("\n".join(["", *plain]).lower()))  # each piece behind a line end
        if self.words.new:
            new, self.words.new = self.words.new, []
            split = [() if w == "\n" else [t.id for t in self.model.tokenize(w if w.isascii() and w.isprintable() else w.translate(self.written))] for w in new]
            self.merged.put_lists(np.arange(len(self.words) - len(new), len(self.words)), split)
        ids, counts = self.merged.take(words)
        piece = np.cumsum(words == self.words["\n"]) - 1
        total = np.bincount(piece, weights=counts, minlength=len(raw)).astype(np.int32)
        self.ids.put(numbers, total, ids)
        if odd:
            found = [self._whole(texts[i]) for i in odd]
            self.ids.put_lists(numbers[odd], found)
            total[odd] = [len(f) for f in found]
        ends = np.array([t[-1] in _TAIL and t.rstrip(_CLOSERS)[-1:] in _ENDS for t in texts]) & (total > 0)
        self.ends.put(numbers, ends.astype(np.int32), total[ends])
        inner = [i for i in odd if any(c in texts[i] for c in _INNER_ENDS)]
        if inner:
            self.ends.put_lists(numbers[inner], [self._inner_ends(texts[i]) + [int(total[i])] * bool(ends[i]) for i in inner])

    def encode(self, texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets by text, places in ids where a sentence ends)."""
        if max(self.known.n, len(self.words), self.ids.size // 8) > KEPT:
            self._thin()
        # strings of the tokenizer's own, which begin with "<", are told apart by case
        raw = [(t if b"<" in t else t.lower()) if t else b"" for t in texts]
        buffer = b" ".join(raw)
        data = np.frombuffer(buffer, np.uint8)
        solid = _SOLID[data]
        edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        hashes = grams.span_hashes(data, starts, ends)
        numbers = self.known.find(hashes)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            some, first, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            before, at = self.known.n, new[first]
            self.known.add(some)
            self._learn([buffer[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], np.arange(before, self.known.n))
            numbers[new] = before + back
        while self.known.n > len(self.uses):
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.uses[: self.known.n] += np.bincount(numbers, minlength=self.known.n)
        if not np.array_equal(self.bytes.take(numbers)[0], data[solid]):
            # two pieces with one hash: one text at a time, or else one piece at a time, after a new start
            self.forget()
            return self._apart([[t] for t in texts] if len(texts) > 1 else [[p] for p in raw[0].split()], len(texts) > 1)
        ids, counts = self.ids.take(numbers)
        begins = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        places, marks = self.ends.take(numbers)
        places = places + np.repeat(begins[:-1], marks)
        return ids, begins[np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in raw)]))], places

    def _apart(self, parts: list[list[bytes | None]], by_text: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = []
        for part in parts:
            found.append(self.encode(part))
            self.forget()
        sizes = np.cumsum([0, *(len(f[0]) for f in found)])
        places = np.concatenate([f[2] + n for f, n in zip(found, sizes, strict=False)])
        return np.concatenate([f[0] for f in found]), sizes if by_text else sizes[[0, -1]], places


@functools.lru_cache(maxsize=1)
def encoder_of(proof: Proof) -> Encoder:
    """One encoder a worker process, which may run many tasks."""
    return Encoder(proof)


def cut_points(begin: np.ndarray, end: np.ndarray, places: np.ndarray, closed: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(positions, kinds), ascending: ends of documents, of sentences, and every STEP-th token between.

    Documents lie in [begin, end) of one stream without gaps; ``closed`` says whether the last one ends here.
    A sentence that ends with its document, or one token before, is no place of its own.
    """
    owner = np.searchsorted(end, places, side="left")
    places = np.unique(places[places < end[owner] - 1]) if len(places) else places
    at = np.concatenate([places, end])
    kind = np.concatenate([np.full(len(places), _SENTENCE), np.full(len(end), _DOCUMENT)])
    if not closed:
        kind[-1] = _FORCED
    order = np.argsort(at, kind="stable")
    at, kind = at[order], kind[order]
    before = np.concatenate([begin[:1], at[:-1]])
    extra = (at - before - 1) // STEP
    more = np.repeat(before, extra) + STEP * (ragged(np.ones(len(extra), np.int64), extra))
    at, kind = np.concatenate([at, more]), np.concatenate([kind, np.full(len(more), _FORCED)])
    order = np.argsort(at, kind="stable")
    return at[order], kind[order]


def best_cuts(at: np.ndarray, kind: np.ndarray, limit: int = LIMIT) -> list[int]:
    """Window ends with the least cost, as ascending indices into ``at``; the stream begins at 0.

    Neighbouring points are no more than ``limit`` apart. The last point is always an end.
    """
    points = np.concatenate([[0], at])
    exact: list[list[int]] = [[] for _ in points]
    length = SHORTEST
    while length < limit:
        found = np.searchsorted(points, points - length)
        for j in np.flatnonzero(points[found] == points - length).tolist():
            exact[j].append(int(found[j]))
        length *= 2
    penalty = [0, *np.array([0, SENTENCE, FORCED])[kind].tolist()]
    pos = points.tolist()
    cost, came = [0] * len(pos), [0] * len(pos)
    queue, head = [0], 0  # indices whose cost + position rises
    level = [0] * len(pos)  # cost + position
    for j in range(1, len(pos)):
        here = pos[j]
        while pos[queue[head]] < here - limit:
            head += 1
        i = queue[head]
        least = level[i] + limit - here
        for e in exact[j]:
            if cost[e] < least:
                least, i = cost[e], e
        cost[j], came[j] = least + penalty[j] + WINDOW, i
        level[j] = own = cost[j] + here
        while len(queue) > head and level[queue[-1]] >= own:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(pos) - 1
    while j:
        cuts.append(j - 1)
        j = came[j]
    return cuts[::-1]


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Packer:
    """The stream of one task; documents go in, settled pieces come out."""

    def __init__(self, first_sequence: int, limit: int = LIMIT, run: int = RUN) -> None:
        self.sequence, self.limit, self.run = first_sequence, limit, run
        self.size = 0
        self.ids: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        self.kind: list[np.ndarray] = []
        #: begin in the stream, tokens, doc_id, whether doc_id is null
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, at: np.ndarray, kind: np.ndarray, docs: tuple[np.ndarray, ...] | None) -> Iterator[pa.RecordBatch]:
        """The stream goes on with ``ids``; ``at`` and the documents' begins count from their first."""
        self.ids.append(ids.astype("<u4"))
        self.at.append(at + self.size)
        self.kind.append(kind)
        if docs is not None:
            self.docs.append((docs[0] + self.size, *docs[1:]))
        self.size += len(ids)
        if self.size >= self.run:
            yield from self.settle(self.size - 4 * self.limit)

    def settle(self, upto: int) -> Iterator[pa.RecordBatch]:
        """Pieces of the windows that end at ``upto`` or before; the rest of the stream stays."""
        if not self.size:
            return
        ids, at, kind = (np.concatenate(x) for x in (self.ids, self.at, self.kind))
        begin, tokens, doc, none = (np.concatenate(x) for x in zip(*self.docs, strict=True))
        ends = at[best_cuts(at, kind, self.limit)]
        ends = ends[ends <= upto]
        done = int(ends[-1]) if len(ends) else 0
        if done:
            windows = np.concatenate([[0], ends[:-1]])
            edges = np.unique(np.concatenate([windows, begin[(begin > 0) & (begin < done)]]))
            owner = np.searchsorted(begin, edges, side="right") - 1
            window = np.searchsorted(windows, edges, side="right") - 1
            length = np.diff(np.append(edges, done))
            offsets = np.append(edges, done).astype(np.int32) * 4
            raw = pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(ids[:done].tobytes())])
            longs = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[owner], pa.int64(), mask=none[owner]), longs(edges - begin[owner]), longs(length), raw,
                 longs(tokens[owner]), longs(self.sequence + window), longs(edges - windows[window])], _NAMES,
            )
            self.sequence += len(ends)
        left, open_docs = at > done, begin + tokens > done
        self.size -= done
        self.ids, self.at, self.kind = [ids[done:]], [at[left] - done], [kind[left]]
        self.docs = [(begin[open_docs] - done, tokens[open_docs], doc[open_docs], none[open_docs])]

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.settle(self.size)


def segments(raw: bytes) -> Iterator[bytes]:
    """A text in parts of about ``_CHARS`` bytes, cut at white space."""
    start = 0
    while start < len(raw):
        found = re.compile(rb"\s").search(raw, start + _CHARS)
        stop = found.start() if found else len(raw)
        yield raw[start:stop]
        start = stop


def _add_long(packer: Packer, encoder: Encoder, raw: bytes, doc: tuple[int, bool], end: int) -> Iterator[pa.RecordBatch]:
    """A long text goes in part by part; its tokens are counted first."""
    total = 1 + sum(len(encoder.encode([s])[0]) for s in segments(raw))
    fresh_doc = (np.array([0]), np.array([total]), np.array([doc[0]]), np.array([doc[1]]))
    seen = 0
    for part in segments(raw):
        ids, _, places = encoder.encode([part])
        seen += len(ids)
        if seen == total - 1:
            ids = np.append(ids, end)
            seen += 1
        if not len(ids):
            continue
        at, kind = cut_points(np.array([0]), np.array([len(ids)]), places, closed=seen == total)
        yield from packer.add(ids, at, kind, fresh_doc)
        fresh_doc = None


def pack(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END) -> DataFrame:
    """One row a piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    sent = docs.sparkSession.sparkContext.broadcast(prove(path))
    digest, tie = fresh(docs.select("doc_id", "text"), "digest", "tie")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        F.xxhash64("text").alias(digest), F.monotonically_increasing_id().alias(tie),
    )
    order = [F.col("doc_id").asc_nulls_first(), digest, tie]
    rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value)
        packer = Packer(TaskContext.get().partitionId() << 33, limit)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            none = np.asarray(batch.column(0).is_null())
            numbers = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in pieces_of([len(t or b"") for t in texts], _CHARS):
                if b - a == 1 and len(texts[a] or b"") > 4 * _CHARS:
                    yield from _add_long(packer, encoder, texts[a], (numbers[a], none[a]), end)
                    continue
                ids, at, places = encoder.encode(texts[a:b])
                tokens = np.diff(at) + 1
                stop = np.cumsum(tokens)
                shift = np.repeat(np.arange(b - a), np.diff(at))
                whole = np.full(len(ids) + b - a, end, np.int32)
                whole[np.arange(len(ids)) + shift] = ids
                # a sentence's end counts the end ids of the documents before
                places = places + np.searchsorted(at, places, side="left") - 1
                points = cut_points(stop - tokens, stop, places)
                yield from packer.add(whole, *points, (stop - tokens, tokens, numbers[a:b], none[a:b]))
        yield from packer.finish()

    return rows.mapInArrow(run, _SCHEMA)
