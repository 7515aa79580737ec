"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Every Arrow batch is a slice of the corpus: its distinct pre-tokens (matches of the pattern) that the
worker has not seen are put end to end, an inverted index lists for each adjacent token pair the places
where it stands, and the merges are replayed in rank order over the whole slice, updating only the two
neighbours of a merged place. Texts are then put together from the ids of their pre-tokens. No row is
shuffled, and a worker keeps a bounded number of pre-tokens.

Null text: as empty, no ids. Repeated rows are encoded each. No rows give no rows; very long texts pass
whole. Columns other than the two named are ignored.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import id_text, shipped, slices

#: Chunks of text (a word with the space before it, as a rule) and pre-tokens kept with their ids, in two
#: generations of this size.
CACHE_ENTRIES = 250_000
#: Places from which on a merge is applied by array operations.
MANY_PLACES = 40
#: A single space between two characters that are no white space: a pre-token starts there and none spans it.
_SEAM = regex.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Kept(dict):
    """A dict of bounded size: full, it becomes the old generation, from which used entries return."""

    old: dict = {}

    def lacks(self, keys, room: bool = True) -> list:
        """The keys to be learned; makes room first, unless keys are in use."""
        if room and len(self) > CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        missing, old = [], self.old
        for key in keys:
            if key not in self:
                value = old.get(key)
                if value is None:
                    missing.append(key)
                else:
                    self[key] = value
        return missing


class Replay:
    """Merges of a rank table replayed over many words at once.

    All words stand end to end. ``places`` is the inverted index: for each merged token the places whose pair it
    would replace. Merges are taken in rank order; one with many places is applied to all of them by array
    operations, one with few by a loop, and either way only the pairs beside a merged place are looked up anew.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        #: (left << 32 | right) -> merged token, for every split of a token into two
        self.pairs = {ranks[token[:k]] << 32 | ranks[token[k:]]: rank for token, rank in ranks.items()
                      for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.merged = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged token of each pair, -1 where there is none (parts below 0 are none)."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def _start(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]]]:
        """Tokens of all words, each word ended by -1, the bounds of words, and the index of the first pairs."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        token = np.full(len(raw) + len(words) + 1, -1, np.int32)
        token[np.arange(len(raw)) + word] = self.single[raw]
        places: dict[int, list[int]] = {}
        self._note(places, [], self._ranks(token[:-1], token[1:]), np.arange(len(token) - 1))
        return token, np.r_[0, np.cumsum(sizes + 1)], places

    @staticmethod
    def _note(places: dict[int, list[int]], heap: list[int], ranks: np.ndarray, at: np.ndarray) -> None:
        """Add places to the index, by their merged token (-1: none)."""
        some = np.flatnonzero(ranks >= 0)
        if not len(some):
            return
        order = some[np.argsort(ranks[some], kind="stable")]
        ranks, at = ranks[order], at[order].tolist()
        cuts = (np.flatnonzero(np.diff(ranks)) + 1).tolist()
        for a, b, r in zip([0, *cuts], [*cuts, len(at)], ranks[[0, *cuts]].tolist()):
            if r in places:
                places[r] += at[a:b]
            else:
                places[r] = at[a:b]
                heapq.heappush(heap, r)

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; no word is empty."""
        ids, counts = self.flat(words)
        return [own.tolist() for own in np.split(ids, np.cumsum(counts)[:-1])]

    def flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the number of each word's."""
        first, bounds, places = self._start(words)
        n = len(first)
        token, after, before = (array("i", x.astype(np.int32).tobytes()) for x in
                                (first, np.r_[np.arange(1, n), n - 1], np.arange(-1, n - 1)))
        views = tuple(np.frombuffer(x, np.int32) for x in (token, after, before))
        known = self.pairs.get
        heap = list(places)
        heapq.heapify(heap)
        again: set[int] = set()    # places where a merge made a pair that ranks before it
        while heap:
            r = heapq.heappop(heap)
            found = places.pop(r)
            if len(found) >= MANY_PLACES:
                again.update(self._merge(views, r, np.unique(found), places, heap))
                continue
            for i in sorted(found):
                a, j = token[i], after[i]
                if a < 0 or (b := token[j]) < 0 or known(a << 32 | b) != r:
                    continue        # a part went into another merge
                token[i], token[j] = r, -2
                after[i] = k = after[j]
                before[k] = i
                if (b := token[k]) >= 0 and (q := known(r << 32 | b)) is not None:
                    if q in places:
                        places[q].append(i)
                    else:
                        places[q] = [i]
                        heapq.heappush(heap, q)
                    if q < r:
                        again.add(i)
                h = before[i]
                if h >= 0 and (a := token[h]) >= 0 and (q := known(a << 32 | r)) is not None:
                    if q in places:
                        places[q].append(h)
                    else:
                        places[q] = [h]
                        heapq.heappush(heap, q)
                    if q < r:
                        again.add(h)
        left = np.flatnonzero(views[0] >= 0)
        ids = views[0][left]
        counts = np.diff(np.searchsorted(left, bounds))
        if again:
            ids, counts = self._alone(words, ids, counts, np.unique(np.searchsorted(bounds, sorted(again), "right") - 1))
        return ids, counts

    def _merge(self, views: tuple, r: int, at: np.ndarray, places: dict[int, list[int]], heap: list[int]) -> list[int]:
        """Apply a merge to all of its places (ascending); returns those beside which a pair ranks before it."""
        token, after, before = views
        at = at[self._ranks(token[at], token[after[at]]) == r]
        if not len(at):
            return []
        # of places that overlap, as in a run of one letter, every second from the left
        follows = np.r_[False, at[1:] == after[at[:-1]]]
        if follows.any():
            count = np.arange(len(at))
            at = at[(count - np.maximum.accumulate(np.where(follows, 0, count))) % 2 == 0]
        gone = after[at]
        token[at], token[gone] = r, -2
        behind = after[gone]
        after[at] = behind
        before[behind] = at
        ahead = before[at]
        ahead = ahead[ahead >= 0]
        where = np.r_[at, ahead]
        ranks = np.r_[self._ranks(token[at], token[behind]), self._ranks(token[ahead], np.full(len(ahead), r, np.int32))]
        self._note(places, heap, ranks, where)
        return where[(ranks >= 0) & (ranks < r)].tolist()

    def _alone(self, words, ids, counts, which) -> tuple[np.ndarray, np.ndarray]:
        """The result with some words replayed each by itself."""
        ends = np.cumsum(counts)
        parts, at, counts = [], 0, counts.copy()
        for w in which.tolist():
            own = self._one(words[w])
            parts += [ids[at:ends[w] - counts[w]], np.array(own, np.int32)]
            at, counts[w] = ends[w], len(own)
        return np.concatenate([*parts, ids[at:]]), counts

    def _one(self, word: bytes) -> list[int]:
        parts = self.single[list(word)].tolist()
        known = self.pairs.get
        while len(parts) > 1:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := known(parts[i] << 32 | parts[i + 1])) is not None),
                       default=None)
            if best is None:
                break
            parts[best[1]:best[1] + 2] = [best[0]]
        return parts


class Encoder:
    """Ids of whole texts. Texts are cut into chunks at seams and chunks into pre-tokens; the ids of both are
    kept, and the pre-tokens that are new in a batch are merged together."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.replay = Replay(self.ranks)
        self.pattern = regex.compile(pattern)
        self.known = Kept()

    def _learn(self, missing: list[str]) -> None:
        """Ids of chunks: those of the pre-tokens they are cut into (a chunk of letters is one itself)."""
        cut, alone = {}, []
        for chunk in missing:
            if (chunk[1:] if chunk[0] == " " else chunk).isalpha():
                alone.append(chunk)
            else:
                cut[chunk] = self.pattern.findall(chunk)
        new = set(alone).union(*cut.values())
        new, ranks, known = self.known.lacks(new, room=False), self.ranks, self.known
        words, raws = [], []
        for w in new:
            raw = w.encode()
            rank = ranks.get(raw)
            if rank is None:
                words.append(w)
                raws.append(raw)
            else:               # a token of the vocabulary as it is
                known[w] = rank.to_bytes(4, "little")
        if words:
            ids, counts = self.replay.flat(raws)
            flat, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
            known.update(zip(words, map(flat.__getitem__, map(slice, [0, *ends], ends))))
        for chunk, own in cut.items():
            known[chunk] = b"".join([known[w] for w in own])

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32 bytes."""
        cut = [self._chunks(t) for t in texts]
        missing = self.known.lacks(set().union(*cut))
        if missing:
            self._learn(missing)
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]

    def _chunks(self, text: str) -> list[str]:
        """Cuts a text at seams; the chunks' pre-tokens are those of the whole text."""
        if not ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
                or _OTHER_SPACE.search(text)):      # every space is a seam
            first, *rest = text.split(" ")
            return [first, *map(" ".__add__, rest)] if first else []
        at = [0, *(m.start() for m in _SEAM.finditer(text)), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:]) if b > a]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>: the ids of each whole text."""
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault((ranks_path, pattern), None) or Encoder(ranks_path, pattern)
        _ENCODERS[ranks_path, pattern] = encoder
        for batch in slices(batches, "text", 6 << 20):      # Python's strings take some times their bytes
            found = encoder([t or "" for t in batch.column(1).to_pylist()])
            ends = np.r_[0, np.cumsum([len(f) // 4 for f in found])].astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], schema=out)

    rows = id_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return shipped(rows).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids and ``decoded``: the bytes that the ids stand for."""
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = sorted(read_ranks(ranks_path).items(), key=lambda x: x[1])
        tokens = pa.array([t for t, _ in by_rank], pa.binary())
        place = np.full(by_rank[-1][1] + 1, -1)
        place[[r for _, r in by_rank]] = np.arange(len(by_rank))
        sizes = np.array([len(t) for t, _ in by_rank])
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                ids = batch.column("ids")
                at = place[ids.flatten().to_numpy()]
                taken = tokens.take(pa.array(at))
                ends = np.r_[0, np.cumsum(sizes[at])]
                bounds = ids.offsets.to_numpy() - ids.offsets[0].as_py()
                data = taken.buffers()[2] or pa.py_buffer(b"")
                offsets = np.ascontiguousarray(ends[bounds], np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.BinaryArray.from_buffers(
                    pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), data])], schema=out)

    return shipped(encoded.select("doc_id", "ids")).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
