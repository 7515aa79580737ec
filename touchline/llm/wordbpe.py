"""Token ids of many texts by a word-level BPE vocabulary file, merging the distinct words in bulk."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Ids of unusual words kept from one call to the next; emptied when full.
CACHE_ENTRIES = 100_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """Pair merges of a vocabulary file, applied to many words at once.

    Each round merges, in every word, all places of its lowest-ranked pair; only pairs next to a merged
    place are looked up again. A merge's parts are older than the merge, so a new pair never has a lower
    rank than the one just merged and rounds give what merging one place at a time gives.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        symbols = byte_symbols()
        self.inner = np.array([vocabulary[s] for s in symbols], np.int32)
        self.last = np.array([vocabulary[s + suffix] for s in symbols], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.none = len(pairs)
        size = int(max(self.inner.max(), self.last.max())) + 1
        self.first = self._rank(*np.divmod(np.arange(size * size), size)).reshape(size, size)   # of single bytes

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], np.int32(self.none))

    def __call__(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and their number in each word; ``raw`` holds the words'
        bytes, ``sizes`` their lengths (over 0)."""
        ends = np.cumsum(sizes)
        ids = self.inner[raw]
        ids[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        rank = np.full(len(ids), self.none, np.int32)
        rank[:-1] = self.first[ids[:-1], ids[1:]]
        rank[ends - 1] = self.none
        done_ids, done_words = [], []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            of = np.repeat(least, np.diff(np.r_[starts, len(ids)]))
            ended = of == self.none
            done_ids.append(ids[ended])
            done_words.append(word[ended])
            go = ~ended
            ids, word, rank, of = ids[go], word[go], rank[go], of[go]
            if not len(ids):
                break
            at = np.flatnonzero(rank == of)
            if (np.diff(at) == 1).any():   # places overlap: of a run of places the first, third and so on
                begin = np.r_[True, np.diff(at) != 1]
                run = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
                at = at[run % 2 == 0]
            ids[at] = self.made[rank[at]]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            touched = np.zeros(len(ids), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            ids, word, rank, touched = ids[stay], word[stay], rank[stay], touched[stay]
            again = np.flatnonzero(touched)
            rank[again] = self.none
            again = again[again < len(ids) - 1]
            again = again[word[again] == word[again + 1]]
            rank[again] = self._rank(ids[again], ids[again + 1])
        if not done_ids:
            return np.empty(0, np.int64), np.zeros(0, np.int64)
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(sizes))


def joined(values: np.ndarray, counts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs of ``values`` (of the given lengths) named by ``index``, one after another."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    runs = pa.ListArray.from_arrays(offsets, values.astype(np.int32))
    return runs.take(pa.array(index)).flatten().to_numpy()


class WordEncoder:
    """Ids of whole texts.

    The vocabulary's normaliser and splitter never look across white space, so a text's ids are those of
    its white-space separated chunks; each distinct chunk of a call is encoded once. Chunks of printable
    ASCII (without apostrophes) and Latin-1 letters are lower-cased, cut where the kind of character
    changes and merged in bulk; all other chunks, and those with a string of a special token (which the
    library takes for that token), go through the tokenizers library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.unusual: dict[bytes, np.ndarray] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and their number in each text. Null: as empty."""
        cut = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        chunks = cut.flatten().dictionary_encode()
        index = chunks.indices.to_numpy()
        ids, counts = self._distinct(chunks.dictionary.cast(pa.binary()))
        ends = np.r_[0, np.cumsum(counts[index])]
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        return joined(ids, counts, index), np.diff(ends[bounds])

    def _distinct(self, chunks: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset:chunks.offset + len(chunks) + 1]
        raw = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        sizes = np.diff(offsets).astype(np.int64)
        after = np.r_[False, raw[:-1] == 0xC3] & (raw & 0xC0 == 0x80)      # second byte of a Latin-1 letter
        plain = ((raw > 0x20) & (raw < 0x7F) & (raw != 0x27) | (raw == 0xC3)
                 | after & (raw != 0x97) & (raw != 0xB7))
        of = np.repeat(np.arange(len(sizes)), sizes)
        plain &= ~(np.r_[(raw[:-1] == 0x3C) & (raw[1:] == 0x7C), False] if len(raw) else plain)      # <|: a special token
        odd = np.bincount(of[~plain], minlength=len(sizes)) > 0
        keep = ~odd[of]
        ids, counts = self._plain(raw[keep], after[keep], of[keep], len(sizes))
        if odd.any():
            at = np.flatnonzero(odd)
            found = self._unusual(chunks.take(pa.array(at)).to_pylist())
            own = np.full(len(sizes), len(ids))
            own[~odd] = np.r_[0, np.cumsum(counts)[:-1]][~odd]
            starts = len(ids) + np.r_[0, np.cumsum([len(f) for f in found])]
            own[at], counts[at] = starts[:-1], np.diff(starts)
            ids = np.concatenate([ids, *found])
            # runs in the order of the chunks
            order = np.repeat(own - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
            ids = ids[order]
        return ids, counts

    def _plain(self, raw, after, of, n) -> tuple[np.ndarray, np.ndarray]:
        if not len(raw):
            return np.empty(0, np.int64), np.zeros(n, np.int64)
        upper = (raw >= 0x41) & (raw <= 0x5A) | after & (raw < 0x9F)
        raw = np.where(upper, raw + 0x20, raw).astype(np.uint8)
        digit = (raw >= 0x30) & (raw <= 0x39)
        letter = (raw >= 0x61) & (raw <= 0x7A) | (raw >= 0x80)
        kind = letter + 2 * digit
        start = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | digit[1:] | (of[1:] != of[:-1])])
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(
            np.r_[start, len(raw)].astype(np.int32)), pa.py_buffer(raw)]).dictionary_encode()
        distinct = pieces.dictionary
        sizes = pc.binary_length(distinct).to_numpy().astype(np.int64)
        ids, each = self.merges(np.frombuffer(distinct.buffers()[2], np.uint8)[:sizes.sum()], sizes)
        index = pieces.indices.to_numpy()
        counts = np.bincount(of[start], each[index], minlength=n).astype(np.int64)
        return joined(ids, each, index), counts

    def _unusual(self, chunks: list[bytes]) -> list[np.ndarray]:
        if len(self.unusual) > CACHE_ENTRIES:
            self.unusual.clear()
        new = [c for c in chunks if c not in self.unusual]
        found = self.tokenizer.encode_batch([c.decode("utf-8", "replace") for c in new], add_special_tokens=False)
        self.unusual.update((c, np.array(e.ids, np.int64)) for c, e in zip(new, found))
        return [self.unusual[c] for c in chunks]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
