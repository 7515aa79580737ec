"""Substring deduplication by suffix automata of reference shards.

A window is ``min_words`` consecutive words. The least hash of the ``ANCHOR``-word runs inside a window
depends on the window alone; consecutive windows that share it form a stretch of fewer than
2 x ``min_words`` words, and equal windows always lie in stretches with the same anchor. Stretches with
an anchor that occurs once are done with; the rest is grouped into shards by anchor, which hold every
place a window of theirs can occur. Each shard's distinct stretches make one suffix automaton with
occurrence counts; the stretches are streamed through it, and the matching statistics (longest ending
that occurs twice) mark the windows that occur elsewhere. Words under a marked window are removed.

The automata are routed to their shard instead of broadcast, because together they grow with the corpus.
Equal stretches are counted with partial aggregation before anything meets, so copies of a passage, in
however many documents, are one stretch. A shard of more than ``SHARD`` distinct stretches (a passage in
a great many surroundings) is split by window content instead: its windows are counted by hash.

Null or empty text: no words. Windows never span documents. Rows that repeat a doc_id are texts of their
own (a repeated row repeats all its windows). No rows give no rows; columns other than the two named are
left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import free, mix64, shipped, slices, text_bytes
from touchline.llm.op5_near_dedup import word_hashes
from touchline.session import checkpointed

MIN_WORDS = 35
SHARD = 1000
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _rolling(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of words times powers of the base, and the inverse powers, for hashes of any span."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    n = len(words)
    powers, back = np.full(n + 1, _BASE), np.full(n + 1, inverse)
    powers[0] = back[0] = 1
    powers, back = np.multiply.accumulate(powers), np.multiply.accumulate(back)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers[:-1], out=sums[1:])
    return sums, back


def _spans(sums: np.ndarray, back: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the word spans [start, end)."""
    return mix64((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64) * _BASE)


def _stretches(words: np.ndarray, size: int) -> tuple[np.ndarray, ...] | None:
    """anchor hash, content hash, first window and number of windows of each stretch of one text."""
    anchor = size // 2 + 1
    n = len(words) - size + 1
    if n < 1:
        return None
    sums, back = _rolling(words)
    at = np.arange(len(words) - anchor + 1)
    grams = _spans(sums, back, at, at + anchor)
    least = np.lib.stride_tricks.sliding_window_view(grams, size - anchor + 1).argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    count = np.diff(np.r_[first, n])
    return grams[least[first]].view(np.int64), _spans(sums, back, first, first + count + size - 1).view(np.int64), \
        first, count


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.crc32(text.cast("binary")).alias("crc"),
                       text.alias("text"))


def stretches(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """anchor, content, doc, crc (of the text), first window and number of windows of every stretch."""
    out = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("crc", pa.int64()),
                     ("first", pa.int32()), ("windows", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 8 << 20):
                words, bounds = word_hashes(batch.column("text"), lower=False)
                found, rows = [], []
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    own = _stretches(words[a:b], size)
                    if own:
                        found.append(own)
                        rows.append(np.full(len(own[0]), k))
                if found:
                    anchor, content, first, count = (np.concatenate(c) for c in zip(*found))
                    row = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(content), batch.column("doc").take(row),
                         batch.column("crc").take(row), pa.array(first, pa.int32()), pa.array(count, pa.int32())],
                        schema=out)

    return shipped(_keyed(docs, id_col, text_col)).mapInArrow(
        run, "anchor long, content long, doc long, crc long, first int, windows int")


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences with weighted numbers of occurrences."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, sequence: list[str], weight: int) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word)
            self.count[last] += weight

    def _extend(self, last: int, word: str) -> int:
        nexts, link, length = self.next, self.link, self.length
        if word in nexts[last]:
            q = nexts[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, q, word)
        new = self._state({}, length[last] + 1, 0)
        p = last
        while p >= 0 and word not in nexts[p]:
            nexts[p][word] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, word)
        return new

    def _state(self, nexts: dict[str, int], length: int, link: int) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, word: str) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def finish(self) -> None:
        """Occurrences of a state include those of the states that link to it."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.count[self.link[state]] += self.count[state]

    def matching(self, sequence: list[str], least: int) -> list[bool]:
        """For each window of ``least`` words of an added sequence: does it occur at least twice?"""
        state, found = 0, []
        for i, word in enumerate(sequence):
            state = self.next[state][word]
            if i + 1 >= least:
                at = state
                while self.length[at] >= least and self.count[at] < 2:
                    at = self.link[at]
                found.append(self.length[at] >= least)
        return found


def _marks(shards: DataFrame, size: int) -> DataFrame:
    """anchor, content and the bit mask of windows that occur elsewhere, from sorted shards."""
    out = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("mask", pa.int64())])

    def shard(rows: list[tuple]) -> list[tuple]:
        automaton = SuffixAutomaton()
        cut = [(anchor, content, words.split(" "), n) for anchor, content, words, n in rows]
        for _, _, words, n in cut:
            automaton.add(words, n)
        automaton.finish()
        return [(anchor, content, sum(1 << i for i, x in enumerate(automaton.matching(words, size)) if x))
                for anchor, content, words, _ in cut]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list[tuple] = []
        for batch in batches:
            done = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now and now[0][0] != row[0]:
                    done += shard(now)
                    now = []
                now.append(row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], schema=out)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*shard(now))], schema=out)

    return shipped(shards.select("anchor", "content", "words", "n")).mapInArrow(run, "anchor long, content long, mask long")


def _fetch(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` stretches (one place of each) with their words and their windows' hashes."""
    lists = wanted.groupBy("doc", "crc").agg(F.collect_list(
        F.struct("anchor", "content", "n", "crowded", "first", "windows")).alias("list"))   # at most a text's words
    rows = _keyed(docs, id_col, text_col).dropDuplicates(["doc", "crc"]).alias("k").join(
        lists.alias("l"), F.col("k.doc").eqNullSafe(F.col("l.doc")) & (F.col("k.crc") == F.col("l.crc")))
    out = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int64()), ("words", pa.string()),
                     ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text"):
                hashes, bounds = word_hashes(batch.column("text"), lower=False)
                found = []
                for k, (text, own) in enumerate(zip(text_bytes(batch.column("text")), batch.column("list").to_pylist())):
                    words = text.split()
                    sums = None
                    for x in own:
                        a, n = x["first"], x["windows"]
                        if x["crowded"]:
                            if sums is None:
                                sums = _rolling(hashes[bounds[k]:bounds[k + 1]])
                            at = np.arange(a, a + n)
                            found.append((x["anchor"], x["content"], x["n"], None,
                                          _spans(*sums, at, at + size).view(np.int64).tolist()))
                        else:
                            found.append((x["anchor"], x["content"], x["n"],
                                          b" ".join(words[a:a + n + size - 1]).decode("utf-8", "replace"), None))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    return shipped(rows.select("k.text", "l.list")).mapInArrow(
        run, "anchor long, content long, n long, words string, hashes array<long>")


def repeated_stretches(docs: DataFrame, size: int = MIN_WORDS, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc, crc and ``marked``: (first window, mask of windows that occur elsewhere) of every text with any."""
    every = stretches(docs, size, id_col, text_col)
    # written, so that the join below reads it through an exchange of its own and Spark can split hot anchors
    seen = checkpointed(every.groupBy("anchor").agg(F.count("*").alias("_n")).filter("_n > 1").select("anchor"),
                        "op9-anchors")
    shared = checkpointed(every.join(seen, "anchor", "left_semi"), "op9-shared")
    distinct = shared.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "crc", "first", "windows")).alias("place"))
    distinct = checkpointed(distinct.select("anchor", "content", "n", "place.*"), "op9-distinct")
    kinds = (distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
             .select("anchor", (F.col("kinds") > SHARD).alias("crowded")))
    fetched = checkpointed(_fetch(docs, distinct.join(kinds, "anchor"), size, id_col, text_col), "op9-words")
    shards = fetched.filter("words is not null").repartition("anchor").sortWithinPartitions("anchor", "content")
    windows = fetched.filter("words is null").select(
        "anchor", "content", "n", F.posexplode("hashes").alias("at", "window"))
    often = (windows.groupBy("anchor", "window").agg(F.sum("n").alias("_n")).filter("_n > 1")
             .select("anchor", "window"))
    counted = (windows.join(often, ["anchor", "window"]).groupBy("anchor", "content")
               .agg(F.expr("bit_or(shiftleft(1L, at))").alias("mask")))
    marks = _marks(shards, size).unionByName(counted)
    full = F.expr("shiftleft(1L, windows) - 1")
    settled = distinct.join(marks, ["anchor", "content"], "left").select(
        "anchor", "content", F.when(F.col("n") > 1, full).otherwise(F.coalesce("mask", F.lit(0))).alias("mask"))
    # written for the same reason: a passage of very many documents is one hot key here
    places = shared.join(checkpointed(settled.filter("mask <> 0"), "op9-settled"), ["anchor", "content"])
    return places.groupBy("doc", "crc").agg(F.collect_list(F.struct("first", "mask")).alias("marked"))


def remove_repeats(docs: DataFrame, size: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                   words: str = "n_words", removed: str = "n_removed", untouched: bool = False) -> DataFrame:
    """``docs`` with the kept words joined by one space as text, and the numbers of words before and removed
    (columns of these names are replaced). ``untouched``: texts that lose nothing stay as they are."""
    base = docs.drop(words, removed)
    mine = {c: free(c, base.columns) for c in ("doc", "crc", "marked")}
    marked = repeated_stretches(docs, size, id_col, text_col)
    marked = marked.select(*[F.col(c).alias(mine[c]) for c in ("doc", "crc", "marked")])
    crc: Column = F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    both = base.join(marked, F.col(id_col).cast("long").eqNullSafe(F.col(mine["doc"])) & (crc == F.col(mine["crc"])),
                     "left").drop(mine["doc"], mine["crc"])
    schema = T.StructType([*base.schema.fields, T.StructField(words, T.LongType()),
                           T.StructField(removed, T.LongType())])
    text_at = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 8 << 20):
            texts, before, gone = [], [], []
            marks = batch.column(len(schema) - 2).to_pylist()
            for raw, own in zip(text_bytes(batch.column(text_at)), marks):
                cut = (raw or b"").split()
                covered = np.zeros(len(cut) + 1, np.int64)
                for x in own or ():
                    for i in range(x["mask"].bit_length()):
                        if x["mask"] >> i & 1:
                            covered[x["first"] + i] += 1
                            covered[x["first"] + i + size] -= 1
                kept = cut if not own else [w for w, c in zip(cut, np.cumsum(covered).tolist()) if not c]
                texts.append(raw if untouched and len(kept) == len(cut) else b" ".join(kept))
                before.append(len(cut))
                gone.append(len(cut) - len(kept))
            columns = list(batch.columns[:-1])
            columns[text_at] = pa.array(texts, pa.binary()).cast(batch.column(text_at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(before, pa.int64()), pa.array(gone, pa.int64())],
                                             names=schema.names)

    return shipped(both).mapInArrow(run, schema)
