"""Near-duplicate documents by a MinHash LSH forest, confirmed on full shingle sets.

Every distinct shingle set gets ``TREES`` x ``DEPTH`` MinHash values. A tree is the order of all sets by
one run of ``DEPTH`` values; sets that share a long prefix of it stand side by side. The forest is sorted
by Spark into range partitions (the set's id ends the sort key, so any group of copies can be split
between tasks), scanned in blocks, and neighbours that share at least ``MIN_DEPTH`` values become
candidates. Where a region of a tree is sparse, all its pairs lie within the scan's window; where it is
dense, the window holds the neighbours with the longest common prefixes, that is, the depth adapts to the
region. The last rows of a partition are compared with the first of the next in a second small job.

Candidates whose sketches (two bits of every MinHash value) are out of reach of the threshold are
dropped; the rest is confirmed on the full sets: first the best pair of each set, then all
pairs that would still join two components. Regions that hold more sets than the window are then
compared whole: dealt into blocks of about ``DENSE_WINDOW`` sets, every two blocks of a region meet, but
for those within its largest component. There a pair must also pass the parity bits of the full sets: the
places where they differ are at most as many as the tokens that one set has and the other has not, so this
drops no link, and few pairs are left but links. Each set first gives its best partners in other components,
then ``DENSE_MORE`` times as many, until a round has left none out.

Documents with the same set are one node throughout, however many they are. Null or empty texts have an
empty set and link with nothing. A null doc_id never names a component of other documents. Rows that
repeat a doc_id with other texts are nodes of their own. No rows give no rows; columns other than the two
named are ignored. What is stored on the way is deleted at the end.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from touchline.llm.common import give_back, id_text, mix64, shipped, slices
from touchline.llm.components import connected_components
from touchline.session import checkpointed, delete_paths, ensure_checkpoint_dir, recorded

TREES, DEPTH, MIN_DEPTH = 24, 6, 3
#: Rows each way of the first scan; rows in a block of a region that is wider.
WINDOW, DENSE_WINDOW = 32, 512
#: Neighbours that the first scan keeps of a row whose region is wider than the window (compared whole later).
DENSE_KEEP = 2
#: Parity bits of a full set, by which pairs in crowded regions are ruled out.
PARITY_BITS = 512
#: Best partners of a row, by sketch, in the first round over the crowded regions; growth from round to round.
DENSE_BEST, DENSE_MORE = 32, 32
#: Rounds in which each set confirms its best pair of the first scan, before all that is left is confirmed.
BEST_ROUNDS = 1
#: Standard deviations below the threshold at which a sketch is out of reach.
REACH = 4.0
ROWS_A_PARTITION = 100_000
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts one after another, and the texts' bounds in them."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = cut.flatten().dictionary_encode()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.cast(pa.binary()).to_pylist()),
                        np.uint64, len(flat.dictionary))
    words = known[flat.indices.to_numpy()] if len(flat) else np.empty(0, np.uint64)
    bounds = cut.offsets.to_numpy().astype(np.int64) - cut.offsets[0].as_py()
    blank = pc.equal(pc.ascii_trim_whitespace(texts), "").to_numpy(zero_copy_only=False)
    if blank.any():     # a blank text is cut into one empty word
        keep = np.ones(len(words), bool)
        keep[bounds[:-1][blank & (np.diff(bounds) > 0)]] = False
        words, bounds = words[keep], np.r_[0, np.cumsum(np.diff(bounds) - (blank & (np.diff(bounds) > 0)))]
    return words, bounds


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle."""
    words, bounds = word_hashes(texts)
    rolled = words.copy()
    for k in range(1, size):
        rolled[:-k] = mix64(rolled[:-k] * _MULTIPLY + words[k:]) if len(words) > k else rolled[:-k]
    found = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            found.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:     # the whole sequence, told apart from any full shingle by its length
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = mix64(np.array([whole * _MULTIPLY + w], np.uint64))[0]
            found.append(np.array([whole]))
        else:
            found.append(np.empty(0, np.uint64))
    return found


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(29)
    n = TREES * DEPTH
    return (random.integers(0, 1 << 32, n, np.uint32) | np.uint32(1))[:, None], \
        random.integers(0, 1 << 32, n, np.uint32)[:, None]


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each permutation (multiply-add on 32 mixed bits), over blocks of the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 512):
        np.minimum(least, (a * x[k:k + 512] + b).min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, shingle: int = 2) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the set), orders (16 bits a value, tree by tree) and sketch."""
    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
                     ("orders", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations()
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 4 << 20):
                rows = []
                for own in shingle_sets(batch.column("text"), shingle):
                    if len(own):
                        least = minhash(own, a, b)
                        low = mix64(least.astype(np.uint64))
                        rows.append((len(own), _digest(own),
                                     (low >> np.uint64(8)).astype(">u2").tobytes(),
                                     np.packbits(np.r_[low & np.uint64(1), low >> np.uint64(1) & np.uint64(1)]
                                                 .astype(np.uint8)).tobytes()))
                    else:
                        rows.append((0, None, None, None))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(
                    pa.array(c, f.type) for c, f in zip(columns, list(out)[1:]))], schema=out)

    rows = id_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return shipped(rows).mapInArrow(run, "doc_id long, n_shingles long, set_id binary, orders binary, sketch binary")


NODE = "tree int, prefix binary, id long, n long, sketch binary, component long"


def _forest(nodes: DataFrame) -> DataFrame:
    """A row for each node and tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * DEPTH
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                n = batch.num_rows
                orders = np.frombuffer(b"".join(batch.column("orders").to_pylist()), np.uint8)
                prefix = np.ascontiguousarray(orders.reshape(n, TREES, width).transpose(1, 0, 2))
                prefixes = pa.BinaryArray.from_buffers(pa.binary(), n * TREES, [None, pa.py_buffer(
                    np.arange(0, n * TREES * width + 1, width, dtype=np.int32)), pa.py_buffer(prefix.tobytes())])
                again = pa.array(np.tile(np.arange(n), TREES))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(TREES, dtype=np.int32), n)), prefixes,
                     *(batch.column(c).take(again) for c in ("id", "n", "sketch", "component"))],
                    names=["tree", "prefix", "id", "n", "sketch", "component"])

    return shipped(nodes.select("id", "n", "orders", "sketch", "component")).mapInArrow(run, NODE)


class _Rows:
    """Sorted rows of the forest as arrays."""

    def __init__(self, tree, prefix, ids, n, sketch, component):
        self.columns = (tree, prefix, ids, n, sketch, component)
        self.tree, self.prefix, self.ids, self.n, self.sketch, self.component = self.columns

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        def fixed(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1)
        component = pc.fill_null(batch.column("component"), -1).to_numpy()
        return cls(batch.column("tree").to_numpy(), fixed("prefix", ">u2"), batch.column("id").to_numpy(),
                   batch.column("n").to_numpy(), fixed("sketch", np.uint8), component)

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, at) -> _Rows:
        return _Rows(*(c[at] for c in self.columns))

    def plus(self, other: _Rows) -> _Rows:
        return _Rows(*(np.concatenate([a, b]) for a, b in zip(self.columns, other.columns)))


def _pairs(rows: _Rows, first_new: int, window: int, share: float, keep: int, seam: bool = False) -> list[tuple]:
    """Candidates (a, b, matches) among sorted rows whose second row is ``first_new`` or later.

    ``keep``: neighbours of a row whose region is wider than the window; ``seam``: only pairs whose first
    row comes before ``first_new``.
    """
    bits = rows.sketch.shape[1] * 8 // 2
    need = _least_matches(share, bits)
    same_tree = rows.tree
    depth_key = np.ascontiguousarray(rows.prefix[:, :MIN_DEPTH]).view(np.dtype((np.void, 2 * MIN_DEPTH))).ravel()
    wide = np.zeros(len(rows), bool)      # rows whose region is wider than the window
    if len(rows) > window:
        far = np.flatnonzero((depth_key[:-window] == depth_key[window:]) & (same_tree[:-window] == same_tree[window:]))
        wide[far] = wide[far + window] = True
    found = []
    live = np.arange(len(rows))
    for o in range(1, min(window, len(rows) - 1) + 1):
        live = live[live < len(rows) - o]
        live = live[(depth_key[live] == depth_key[live + o]) & (same_tree[live] == same_tree[live + o])]
        if not len(live):
            break
        i = live[live + o >= first_new]
        if seam:
            i = i[i < first_new]
        j = i + o
        if o > keep:
            near = ~wide[i]
            i, j = i[near], j[near]
        ok = np.minimum(rows.n[i], rows.n[j]) >= share * np.maximum(rows.n[i], rows.n[j])
        ok &= (rows.component[i] < 0) | (rows.component[i] != rows.component[j])
        i, j = i[ok], j[ok]
        for k in range(0, len(i), 100_000):
            a, b = i[k:k + 100_000], j[k:k + 100_000]
            differ = rows.sketch[a] ^ rows.sketch[b]
            half = differ.shape[1] // 2
            match = bits - np.bitwise_count(differ[:, :half] | differ[:, half:]).sum(axis=1, dtype=np.int64)
            hit = match >= need
            a, b, match = a[hit], b[hit], match[hit]
            found.append((a, b, match))
    return [(rows.ids[a], rows.ids[b], match) for a, b, match in found]


def _least_matches(share: float, bits: int) -> int:
    p = 0.25 + 0.75 * share
    return int(np.floor(bits * p - REACH * np.sqrt(bits * p * (1 - p))))


def _scan(forest: DataFrame, window: int, share: float, keep: int) -> DataFrame:
    """Candidate rows (kind 0: a, b, estimate) and each partition's outer rows (kind 1, 2: first, last)."""
    schema = f"kind int, part int, a long, b long, estimate int, {NODE}"
    names = [x.split()[0] for x in schema.split(", ")]

    def outer(kind: int, part: int, rows: _Rows) -> pa.RecordBatch:
        n = len(rows)
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), none, none, pa.nulls(n, pa.int32()),
             pa.array(rows.tree, pa.int32()),
             pa.array([p.tobytes() for p in rows.prefix], pa.binary()), pa.array(rows.ids), pa.array(rows.n),
             pa.array([s.tobytes() for s in rows.sketch], pa.binary()), pa.array(rows.component)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _Rows.of(batch)
            rows = held.plus(new) if held is not None else new
            yield from _pair_batches(_pairs(rows, len(rows) - len(new), window, share, keep), part, names)
            if first is None or len(first) < window:
                first = rows[:window] if first is None else first.plus(new)[:window]
            held = rows[-window:]
        if held is not None:
            yield outer(1, part, first)
            yield outer(2, part, held)

    return shipped(forest).mapInArrow(run, schema)


def _pair_batches(found: list[tuple], part: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for a, b, match in found:
        n = len(a)
        if n:
            kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(np.minimum(a, b)),
                 pa.array(np.maximum(a, b)), pa.array(match.astype(np.int32)),
                 *(pa.nulls(n, k) for k in kinds)], names=names)


def candidates(nodes: DataFrame, share: float, window: int, keep: int, name: str) -> DataFrame:
    """Distinct candidate pairs of nodes (a < b) with sketch matches."""
    n = max(1, -(-nodes.count() * TREES // ROWS_A_PARTITION))
    ranged = _forest(nodes).repartitionByRange(n, "tree", "prefix", "id").sortWithinPartitions("tree", "prefix", "id")
    scanned = checkpointed(_scan(ranged, window, share, keep), name)
    inner = scanned.filter("kind = 0").select("a", "b", "estimate")
    edge = scanned.filter("kind > 0")
    edge = edge.withColumn("seam", F.when(F.col("kind") == 1, F.col("part") - 1).otherwise(F.col("part")))

    def seam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "estimate"]
        seams: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:       # a few hundred rows a seam
            for s in set(batch.column("seam").to_pylist()):
                seams.setdefault(s, []).append(batch.filter(pc.equal(batch.column("seam"), s)))
        for parts in seams.values():
            both = pa.Table.from_batches(parts).combine_chunks()
            sides = [_Rows.of(both.filter(pc.equal(both["kind"], k)).combine_chunks().to_batches()[0])
                     for k in (2, 1) if pc.any(pc.equal(both["kind"], k)).as_py()]
            if len(sides) == 2:
                rows = sides[0].plus(sides[1])
                order = np.lexsort((rows.ids, *rows.prefix.T[::-1], rows.tree))
                for a, b, match in _pairs(rows[order], len(sides[0]), window, share, keep, seam=True):
                    if len(a):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                             pa.array(match.astype(np.int32))], names=names)

    across = shipped(edge.repartition("seam")).mapInArrow(seam, "a long, b long, estimate int")
    return inner.unionByName(across).groupBy("a", "b").agg(F.max("estimate").alias("estimate"))


def _crowd(nodes: DataFrame) -> DataFrame:
    """tree, region, id, n and sketch of all rows of the regions that hold more rows than the window."""
    rows = _forest(nodes).withColumn("region", F.substring("prefix", 1, 2 * MIN_DEPTH))
    wide = rows.groupBy("tree", "region").count().filter(F.col("count") > WINDOW).select("tree", "region")
    wide = checkpointed(wide, "op5-regions")
    return checkpointed(rows.select("tree", "region", "id", "n", "sketch")
                        .join(wide, ["tree", "region"], "left_semi"), "op5-crowd")


def parity(hashes: np.ndarray) -> bytes:
    """``PARITY_BITS`` bits, each the parity of the hashes that fall on it."""
    odd = np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _meet(left: tuple, right: tuple | None, share: float, most: int, both: bool) -> tuple:
    """Candidates among two blocks (or one, if ``right`` is None) of a region, and whether any were left out.

    A block is (ids, n, low bits, high bits, component, parity bits). ``most``: best partners taken of each row on the
    right, and on the left too if ``both``.
    """
    other = left if right is None else right
    need = _least_matches(share, TREES * DEPTH)
    found = []
    for k in range(0, len(left[0]), 64):
        ids, n, low, high, component, odd = (c[k:k + 64] for c in left)
        match = np.full((len(ids), len(other[0])), TREES * DEPTH, np.int16)
        for w in range(low.shape[1]):
            match -= np.bitwise_count((low[:, None, w] ^ other[2][:, w]) | (high[:, None, w] ^ other[3][:, w]))
        ok = match >= need
        ok &= np.minimum(n[:, None], other[1]) >= share * np.maximum(n[:, None], other[1])
        ok &= component[:, None] != other[4]
        if right is None:
            ok &= np.arange(k, k + len(ids))[:, None] < np.arange(len(other[0]))
        i, j = np.nonzero(ok)
        for start in range(0, len(i), 100_000):
            a, b = i[start:start + 100_000], j[start:start + 100_000]
            apart = np.bitwise_count(odd[a] ^ other[5][b]).sum(axis=1, dtype=np.int64)
            near = apart * (1 + share) <= (n[a] + other[1][b]) * (1 - share) + 1e-9
            found.append((a[near] + k, b[near], match[a[near], b[near]]))
    if not found:
        return left[0][:0], other[0][:0], np.empty(0, np.int16), False
    i, j, match = (np.concatenate(c) for c in zip(*found))
    stay = np.zeros(len(i), bool)
    if len(i):
        # rows that choose, and their pairs: those on the right, and those on the left behind them
        side, pair = j, np.arange(len(i))
        if both:
            side, pair = np.r_[j, i if right is None else i + len(other[0])], np.r_[pair, pair]
        order = np.lexsort((-match[pair], side))
        begin = np.flatnonzero(np.r_[True, np.diff(side[order]) != 0])
        place = np.arange(len(order)) - np.repeat(begin, np.diff(np.r_[begin, len(order)]))
        stay[pair[order[place < most]]] = True
    return left[0][i[stay]], other[0][j[stay]], match[stay], not stay.all()


def crowded_pairs(crowd: DataFrame, linked: DataFrame, share: float, most: int, odd: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of crowded regions between different components that their sketches and the parity
    bits of their sets (id, odd) allow, with sketch matches and whether others of the same blocks were left out (``more``).

    Every two rows of a region meet unless both are in its largest component, in one of the groups that
    its pairs of blocks make: so no task holds a region, and groups of copies that are linked already cost
    only their rows times the blocks of the others.
    """
    named = checkpointed(crowd.join(linked.withColumnRenamed("node", "id"), "id", "left")
                         .withColumn("component", F.coalesce("component", "id")), "op5-dense")
    parts = named.groupBy("tree", "region", "component").count()
    regions = (parts.groupBy("tree", "region").agg(F.sum("count").alias("size"),
                                                   F.max(F.struct("count", "component")).alias("top"))
               .filter(F.col("size") > F.col("top.count"))
               .select("tree", "region", F.col("top.component").alias("major"),
                       F.ceil(F.col("top.count") / DENSE_WINDOW).alias("p"),
                       F.ceil((F.col("size") - F.col("top.count")) / DENSE_WINDOW).alias("q")))
    regions = checkpointed(regions, "op5-regions")
    inside, salt = F.col("component") == F.col("major"), F.xxhash64("id")
    rows = (named.join(regions, ["tree", "region"]).join(odd, "id")
            .withColumn("inside", inside)
            .withColumn("block", F.when(F.col("inside"), F.pmod(salt, "p")).otherwise(F.col("p") + F.pmod(salt, "q")))
            .withColumn("other", F.explode(F.sequence(F.when(F.col("inside"), F.col("p")).otherwise(F.lit(0)),
                                                      F.col("p") + F.col("q") - 1)))
            .select("tree", "region", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                    "block", "inside", "id", "n", "sketch", "component", "odd"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x, y = table["x"][0].as_py(), table["y"][0].as_py()
        own = table["block"].to_numpy()
        bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(table.num_rows, 2, -1)
        padded = np.zeros((table.num_rows, 2, -(-bits.shape[2] // 8) * 8), np.uint8)
        padded[:, :, :bits.shape[2]] = bits
        padded = padded.view(np.uint64)
        odd = np.frombuffer(b"".join(table["odd"].to_pylist()), np.uint64).reshape(table.num_rows, -1)
        columns = (table["id"].to_numpy(), table["n"].to_numpy(), padded[:, 0], padded[:, 1],
                   table["component"].to_numpy(), odd)
        left = tuple(c[own == x] for c in columns)
        right = None if x == y else tuple(c[own == y] for c in columns)
        found = (np.empty(0, np.int64),) * 3 + (False,)
        if len(left[0]) and (right is None or len(right[0])):
            both = not table["inside"].to_numpy()[own == x].any()      # the largest component is on the left
            found = _meet(left, right, share, most, both)
        a, b, match, more = found
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64()),
                         "estimate": pa.array(match, pa.int32()), "more": pa.array(np.full(len(a), more))})

    found = shipped(rows).groupBy("tree", "region", "x", "y").applyInArrow(
        run, "a long, b long, estimate int, more boolean")
    return found.groupBy("a", "b").agg(F.max("estimate").alias("estimate"), F.max("more").alias("more"))


def confirm(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets have at least the share of their union in common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                hits.append(share[1] * common >= share[0] * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(hits, pa.bool_()))
        give_back()

    both = (pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b"))
    return shipped(both.select("a", "b", "x", "y")).mapInArrow(run, "a long, b long")


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _store_sets(docs: DataFrame, ids: DataFrame, shingle: int, owners: DataFrame | None = None) -> tuple[str, str]:
    """Name and folder of a table with id, sorted hashes and parity bits of the full shingle set of the named
    nodes, stored in buckets of id: they are joined many times over, and bucketed they are never shuffled again.

    ``owners``: a document (owner) and the set_id of each node; without them a node's id is its doc_id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 4 << 20):
                found = shingle_sets(batch.column("text"), shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([s.tobytes() for s in found], pa.binary()),
                     pa.array([_digest(s) if len(s) else None for s in found], pa.binary()),
                     pa.array([parity(s) for s in found], pa.binary())], names=["id", "hashes", "digest", "odd"])

    texts = id_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if owners is None:
        rows = texts.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi")
    else:
        wanted = owners.join(ids, "id", "left_semi")
        rows = texts.join(wanted.select("owner", "id"), F.col("doc_id").eqNullSafe(F.col("owner"))).select("id", "text")
    found = shipped(rows).mapInArrow(run, "id long, hashes binary, digest binary, odd binary")
    if owners is not None:      # rows that repeat the owner's doc_id may have other sets
        found = found.join(wanted.select("id", F.col("set_id").alias("digest")), ["id", "digest"], "left_semi")
    found = found.drop("digest").dropDuplicates(["id"])
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"touchline_sets_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/touchline/{name}"
    found.repartition(n, "id").write.bucketBy(n, "id").sortBy("id").format("parquet").option("path", path).saveAsTable(name)
    return name, path


def near_duplicates(docs: DataFrame, shingle: int = 2, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id) and kept of every document.

    Documents are linked if their sets have ``share[0]`` in ``share[1]`` of the union or more in common.
    """
    return near_duplicates_by_set(docs, shingle, share).drop("set_id")


def with_set_id(docs: DataFrame, name: str, shingle: int = 2) -> DataFrame:
    """``docs`` with the digest of each text's shingle set (null for an empty one) as column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 4 << 20):
                found = [_digest(s) if len(s) else None
                         for s in shingle_sets(batch.column("text"), shingle)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())],
                                                 names=[*batch.schema.names, name])

    return shipped(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def near_duplicates_by_set(docs: DataFrame, shingle: int = 2, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``near_duplicates`` with the digest of their shingle set, set_id."""
    passing: list[str] = []
    with recorded(passing):
        signed = checkpointed(signatures(docs, shingle), "op5-signatures")
        classes = (signed.filter("n_shingles > 0").groupBy("set_id")
                   .agg(F.min("doc_id").alias("owner"), F.first("n_shingles").alias("n"),
                        F.first("orders").alias("orders"), F.first("sketch").alias("sketch"))
                   .withColumn("id", F.monotonically_increasing_id()))
        nodes = checkpointed(classes, "op5-nodes")
        owners = nodes.select("id", "owner", "set_id")
        linked = _links(docs, nodes, shingle, share, owners)
        in_group = owners.join(linked.withColumnRenamed("node", "id"), "id")
        least = in_group.groupBy("component").agg(F.min("owner").alias("_least"))
        named = (owners.join(in_group.join(least, "component").select("id", "_least"), "id", "left")
                 .select("set_id", F.coalesce("_least", "owner").alias("_component")))
        found = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
        component = F.coalesce("_component", "doc_id")
        done = checkpointed(found.select("doc_id", "set_id", "n_shingles", component.alias("component_id"),
                                         F.col("doc_id").eqNullSafe(component).alias("kept")), "op5-classes")
    passing.pop()
    delete_paths(docs.sparkSession, passing)
    return done


def _links(docs: DataFrame, nodes: DataFrame, shingle: int, share: tuple[int, int],
           owners: DataFrame | None = None) -> DataFrame:
    """(node, component) of the sets that are linked with others."""
    least = share[0] / share[1]
    plain = nodes.withColumn("component", F.lit(None).cast("long"))
    pairs = checkpointed(candidates(plain, least, WINDOW, DENSE_KEEP, "op5-forest"), "op5-pairs")
    crowd = _crowd(plain)
    ends = (pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
            .unionByName(crowd.select("id")).distinct())
    spark = docs.sparkSession
    name, path = _store_sets(docs, ends, shingle, owners)
    try:
        return _confirmed(pairs, crowd, spark.table(name), share)
    finally:    # all that was made from it is written by now
        spark.sql(f"DROP TABLE {name}")
        delete_paths(spark, [path])


def _confirmed(pairs: DataFrame, crowd: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(node, component) from the candidates of the forest and those of its crowded regions."""
    spark = pairs.sparkSession
    linked = _join_up(pairs, sets, share, spark.createDataFrame([], "node long, component long"))
    if not crowd.head(1):
        return linked
    tried, most = pairs.select("a", "b"), DENSE_BEST
    odd = checkpointed(sets.select("id", "odd").join(crowd.select("id").distinct(), "id", "left_semi"), "op5-parity")
    while True:
        found = checkpointed(crowded_pairs(crowd, linked, share[0] / share[1], most, odd), "op5-dense-pairs")
        new = checkpointed(found.join(tried, ["a", "b"], "left_anti"), "op5-pairs")
        linked = _join_up(new, sets, share, linked, 0)      # few of them are no links
        if not found.filter("more").head(1):    # every pair is tried or inside one component
            return linked
        tried, most = tried.unionByName(new.select("a", "b")), most * DENSE_MORE


def _apart(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components, with these (ca, cb)."""
    a = linked.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = linked.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .select("a", "b", "estimate", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
            .filter("ca <> cb"))


def _join_up(pairs: DataFrame, sets: DataFrame, share: tuple[int, int], linked: DataFrame,
             best_rounds: int = BEST_ROUNDS) -> DataFrame:
    """The components once the pairs between different ones are confirmed and added; ``linked`` itself if
    that changes nothing.

    First each set confirms its best pair with another component, ``best_rounds`` times over; groups of
    copies are one component by then, and their other pairs need no look. The last round confirms all that
    is left.
    """
    for turn in range(best_rounds + 1):
        apart = checkpointed(_apart(pairs, linked), "op5-apart")
        if not apart.head(1):
            break
        if turn < best_rounds:
            best = F.max(F.struct("estimate", F.col("a").alias("x"), F.col("b").alias("y"))).alias("best")
            picked = apart.groupBy("a").agg(best).select("best").unionByName(apart.groupBy("b").agg(best).select("best"))
            tried = picked.select(F.col("best.x").alias("a"), F.col("best.y").alias("b")).distinct()
            tried = checkpointed(tried, "op5-tried")
        else:
            tried = apart.select("a", "b")
        new = checkpointed(confirm(tried, sets, share), "op5-edges")
        pairs = apart.select("a", "b", "estimate").join(tried, ["a", "b"], "left_anti")
        if new.head(1):
            stars = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))    # settled already
            linked = connected_components(stars.unionByName(new), "op5-components")
    return linked
