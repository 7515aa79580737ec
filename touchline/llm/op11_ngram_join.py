"""Jaccard join of n-gram sets by prefix filters under several global token orders.

If two sets are at least as alike as the threshold, then under *any* total order of all tokens their
prefixes (the first n - ceil(t n) + 1 tokens) share a token. A pair is therefore a candidate only if it
shares prefix tokens under each of ``ORDERS`` different orders. Order k ranks the tokens of its own region
of the hash space (``REGION`` of 16 parts) first, the rarer the earlier, and the others behind them by
hash; so frequencies are counted for a region only, and orders have little in common.

1. The first order is applied to all distinct sets by counting alone: a set whose prefix holds only tokens
   of no other set has no partner. Tokens travel as packed blocks, one for a slab of sets and part of the
   region, each distinct token once a slab, so a token that a third of all documents have costs a row a slab.
2. For the sets that are left, all orders are built exactly: tokens, their frequencies (pre-aggregated) and
   each set's prefix. Sets without a shared prefix token under some order leave.
3. Postings of one order give pairs, the prefixes under the others must overlap too, and what passes is
   confirmed on full sets. Pairs that their sizes, tokens of their own or parity bits rule out are never made. Each posting
   list first tries a hub with all its members, ``HUB_ROUNDS`` times over; groups of copies are one component
   by then, and only pairs between components are tried in full.

No link is lost: the filters are exact, and every pair they leave between two components is confirmed.
Documents with the same set are one node. Null, empty or blank texts have an empty set, link with nothing
and are their own component. Rows that repeat a doc_id with other texts are nodes of their own; a null
doc_id never names a component of other documents. No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import give_back, id_text, shipped, slices
from touchline.llm.components import connected_components
from touchline.llm.op5_near_dedup import shingle_sets
from touchline.session import checkpointed, delete_paths, recorded

ORDERS = 3
#: Sixteenths of the hash space in the region of an order; a prefix of a fifth of a set lies in it as a rule.
REGION = 5
#: Tokens in a slab, and tokens counted at once by a task.
SLAB_TOKENS, PART_TOKENS = 1 << 19, 1 << 21
HUB_ROUNDS = 1
PARITY_BITS = 512
_TOP24 = REGION << 20       # first value of the upper 24 bits behind the first region


def prefix_length(n, share: tuple[int, int]):
    """Tokens of a set of n (an int or an array) of which a partner must have one among its own first ones."""
    return n - -(-share[0] * n // share[1]) + 1


def index_length(n, share: tuple[int, int]):
    """The same for the smaller set of a pair."""
    return n - -(-2 * share[0] * n // (share[0] + share[1])) + 1


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def parity(tokens: np.ndarray) -> list[int]:
    """``PARITY_BITS`` bits, each the parity of the tokens that fall on it. Where the bits of two sets differ, a
    token is in one of them only: the number of such places is at most the size of their difference."""
    odd = np.bincount((tokens & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def _pack(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of each token."""
    return np.ascontiguousarray(tokens.astype("<u8").view("<u2").reshape(-1, 4)[:, 1:]).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 4), "<u2")
    out[:, :3] = np.frombuffer(packed, "<u2").reshape(-1, 3)
    return out.view("<u8").ravel()


def signed_sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, set_id (digest of the set) and packed tokens of the first region of every document."""
    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()), ("packed", pa.binary())])
    end = np.uint64(REGION << 60)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 4 << 20):
                sets = shingle_sets(batch.column("text"), size)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([_pack(s[:np.searchsorted(s, end)]) if len(s) else None for s in sets], pa.binary())],
                    schema=out)

    rows = id_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return shipped(rows).mapInArrow(run, "doc_id long, n long, set_id binary, packed binary")


def _slab_rows(sets: DataFrame, parts: int) -> DataFrame:
    """A row for each slab of sets and part of the region: distinct tokens, how often they occur in the slab,
    and a set of the slab that has them. The row of part 0 also names the slab's sets and their sizes."""
    out = pa.schema([("part", pa.int32()), ("slab", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary()),
                     ("owners", pa.binary()), ("set_ids", pa.binary()), ("sizes", pa.binary()), ("n_sets", pa.int32())])

    def slab(number: int, ids: list[bytes], sizes: list[int], packed: list[bytes]) -> pa.RecordBatch:
        tokens = _unpack(b"".join(packed))
        owner = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(p) // 6 for p in packed])
        distinct, first, count = np.unique(tokens, return_index=True, return_counts=True)
        cuts = np.searchsorted((distinct >> np.uint64(24)).astype(np.int64) * parts // _TOP24, np.arange(parts + 1))
        fields = [distinct.astype("<u4"), np.minimum(count, 255).astype(np.uint8), owner[first]]
        rows = []
        for p in range(parts):
            a, b = cuts[p], cuts[p + 1]
            if b > a or p == 0:
                rows.append((p, number, *(f[a:b].tobytes() for f in fields),
                             *((b"".join(ids), np.array(sizes, "<i8").tobytes()) if p == 0 else (None, None)), len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, sizes, packed, held = [], [], [], 0
        for batch in batches:
            for i, n, p in zip(*(batch.column(c).to_pylist() for c in ("set_id", "n", "packed"))):
                ids.append(i)
                sizes.append(n)
                packed.append(p)
                held += len(p) // 6
                if held >= SLAB_TOKENS:
                    yield slab(number, ids, sizes, packed)
                    number, ids, sizes, packed, held = number + 1, [], [], [], 0
        if ids:
            yield slab(number, ids, sizes, packed)
        del ids, sizes, packed
        give_back()

    return shipped(sets).mapInArrow(run, "part int, slab long, tokens binary, counts binary, owners binary, "
                                         "set_ids binary, sizes binary, n_sets int")


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of one key after another, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and keys[a] != now:
                    yield pa.Table.from_batches(held)
                    held = []
                now = keys[a]
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _lonely_counts(slabs: DataFrame) -> DataFrame:
    """For each slab and part, how many tokens each of the slab's sets has there that no other set has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "part"):
            blocks = [np.frombuffer(t, "<u4") for t in table["tokens"].to_pylist()]
            counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint8)
            every = np.concatenate(blocks)
            order = np.argsort(every, kind="stable")
            put = every[order]
            alone = np.ones(len(put), bool)
            alone[1:] &= put[1:] != put[:-1]
            alone[:-1] &= put[1:] != put[:-1]
            lonely = np.empty(len(put), bool)
            lonely[order] = alone
            lonely &= counts == 1
            at, found = 0, []
            for block, owners, n in zip(blocks, table["owners"].to_pylist(), table["n_sets"].to_pylist()):
                own = np.frombuffer(owners, "<u4")[lonely[at:at + len(block)]]
                found.append(np.bincount(own, minlength=n).astype("<i4").tobytes())
                at += len(block)
            yield pa.RecordBatch.from_arrays(
                [table["slab"].combine_chunks(), pa.array(found, pa.binary()), table["set_ids"].combine_chunks(),
                 table["sizes"].combine_chunks()], names=["slab", "lonely", "set_ids", "sizes"])
            del table, blocks, every, order, put
        give_back()

    return shipped(slabs).mapInArrow(run, "slab long, lonely binary, set_ids binary, sizes binary")


def _possible(counted: DataFrame, share: tuple[int, int]) -> DataFrame:
    """set_id of the sets whose prefix under the first order is not made of tokens of their own alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "slab"):
            ids = b"".join(x for x in table["set_ids"].to_pylist() if x)
            n = np.frombuffer(b"".join(x for x in table["sizes"].to_pylist() if x), "<i8")
            own = np.zeros(len(n), np.int64)
            for x in table["lonely"].to_pylist():
                own += np.frombuffer(x, "<i4")
            left = np.flatnonzero(own < prefix_length(n, share))
            yield pa.RecordBatch.from_arrays([pa.array([ids[16 * i:16 * i + 16] for i in left], pa.binary())],
                                             names=["set_id"])

    return shipped(counted).mapInArrow(run, "set_id binary")


def possible_sets(signed: DataFrame, share: tuple[int, int]) -> DataFrame:
    """set_id of the distinct sets that the first order leaves."""
    some = signed.filter("n > 0")
    total = some.agg(F.sum(F.octet_length("packed") / 6).cast("long")).first()[0] or 0
    parts = max(int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_TOKENS))
    parts = min(parts, _TOP24)
    one = (some.groupBy("set_id").agg(F.first("n").alias("n"), F.first("packed").alias("packed"))
           .sortWithinPartitions("set_id"))     # the same slabs whenever a task is run again
    dealt = _slab_rows(one, parts).repartition(parts, "part").sortWithinPartitions("part", "slab")
    back = _lonely_counts(dealt).repartition("slab").sortWithinPartitions("slab")
    return _possible(back, share)


def full_sets(docs: DataFrame, signed: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node (a number of its own), set_id, n, sorted tokens (8 bytes each) and parity bits of the wanted sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, "text", 4 << 20):
                sets = [s for s in shingle_sets(batch.column("text"), size) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([parity(s) for s in sets], pa.list_(pa.int64()))], names=["set_id", "n", "tokens", "bits"])

    owners = (signed.join(wanted, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("_owner"))
              .select("_owner").distinct())
    texts = id_text(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(owners, F.col("doc_id").eqNullSafe(F.col("_owner")), "left_semi").select("text")
    found = shipped(texts).mapInArrow(run, "set_id binary, n long, tokens binary, bits array<long>")
    one = found.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(*(F.first(c).alias(c) for c in ("n", "tokens", "bits")))
    return one.withColumn("node", F.monotonically_increasing_id())


def _order_tokens(sets: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """The tokens of region k of each set, and behind them as many others as its prefix still needs (with
    their place among these)."""
    first, end = np.uint64(k * REGION << 60), np.uint64((k + 1) * REGION << 60)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                rows = []
                for node, n, raw in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "tokens"))):
                    own = np.frombuffer(raw, "<u8")
                    a, b = np.searchsorted(own, first), np.searchsorted(own, end)
                    late = np.r_[own[b:], own[:a]][:max(0, int(prefix_length(n, share)) - (b - a))]
                    rows.append((np.r_[own[a:b], late], node, n, b - a,
                                 np.r_[np.full(b - a, -1), np.arange(len(late))]))
                if rows:
                    tokens, nodes, n, region, place = zip(*rows)
                    times = [len(t) for t in tokens]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view("<i8")),
                         *(pa.array(np.repeat(np.array(x, np.int64), times)) for x in (nodes, n, region)),
                         pa.array(np.concatenate(place).astype(np.int64))],
                        names=["token", "node", "n", "region", "place"])
        give_back()

    return shipped(sets.select("node", "n", "tokens")).mapInArrow(
        run, "token long, node long, n long, region long, place long")


def order_prefixes(sets: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """node, n, how many tokens of the region no other set has (``lonely``), the tokens of its prefix under
    order k that other sets have too (``prefix``, in order), and how many of them belong to the shorter prefix
    of the smaller set of a pair (``inner``).

    A token of a single set takes its place in a prefix but is in no posting list.
    """
    tokens = _order_tokens(sets, k, share)
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    rows = tokens.join(shared, "token")
    early = F.col("place") < 0
    lists = rows.groupBy("node", "n", "region").agg(
        F.sort_array(F.collect_list(F.struct("place", "df", "token"))).alias("own"),
        F.sum(early.cast("long")).alias("seen"))
    lonely, place = F.col("region") - F.col("seen"), F.col("own.place")
    length = F.expr(f"n - ceil({share[0]}bd * n / {share[1]}bd) + 1")
    shorter = F.expr(f"n - ceil({2 * share[0]}bd * n / {share[0] + share[1]}bd) + 1")
    # of the region's tokens the shared ones stand behind the lonely ones, of the others each has its place
    late = F.size(F.filter(place, lambda p: (p >= 0) & (p < length - F.col("region"))))
    late_short = F.size(F.filter(place, lambda p: (p >= 0) & (p < shorter - F.col("region"))))

    def first(limit: Column, of_late: Column) -> Column:
        return (F.least(F.col("seen"), F.greatest(limit - lonely, F.lit(0))) + of_late).cast("int")

    counted = lists.select("node", "n", lonely.alias("lonely"), F.col("own.token").alias("tokens"),
                           first(length, late).alias("long"), first(shorter, late_short).alias("inner"))
    return counted.filter("long > 0").select("node", "n", "lonely", F.slice("tokens", F.lit(1), F.col("long")).alias("prefix"),
                                             "inner")


def _near_enough(n: str, m: str, c: str, d: str, share: tuple[int, int]) -> Column:
    """Whether sets of n and m tokens, c and d of them not theirs alone, can be as alike as the threshold."""
    most = F.least(c, d)
    return most * share[1] >= (F.col(n) + F.col(m) - most) * share[0]


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that overlap under the other orders as well and are alike on their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                hits.append(share[1] * common >= share[0] * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(hits, pa.bool_()))
        give_back()

    others = [f"prefix{k}" for k in range(1, ORDERS)]
    near = pairs
    for end in ("a", "b"):
        near = near.join(nodes.select(F.col("node").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in others)), end)
    for c in others:
        near = near.filter(F.arrays_overlap(f"a_{c}", f"b_{c}"))
    for end, name in (("a", "x"), ("b", "y")):
        near = near.select("a", "b", *(["x"] if end == "b" else [])).join(
            sets.select(F.col("node").alias(end), F.col("tokens").alias(name)), end)
    return shipped(near.select("a", "b", "x", "y")).mapInArrow(run, "a long, b long")


def _other_pairs(live: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of different components that a posting list holds and whose sizes, own tokens and parity
    bits allow the threshold. The largest component of a list meets only the others, never itself."""
    names = [f"b{i}" for i in range(PARITY_BITS // 64)]
    bits = sets.select("node", *(F.get("bits", i).alias(x) for i, x in enumerate(names)))
    top = (live.groupBy("token", "component").agg(F.count("*").alias("size"))
           .groupBy("token").agg(F.max_by("component", F.struct("size", "component")).alias("top")))
    rows = checkpointed(live.join(top, "token").join(bits, "node"), "op11-live")
    columns = ["node", "n", "c", "component", "indexed", *names]
    left = rows.filter("component <> top").select("token", *(F.col(c).alias(f"l_{c}") for c in columns))
    right = rows.select("token", "top", *(F.col(c).alias(f"r_{c}") for c in columns))
    once = (F.col("r_component") == F.col("top")) | (F.col("l_node") < F.col("r_node"))
    less = (F.col("l_n") < F.col("r_n")) | ((F.col("l_n") == F.col("r_n")) & (F.col("l_node") < F.col("r_node")))
    apart = sum((F.bit_count(F.col(f"l_{x}").bitwiseXOR(F.col(f"r_{x}"))) for x in names), F.lit(0))
    close = apart * (share[0] + share[1]) <= (F.col("l_n") + F.col("r_n")) * (share[1] - share[0])
    return (left.join(right, "token")
            .filter((F.col("l_component") != F.col("r_component")) & once
                    & F.when(less, F.col("l_indexed")).otherwise(F.col("r_indexed"))
                    & _near_enough("l_n", "r_n", "l_c", "r_c", share) & close)
            .select(*_pair("l_node", "r_node")))


def _pair(left: str, right: str) -> list:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def links(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(node, component) of the sets that are linked with others."""
    spark = sets.sparkSession
    nodes = None
    for k in reversed(range(ORDERS)):        # the sets that one order leaves go to the next
        own = sets if nodes is None else sets.join(nodes.select("node"), "node", "left_semi")
        found = order_prefixes(own, k, share).withColumnRenamed("prefix", f"prefix{k}")
        found = found if k == 0 else found.drop("inner")
        if nodes is not None:
            found = found.join(nodes.drop("n").withColumnRenamed("lonely", "_lonely"), "node").withColumn(
                "lonely", F.col("lonely") + F.col("_lonely")).drop("_lonely")
        nodes = checkpointed(found, "op11-order")
    post = nodes.select("node", "n", (F.col("n") - F.col("lonely")).alias("c"), "inner",
                        F.posexplode("prefix0").alias("at", "token")).select(
        "token", "node", "n", "c", (F.col("at") < F.col("inner")).alias("indexed"))
    post = checkpointed(post, "op11-postings")
    linked = spark.createDataFrame([], "node long, component long")
    tried = None
    for turn in range(HUB_ROUNDS + 1):
        named = post.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if turn:
            named = checkpointed(named, "op11-named")
        # first the set with the least share of tokens of its own, then others
        rank = F.xxhash64("node", "token", F.lit(turn)) if turn else F.struct(F.col("c") / -F.col("n"), F.col("node"))
        lists = (named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                            F.min_by(F.struct("node", "n", "c", "component"), rank).alias("hub"))
                 .filter("low <> high"))
        if turn < HUB_ROUNDS:
            pairs = (named.join(lists.select("token", "hub"), "token")
                     .filter((F.col("component") != F.col("hub.component")) & _near_enough("n", "hub.n", "c", "hub.c", share))
                     .select(*_pair("node", "hub.node")))
        else:
            pairs = _other_pairs(named.join(lists.select("token"), "token", "left_semi"), sets, share)
        pairs = pairs.distinct()
        pairs = checkpointed(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "op11-pairs")
        if pairs.head(1):
            new = checkpointed(_confirmed(pairs, nodes, sets, share), "op11-links")
            if new.head(1):
                stars = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
                linked = connected_components(stars.unionByName(new), "op11-components")
        tried = pairs if tried is None else tried.unionByName(pairs)
    return linked


def jaccard_classes(docs: DataFrame, size: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every document.

    Two documents link if their sets of ``size``-word shingles have ``share[0]`` in ``share[1]`` of their
    union or more in common. What is stored on the way is deleted, but for what the result reads.
    """
    spark = docs.sparkSession
    passing: list[str] = []
    with recorded(passing):
        signed = checkpointed(signed_sets(docs, size), "op11-signed")
        wanted = checkpointed(possible_sets(signed, share), "op11-possible")
        sets = checkpointed(full_sets(docs, signed, wanted, size), "op11-sets")
        linked = links(sets, share)
        named = sets.select("node", "set_id").join(linked, "node").select("set_id", "component")
        # classes of sets, few beside the documents
        rows = signed.select("doc_id", "n", "set_id")
        classes = rows.join(named, "set_id").groupBy("component").agg(F.min("doc_id").alias("least"))
        with_least = named.join(classes, "component").select("set_id", "least")
        alone = rows.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("own"))
        found = (rows.join(alone, "set_id", "left").join(with_least, "set_id", "left")
                 .select("doc_id", F.col("n").alias("n_shingles"),
                         F.coalesce("least", "own", "doc_id").alias("component_id")))
        done = checkpointed(found, "op11-classes")
    passing.pop()
    delete_paths(spark, passing)
    return done
