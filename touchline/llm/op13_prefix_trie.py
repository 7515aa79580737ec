"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

``conversation_paths`` gives every conversation's way through the trie: a row a prefix, whose key is a
polynomial hash (127 bits) of the turns up to there. Hashes are made in range partitions of (conversation,
turn), so a conversation of any length is split between tasks; what crosses the bounds is carried by one
row a partition. The hash is a sum over positions, so prefixes of rebuilt conversations follow from those
of the given ones by arithmetic. ``trie_nodes`` groups equal prefixes.

``rollup`` adds values over subtrees in as many rounds as the logarithm of the rows, however deep the trie
is. The weight of a subtree (its conversations' remaining turns) is known from the paths. In each component
the centroid is the deepest node that holds at least half of the weight. Its subtree's total is added to all
nodes on the path from the centroid to the component's top, the centroid is settled, and what is left
falls into the part with the top and one component for each child, none with more than half of the
weight. Components of up to ``TASK_NODES`` nodes go on by the same steps within one task.

Null role or text: empty. A null turn comes first, turns that tie are ordered by role and text, repeated rows
are turns of their own. Rows without conv_id belong to no conversation and are left out. No rows give no
rows, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shipped, slices
from touchline.session import checkpointed, delete_paths, recorded

MODULUS = (1 << 127) - 1
BASE = int.from_bytes(hashlib.blake2b(b"prefix trie", digest_size=16).digest()) % MODULUS
INVERSE = pow(BASE, -1, MODULUS)
ROOT = bytes(16)
#: Nodes of a component that one task decomposes alone.
TASK_NODES = 10_000


def _turn_hash(role: str, text: str) -> int:
    raw = role.encode()
    return int.from_bytes(hashlib.blake2b(len(raw).to_bytes(8) + raw + text.encode(), digest_size=16).digest()) % MODULUS


def _int(raw: bytes | None) -> int:
    return int.from_bytes(raw) if raw else 0


def hashed_turns(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), hash and hash_before (of the turns up to and before this one), n_bytes of its text."""
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    rows = (turns.filter("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                    *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "role", "text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, pos, total, power = TaskContext.get().partitionId(), None, 0, 0, 1
        for batch in slices(batches, "text", 4 << 20):
            found = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != now:
                    now, pos, total, power = conv, 0, 0, 1
                pos, power, before = pos + 1, power * BASE % MODULUS, total
                total = (total + _turn_hash(role, text) * power) % MODULUS
                found.append((part, conv, pos, total.to_bytes(16), before.to_bytes(16), len(text.encode())))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)],
                                             names=["part", "conv", "pos", "hash", "hash_before", "n_bytes"])

    local = checkpointed(shipped(rows).mapInArrow(
        scan, "part long, conv long, pos long, hash binary, hash_before binary, n_bytes long"), "op13-local")
    # conversations that go on in another partition: at most one more row a partition
    runs = local.groupBy("conv", "part").agg(F.max("pos").alias("n"), F.max_by("hash", "pos").alias("hash"))
    cut = runs.groupBy("conv").agg(F.count("*").alias("runs")).filter("runs > 1").select("conv")

    def carry(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        places, totals, at, total = [], [], 0, 0
        for n, own in zip(table["n"].to_pylist(), table["hash"].to_pylist()):
            places.append(at)
            totals.append(total.to_bytes(16))
            total = (total + _int(own) * pow(BASE, at, MODULUS)) % MODULUS
            at += n
        return pa.table({"conv": table["conv"], "part": table["part"], "skip": pa.array(places, pa.int64()),
                         "carried": pa.array(totals, pa.binary())})

    carried = shipped(runs.join(cut, "conv", "left_semi")).groupBy("conv").applyInArrow(
        carry, "conv long, part long, skip long, carried binary")

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers: dict[int, int] = {}
        for batch in batches:
            columns = batch.to_pydict()
            for i, (skip, base) in enumerate(zip(columns["skip"], columns["carried"])):
                if skip:
                    power = powers.get(skip)
                    if power is None:
                        power = powers[skip] = pow(BASE, skip, MODULUS)
                    columns["pos"][i] += skip
                    for c in ("hash", "hash_before"):
                        columns[c][i] = ((_int(base) + _int(columns[c][i]) * power) % MODULUS).to_bytes(16)
            names = ["conv", "pos", "hash", "hash_before", "n_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], batch.schema.field(n).type) for n in names], names=names)

    both = local.join(carried, ["conv", "part"], "left")
    return shipped(both).mapInArrow(shift, "conv long, pos long, hash binary, hash_before binary, n_bytes long")


def conversation_paths(turns: DataFrame, most: int = 9, group: int = 5) -> DataFrame:
    """conv, depth, key, parent (key; null for the root), n_bytes and length of every rebuilt conversation.

    Conversation c starts with the first h turns of conversation c - c % ``group`` and goes on with its own
    turns after its first h, where h = crc32(decimal c) % ``most``.
    """
    given = checkpointed(hashed_turns(turns), "op13-hashed")
    heads = given.filter(F.col("pos") < most)
    convs = (given.groupBy("conv").agg(F.max("pos").alias("n"))
             .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % most)
             .withColumn("base", F.col("conv") - F.col("conv") % group))
    sizes = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(sizes, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    heads_at = [heads.select(F.col("conv").alias(c), F.col("pos").alias(p), F.col("hash").alias(name))
                for c, p, name in (("base", "m", "start"), ("conv", "h", "left_out"))]
    convs = convs.join(heads_at[0], ["base", "m"], "left").join(heads_at[1], ["conv", "h"], "left")
    convs = convs.withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = checkpointed(convs.select("conv", "base", "h", "m", "length", "start", "left_out"), "op13-convs")
    shared = (convs.select("conv", "base", "m", "length")
              .join(heads.withColumnRenamed("conv", "base"), "base").filter("pos <= m")
              .select("conv", F.col("pos").alias("depth"), F.col("hash").alias("key"),
                      F.col("hash_before").alias("parent"), "n_bytes", "length"))
    own = given.join(convs, "conv").filter("pos > h")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = [pow(INVERSE, k, MODULUS) for k in range(most)]
        for batch in batches:
            c = batch.to_pydict()
            keys = {"hash": [], "hash_before": []}
            for name, out in keys.items():
                for own, start, left, h, m in zip(c[name], c["start"], c["left_out"], c["h"], c["m"]):
                    out.append(((_int(start) + (_int(own) - _int(left)) * back[h - m]) % MODULUS).to_bytes(16))
            depth = [pos - h + m for pos, h, m in zip(c["pos"], c["h"], c["m"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(depth, pa.int64()), pa.array(keys["hash"], pa.binary()),
                 pa.array(keys["hash_before"], pa.binary()), batch.column("n_bytes"), batch.column("length")],
                names=["conv", "depth", "key", "parent", "n_bytes", "length"])

    later = shipped(own).mapInArrow(rebuild, "conv long, depth long, key binary, parent binary, n_bytes long, length long")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"),
                        F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("n_bytes"), "length")
    return root.unionByName(shared).unionByName(later)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """key, parent, conv_id (smallest member), depth, n_convs, n_bytes, n_children, and ``weight``: the path
    rows in the node's subtree."""
    nodes = paths.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("conv").alias("conv_id"), F.min("depth").alias("depth"),
        F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
    nodes = checkpointed(nodes, "op13-grouped")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    return nodes.join(children, "key", "left").fillna(0, ["n_children"])


class Component:
    """Centroid decomposition of one component in memory: parents as places in the list (-1 at the top)."""

    def __init__(self, parent: list[int], depth: list[int], weight: list[int], values: np.ndarray, added: np.ndarray):
        self.parent, self.depth, self.weight = parent, depth, weight
        self.values, self.totals = values, added
        self.children: list[list[int]] = [[] for _ in parent]
        for i, p in enumerate(parent):
            if p >= 0:
                self.children[p].append(i)
        self.part = [0] * len(parent)

    def below(self, start: int) -> list[int]:
        """Nodes of the same part in the subtree of a node."""
        part, found = self.part[start], [start]
        for i in found:
            found += [c for c in self.children[i] if self.part[c] == part]
        return found

    def run(self) -> np.ndarray:
        tops = [i for i, p in enumerate(self.parent) if p < 0]
        parts = 0
        for top in tops:        # one, but for forests
            parts += 1
            self._label(self.below(top), parts)
        work = [(top, self.below(top)) for top in tops]
        while work:
            top, members = work.pop()
            half = self.weight[top]
            center = max((i for i in members if 2 * self.weight[i] >= half), key=self.depth.__getitem__)
            under = self.below(center)
            subtotal = self.values[under].sum(axis=0)
            self.totals[center] += subtotal
            cut, at = self.weight[center], center
            while at != top:        # the path from the centroid to the top
                at = self.parent[at]
                self.totals[at] += subtotal
                self.weight[at] -= cut
            own = self.part[center]
            children = [c for c in self.children[center] if self.part[c] == own]
            self.part[center] = -1
            for c in children:
                nodes = self.below(c)
                parts += 1
                self._label(nodes, parts)
                work.append((c, nodes))
            if center != top:
                work.append((top, [i for i in members if self.part[i] == own]))
        return self.totals

    def _label(self, nodes: list[int], part: int) -> None:
        for i in nodes:
            self.part[i] = part


def _in_task(rows: DataFrame, names: list[str]) -> DataFrame:
    """key and totals of all nodes of small components, which stand together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            keys = table["key"].to_pylist()
            place = {k: i for i, k in enumerate(keys)}
            comp = table["comp"].to_pylist()
            parent = []
            for key, up, own in zip(keys, table["parent"].to_pylist(), comp):
                parent.append(-1 if key == own else place[up])
            values, added = (np.stack([table[p + n].to_numpy() for n in names], axis=1).astype(np.int64)
                             for p in ("own_", "sum_"))
            totals = Component(parent, table["depth"].to_pylist(), table["weight"].to_pylist(), values, added.copy()).run()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(pa.array(t) for t in totals.T)],
                                              names=["key", *names])

        size = 0
        for batch in batches:       # whole components, some thousand nodes at a time
            while batch.num_rows:
                comp = batch.column("comp").to_pylist()
                if held and size >= TASK_NODES and comp[0] != held[-1].column("comp")[-1].as_py():
                    yield solve(pa.Table.from_batches(held))
                    held, size = [], 0
                want = max(TASK_NODES - size, 1)
                end = next((i for i in range(want, len(comp)) if comp[i] != comp[i - 1]), len(comp))
                held.append(batch.slice(0, end))
                size += end
                batch = batch.slice(end)
        if held:
            yield solve(pa.Table.from_batches(held))

    ready = rows.repartition("comp").sortWithinPartitions("comp")
    return shipped(ready).mapInArrow(run, "key binary, " + ", ".join(f"{n} long" for n in names))


def rollup(nodes: DataFrame, paths: DataFrame, values: dict[str, Column], task_nodes: int = TASK_NODES) -> DataFrame:
    """key and, for each of ``values`` (expressions over ``nodes``), its sum over the node's subtree."""
    names = list(values)
    ways = paths.select(F.col("conv").alias("conv_id"), F.col("depth").alias("at"), F.col("key").alias("step"),
                        F.col("parent").alias("step_parent"))
    now = nodes.select("key", "parent", "conv_id", "depth", "weight", F.lit(ROOT).alias("comp"),
                       *(v.cast("long").alias(f"own_{n}") for n, v in values.items()),
                       *(F.lit(0).cast("long").alias(f"sum_{n}") for n in names))
    columns, settled, small = now.columns, [], []
    while True:
        now = checkpointed(now, "op13-parts")
        parts = now.groupBy("comp").agg(F.count("*").alias("n"), F.max("weight").alias("all"), F.min("depth").alias("top"))
        parts = checkpointed(parts, "op13-sizes")
        small.append(now.join(parts.filter(F.col("n") <= task_nodes).select("comp"), "comp", "left_semi").select(*columns))
        parts = parts.filter(F.col("n") > task_nodes)
        if not parts.head(1):
            break
        big = now.join(parts.drop("n"), "comp")
        centers = (big.filter(2 * F.col("weight") >= F.col("all")).groupBy("comp")
                   .agg(F.max(F.struct("depth", "key", "conv_id", "weight", "top")).alias("z")))
        centers = checkpointed(centers.select("comp", "z.*"), "op13-centroids")
        z = centers.select("comp", F.col("key").alias("z"), F.col("depth").alias("z_depth"))
        labelled = (now.join(z, "comp").withColumn("at", F.col("z_depth") + 1)
                    .join(ways, ["conv_id", "at"], "left")
                    .withColumn("under", (F.col("depth") > F.col("z_depth"))
                                & F.coalesce(F.col("step_parent") == F.col("z"), F.lit(False))))
        labelled = checkpointed(labelled.select(*columns, "z", "step", "under"), "op13-labelled")
        sums = (labelled.filter(F.col("under") | (F.col("key") == F.col("z"))).groupBy("comp")
                .agg(*(F.sum(f"own_{n}").alias(f"add_{n}") for n in names)))
        sums = checkpointed(centers.join(sums, "comp"), "op13-subtotals")
        found = labelled.filter(F.col("key") == F.col("z")).join(sums.select("comp", *(f"add_{n}" for n in names)), "comp")
        settled.append(found.select("key", *((F.col(f"sum_{n}") + F.col(f"add_{n}")).alias(n) for n in names)))
        path = (ways.join(sums.withColumnRenamed("weight", "cut").drop("key", "comp"), "conv_id")
                .filter((F.col("at") < F.col("depth")) & (F.col("at") >= F.col("top")))
                .select(F.col("step").alias("key"), "cut", *(f"add_{n}" for n in names)))
        rest = labelled.filter(F.col("key") != F.col("z")).join(path, "key", "left")
        now = rest.select("key", "parent", "conv_id", "depth",
                          (F.col("weight") - F.coalesce("cut", F.lit(0))).alias("weight"),
                          F.when(F.col("under"), F.col("step")).otherwise(F.col("comp")).alias("comp"),
                          *(f"own_{n}" for n in names),
                          *((F.col(f"sum_{n}") + F.coalesce(f"add_{n}", F.lit(0))).alias(f"sum_{n}") for n in names))
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    out = _in_task(rows, names)
    for more in settled:
        out = out.unionByName(more)
    return out


def ends_digests(paths: DataFrame) -> DataFrame:
    """key and SHA-256 (hex) of the comma-joined ids, ascending, of the conversations that end at the node.

    A digest needs its ids in order, so those of one node meet in one task; they are streamed, never held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "ends"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["key", "ends"])

    ends = paths.filter("depth = length").select("key", "conv").repartition("key").sortWithinPartitions("key", "conv")
    return shipped(ends).mapInArrow(run, "key binary, ends string")


def prefix_trie(turns: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    What is stored on the way is deleted.
    """
    passing: list[str] = []
    with recorded(passing):
        paths = checkpointed(conversation_paths(turns), "op13-paths")
        nodes = checkpointed(trie_nodes(paths), "op13-nodes")
        totals = rollup(nodes, paths, {"n_leaves": (F.col("n_children") == 0).cast("long"),
                                       "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}, task_nodes)
        up = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        found = (nodes.join(totals, "key").join(ends_digests(paths), "key", "left").join(up, "parent", "left")
                 .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
        done = checkpointed(found, "op13-trie")
    passing.pop()
    delete_paths(turns.sparkSession, passing)
    return done
