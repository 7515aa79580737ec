"""Jaccard join and prefix trie against brute force and SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tests.llm.helpers_llm import awkward, documents, prose, words
from touchline.llm.op11_ngram_join import index_length, jaccard_classes, prefix_length
from touchline.llm.op13_prefix_trie import prefix_trie


def shingles(text, size=5):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def classes(rows):
    """(doc_id, size, component) of each row, by comparing all pairs; rows are nodes."""
    sets = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= 80 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return Counter((d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows))


def edit(text, every, seed):
    random.seed(seed)
    w = text.split(" ")
    for _ in range(max(1, len(w) // every)):
        w[random.randrange(len(w))] = f"x{random.randrange(10 ** 6)}"
    return " ".join(w)


def test_prefix_lengths():
    for n in range(1, 200):
        assert prefix_length(n, (80, 100)) == n - -(-80 * n // 100) + 1
        assert 1 <= index_length(n, (80, 100)) <= prefix_length(n, (80, 100)) <= n


@pytest.mark.parametrize("hubs", [1, 0])
def test_join_equals_all_pairs(spark, monkeypatch, hubs):
    """Stars and chains of copies, short and awkward texts; without hubs all pairs go the full way."""
    monkeypatch.setattr("touchline.llm.op11_ngram_join.HUB_ROUNDS", hubs)
    monkeypatch.setattr("touchline.llm.op11_ngram_join.SLAB_TOKENS", 300)
    rows = awkward()
    base = prose(50, 200)
    rows += [(100 + i, edit(base, 60 + i, i)) for i in range(30)]
    chain = prose(51, 150)
    for i in range(12):      # each like the one before
        rows.append((200 - i, chain))
        chain = edit(chain, 80, i)
    rows += [(300 + i, prose(60 + i % 3, 5 + i % 4)) for i in range(12)]
    rows += [(400, "One TWO three"), (401, "one two three"), (402, "one two three four"), (10, edit(base, 100, 99))]
    rows += [(500 + i, prose(90, 40) + " " + prose(91 + i, 12)) for i in range(8)]      # much in common, not enough
    got = jaccard_classes(documents(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == classes(rows)


def test_join_of_nothing(spark):
    assert jaccard_classes(documents(spark, [])).count() == 0
    assert [tuple(r) for r in jaccard_classes(documents(spark, [(None, None), (1, " ")])).orderBy("doc_id").collect()] == \
        [(None, 0, None), (1, 0, 1)]


def trie(rows):
    """The trie's nodes from plain lists."""
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                      key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        own[c].append((role or "", text or ""))
    nodes = defaultdict(list)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5 if c >= 0 else c - -(-c % 5)
        way = own.get(base, [])[:h] + turns[h:]
        built[c] = way
        for d in range(len(way) + 1):
            nodes[tuple(way[:d])].append(c)
    children = Counter(k[:-1] for k in nodes if k)
    found = []
    for key, members in nodes.items():
        under = [k for k in nodes if k[:len(key)] == key]
        ends = sorted(c for c in members if len(built[c]) == len(key))
        found.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), children[key],
                      sum(not children[k] for k in under),
                      sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in under if k),
                      hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return Counter(found)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, key string")


@pytest.mark.parametrize("task_nodes", [10_000, 3])
def test_trie_equals_plain_lists(spark, task_nodes):
    """A long chain, many copies, null and tied turns, a lone turnless conversation; all in one task or split."""
    random.seed(5)
    rows = []
    for c in range(40):
        for t in range(random.randrange(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else None, f"t{c % 3} {t}" if c % 7 else f"é{c} {t}"))
    rows += [(100, t, "user", f"long {t}") for t in range(60)]
    rows += [(7, None, "user", "first"), (7, None, "a", "tie"), (9, 3, "user", None), (9, 3, "user", None)]
    rows += [(1003, 0, "user", "alone"), (None, 0, "user", "nobody"), (-4, 0, "user", "negative"), (-4, 1, "user", "more")]
    got = prefix_trie(conversations(spark, rows).repartition(4), task_nodes).select(*COLUMNS).collect()
    assert Counter(tuple(r) for r in got) == trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie(conversations(spark, [])).count() == 0
    assert prefix_trie(conversations(spark, [(None, 1, "a", "b")])).count() == 0


def test_long_conversation_is_carried_over_partitions(spark):
    rows = [(5, t, "user", f"turn {t % 11}") for t in range(400)] + [(6, 0, "user", "x")]
    got = prefix_trie(conversations(spark, rows), 50).select(*COLUMNS).collect()
    assert Counter(tuple(r) for r in got) == trie(rows)


def test_sql_of_both(spark):
    from touchline.llm.oracle import ORACLE_SQL
    rows = [r for r in awkward() if r[0] is not None and r[0] != 8]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(ORACLE_SQL["op11_ngram_join"]).fetchall()
    assert Counter((a, b, c) for a, b, c in want) == classes(rows)
