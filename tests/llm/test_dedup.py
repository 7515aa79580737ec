"""Near-duplicate and substring deduplication against brute force, and the pipeline."""

import random

import pytest

from tests.llm.helpers_llm import awkward, documents, prose, words
from touchline.llm import op5_near_dedup as op5
from touchline.llm.components import connected_components
from touchline.llm.op9_substrings import SuffixAutomaton, remove_repeats


def shingles(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set()


def components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return [(len(s), min(x for x in groups[root(i)] if x is not None) if any(x is not None for x in groups[root(i)])
             else None) for i, s in enumerate(sets)]


def changed(text, seed, share):
    random.seed(seed)
    return " ".join(f"new{seed}x{k}" if random.random() < share else w for k, w in enumerate(text.split()))


def variants():
    rows = awkward()
    k = 100
    for base, n, share in ((prose(50, 200), 60, 0.03), (prose(51, 90), 40, 0.06), (prose(52, 25), 20, 0.04)):
        for i in range(n):
            rows.append((k, changed(base, k, share)))
            k += 1
    return rows + [(k + i, prose(1000 + i, 30 + i)) for i in range(60)]


@pytest.mark.parametrize("window", [32, 4])
def test_components_equal_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(op5, "WINDOW", window)      # 4: groups are wider than the window and scanned again
    rows = variants()
    found = op5.near_duplicates(documents(spark, rows)).collect()
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in found)
    want = sorted((i or -1, n, c or -1, i == c) for (i, _), (n, c) in zip(rows, components(rows)))
    assert got == want


def test_candidates_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(op5, "ROWS_A_PARTITION", 1500)
    rows = variants()
    found = {(r.doc_id, r.component_id) for r in op5.near_duplicates(documents(spark, rows)).collect()}
    assert found == {(i, c) for (i, _), (_, c) in zip(rows, components(rows))}


def star(base, n, share):
    """A text and copies of it that are less alike among themselves."""
    return [(0, base)] + [(k, changed(base, k, share)) for k in range(1, n)]


def test_original_is_not_among_the_best_partners(spark):
    rows = star(prose(60, 250), 400, 0.05)
    found = {(r.doc_id, r.component_id) for r in op5.near_duplicates(documents(spark, rows)).collect()}
    assert found == {(i, c) for (i, _), (_, c) in zip(rows, components(rows))}


def test_regions_wider_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(op5, "WINDOW", 4)
    monkeypatch.setattr(op5, "DENSE_WINDOW", 4)
    rows = star(prose(61, 120), 90, 0.05)
    found = {(r.doc_id, r.component_id) for r in op5.near_duplicates(documents(spark, rows)).collect()}
    assert found == {(i, c) for (i, _), (_, c) in zip(rows, components(rows))}


@pytest.mark.parametrize("places", [(0, 41), (5, 25)])
def test_pair_apart_in_a_region_of_strangers(spark, places):
    """All sets share the leading values of every tree; the sketches allow no pair but one, which stands apart."""
    random.seed(8)
    a, b = places
    rows = [(i, prose(700 + i, 60)) for i in range(42)]
    rows[b] = (b, rows[a][1] + " more")
    nodes = []
    for i, _ in rows:
        tree = bytes(2 * op5.MIN_DEPTH) + i.to_bytes(2, "big") * (op5.DEPTH - op5.MIN_DEPTH)
        sketch = random.randbytes(2 * op5.TREES * op5.DEPTH // 8)
        nodes.append((i, 60, bytearray(tree * op5.TREES), bytearray(nodes[a][3] if i == b else sketch)))
    frame = spark.createDataFrame(nodes, "id long, n long, orders binary, sketch binary")
    linked = op5._links(documents(spark, rows), frame, 2, (80, 100)).collect()
    assert {(r.node, r.component) for r in linked} == {(a, a), (b, a)}


def test_near_dedup_of_nothing(spark):
    assert op5.near_duplicates(documents(spark, [])).count() == 0
    found = op5.near_duplicates(documents(spark, [(3, None), (4, ""), (5, " ")])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found} == {(i, 0, i, True) for i in (3, 4, 5)}


def test_connected_components(spark):
    random.seed(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(9, 9), (1, None)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 260)]}}


def removal(rows, size):
    starts = {}
    texts = [words(t) for _, t in rows]
    for k, w in enumerate(texts):
        for i in range(len(w) - size + 1):
            starts.setdefault(tuple(w[i:i + size]), []).append((k, i))
    gone = [set() for _ in rows]
    for places in starts.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + size))
    return [(len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for w, g in zip(texts, gone)]


def passages(size):
    random.seed(6)
    shared = [prose(70 + k, size + 3 * k) for k in range(6)]
    rows = awkward() + [(300, "ab " * 4 * size), (301, "q " + "a b c " * size), (302, None)]
    for i in range(40):
        parts = [prose(400 + i, random.randint(0, 2 * size))]
        for _ in range(random.randint(0, 3)):
            p = random.choice(shared).split()
            a = random.randint(0, 5)
            parts += [" ".join(p[a:a + random.randint(size - 2, size + 8)]), prose(900 + i, random.randint(0, 12))]
        rows.append((400 + i, " \n".join(parts)))
    return rows


@pytest.mark.parametrize("size, shard", [(35, 1000), (35, 2), (8, 1000), (8, 2)])
def test_removal_equals_brute_force(spark, monkeypatch, size, shard):
    from touchline.llm import op9_substrings
    monkeypatch.setattr(op9_substrings, "SHARD", shard)     # 2: most shards are split by window content
    rows = passages(size)
    docs = documents(spark, rows)
    found = remove_repeats(docs, size).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.text) for r in found)
    assert got == sorted((i or -1, *x) for (i, _), x in zip(rows, removal(rows, size)))
    assert "text2" in docs.columns


def test_removal_of_nothing(spark):
    assert remove_repeats(documents(spark, [])).count() == 0
    found = remove_repeats(documents(spark, [(1, "a  b"), (2, None)]), untouched=True).collect()
    assert {r.doc_id: r.text for r in found} == {1: "a  b", 2: None}


def test_automaton_counts_occurrences():
    random.seed(3)
    for trial in range(300):
        seqs = list({tuple(random.choice("ab" + "c" * (trial % 3)) for _ in range(random.randint(4, 12)))
                     for _ in range(random.randint(1, 4))})
        weights = [random.randint(1, 2) for _ in seqs]
        automaton, k, often = SuffixAutomaton(), random.randint(2, 4), {}
        for s, w in zip(seqs, weights):
            automaton.add(list(s), w)
            for i in range(len(s) - k + 1):
                often[s[i:i + k]] = often.get(s[i:i + k], 0) + w
        automaton.finish()
        for s in seqs:
            assert automaton.matching(list(s), k) == [often[s[i:i + k]] > 1 for i in range(len(s) - k + 1)]


def test_near_dedup_stage_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline as pipeline
    rows = [(None, prose(801, 40)), (None, prose(802, 40)), (None, prose(802, 40)), (8, prose(803, 40)),
            (8, prose(804, 40)), (8, prose(804, 40)), (9, prose(805, 40)), (10, prose(805, 40)), (11, "")]
    found = pipeline.near_dedup(spark, documents(spark, rows, "_set int, _kept int"), "")
    assert found.columns == ["doc_id", "text", "_set", "_kept"]
    assert sorted((r.doc_id or -1, r.text) for r in found.collect()) == sorted(
        {(i or -1, t) for i, t in rows if i != 10})


def test_pipeline_stages(spark, tmpdir_path):
    import corpus_pipeline as pipeline
    rows = variants() + [(3000 + i, f"{prose(3000 + i, 40)}\nA line that is in every one of these\n{prose(4000 + i, 40)}")
                         for i in range(5)]
    rows += [(5000 + i, f"{prose(5000 + i, 70)} {prose(77, 60)} {prose(6000 + i, 70)}") for i in range(4)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i, _ in rows[:40]], "doc_id long, quality int").write.parquet(
        f"{tmpdir_path}/labels.parquet")
    assert [f for _, f in pipeline.STAGES] == [pipeline.quality, pipeline.line_dedup, pipeline.near_dedup,
                                               pipeline.substring_dedup, pipeline.packing]
    lines = pipeline.line_dedup(spark, docs, tmpdir_path)
    assert lines.columns == docs.columns and lines.count() == len(rows)
    assert lines.filter("text like '%every one of these%'").count() == 1
    one = pipeline.near_dedup(spark, docs, tmpdir_path)
    want = {c for _, c in components(rows)}
    assert sorted(r.doc_id or -1 for r in one.collect()) == sorted(x or -1 for x in want | {None})
    cut = pipeline.substring_dedup(spark, docs.filter("doc_id >= 5000"), tmpdir_path)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {
        i: x[2] for (i, _), x in zip(rows[-4:], removal(rows[-4:], 35))}
    packed = pipeline.run(spark, tmpdir_path)
    assert packed.count() >= 1 and "sequence_id" in packed.columns
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        empty = stage(spark, empty, tmpdir_path)
        assert empty.count() == 0




def without_shared_lines(rows):
    """Lines of 10 characters or more that two documents have stay in the one with the least id."""
    holders = {}
    for i, text in rows:
        for line in text.split("\n"):
            key = "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\f\r"))
            holders.setdefault(key, set()).add(i)

    def stays(i, line):
        key = "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\f\r"))
        return len(key) < 10 or len(holders[key]) < 2 or min(holders[key]) == i

    return [(i, "\n".join(x for x in text.split("\n") if stays(i, x))) for i, text in rows]


def test_pipeline_equals_plain_python(spark, tmpdir_path):
    """Every stage on what the one before kept, and the packed pieces, against plain Python."""
    import zlib

    import numpy as np
    import public_tokenizers as P
    from tokenizers import Tokenizer

    import corpus_pipeline as pipeline
    from touchline.llm import op7_quality as quality
    random.seed(12)
    rows = [(i, ". ".join(prose(70 * i + k, 12) for k in range(3 + i % 4)) + ".\nA line that many have\n" + prose(5000 + i, 30))
            for i in range(60)]
    rows += [(100 + i, changed(rows[3 * i][1].replace("\n", " "), i, 0.01)) for i in range(8)]
    rows += [(200 + i, f"{prose(8000 + i, 60)}. {prose(77, 60)}. {prose(9000 + i, 60)}.") for i in range(6)]
    rows += [(300 + i, " ".join(w.upper() + "!!#" for w in prose(i, 40).split())) for i in range(25)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").coalesce(2)
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i < 300)) for i, _ in rows], "doc_id long, quality int")
    labels.write.parquet(f"{tmpdir_path}/labels.parquet")

    model = quality.fit(quality.with_statistics(docs.select("doc_id", "text")), labels)
    z = model.features(np.array([quality.statistics(t.encode()) for _, t in rows]))
    scores = np.interp(z @ model.weights, model.knots, model.values)
    kept = [r for r, s in zip(rows, scores) if s >= quality.THRESHOLD]
    assert 0 < len(rows) - len(kept) and all(i >= 300 for (i, _), s in zip(rows, scores) if s < quality.THRESHOLD)
    kept = without_shared_lines(kept)
    kept = [r for r, (_, c) in zip(kept, components(kept)) if c == r[0]]
    assert 60 < len(kept) < 74
    kept = [(i, new if gone else t) for (i, t), (_, gone, new) in zip(kept, removal(kept, 35))]
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = []
    for i, text in kept:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start:start + 2048]
            want.append((i, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    found = pipeline.run(spark, tmpdir_path).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(want)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert len(places) == -(-sum(r.length for r in found) // 2048)


def test_rows_that_repeat_a_doc_id_are_nodes_of_their_own(spark):
    a, b = prose(821, 60), prose(822, 60)
    rows = [(10, a), (10, b), (12, b + " more"), (None, a), (None, prose(823, 30)), (None, prose(823, 30)), (5, a + " end")]
    found = op5.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in found) == sorted(
        [(10, 5), (10, 10), (12, 10), (-1, 5), (-1, -1), (-1, -1), (5, 5)])
