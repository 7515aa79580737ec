"""Quality rules, line dedup and fingerprints against plain Python."""

import collections
import hashlib
import random
import re

import pytest
import xxhash

from tests.llm.helpers_llm import LONG, awkward, documents, prose, words
from touchline.llm.op2_quality_rules import RULES, apply_rules
from touchline.llm.op8_line_dedup import dedup_lines
from touchline.llm.op10_fingerprints import K, fingerprints, syncmers, with_next


def rules(text):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(grams)
    covered = {k for i, g in enumerate(grams) if often[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_rules_equal_brute_force(spark):
    rows = awkward() + [(20, "x y z " * 30), (21, "a b c d a b c " * 9 + prose(5, 80)), (22, "L 1\nL 1\n\nL 1 \nl 2")]
    found = apply_rules(documents(spark, rows)).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in found)
    assert got == sorted((i or -1, *rules(t)) for i, t in rows)
    assert all(not r.kept for r in found if r.base_failed)
    assert apply_rules(documents(spark, [])).count() == 0


def test_rules_verdict(spark):
    clean = "the house of the people is on a hill and it was built for them with care. " * 1
    good = " ".join(clean + prose(k, 15) for k in range(8))
    loud = " ".join(w.upper() + "!!" for w in words(good))
    marked = " ".join(w + "###" for w in words(good))
    kept = {r.doc_id: (r.kept, r.failed_rules) for r in apply_rules(documents(spark, [(1, loud), (2, marked)])).collect()}
    assert kept[1][0] is False and "exclamations" in kept[1][1]
    assert kept[2][0] is False and "symbols" in kept[2][1]
    assert {r.name for r in RULES} == {"word_length", "symbols", "stop_words", "repeated_lines", "repeated_words",
                                       "exclamations"}


def test_line_dedup_equals_brute_force(spark):
    shared = "A Line That Many Documents Share"
    rows = [(5, f"x\n{shared}\ny"), (3, f"  {shared.upper()}\t\nshort\nshort"), (9, shared + "\n" + shared), (4, None),
            (6, ""), (7, "short\nÉCOLE PRIMAIRE DE LYON"), (8, "école primaire de lyon\nshort"), (None, shared), (10, "\n\n")]
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\f\r"))
    holder = {}
    for i, t in sorted((r for r in rows if r[0] is not None)):
        for x in (t or "").split("\n"):
            holder.setdefault(key(x), i)
    want = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or holder[key(x)] == i]
        want[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    found = dedup_lines(documents(spark, rows))
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in found.collect()} == want
    assert {"n_words", "_place"} <= set(found.columns)
    assert dedup_lines(documents(spark, [])).count() == 0
    repeated = dedup_lines(documents(spark, [(1, shared)] * 2 + [(2, shared)])).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in repeated) == [(1, 0), (1, 0), (2, 1)]


def test_edited_texts_and_likeness(spark):
    rows = awkward()[:8] + awkward()[9:]
    found = {r.doc_id: r for r in fingerprints(documents(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, text), (_, other) in zip(order, order[1:] + order[:1]):
        text, other = text or "", other or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].n_chars == len(text)
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1
    assert found[1].fingerprint == found[2].fingerprint and found[1].near_next == 1
    assert found[3].fingerprint == "" and found[3].near_next == 1 and found[2].near_next == 0
    assert found[7].near_edited > 0.4 > found[7].near_next
    assert fingerprints(documents(spark, [])).count() == 0
    assert fingerprints(documents(spark, [(5, prose(1, 30))])).first().near_next == 1
    assert fingerprints(documents(spark, [(5, prose(1, 30))] * 2)).count() == 2


def test_syncmers_are_context_free(spark):
    passage, left, right = prose(7, 60), prose(8, 31), prose(9, 23)
    found = {r.doc_id: {(a.hash, a.position) for a in r.anchors} for r in syncmers(
        documents(spark, [(1, passage), (2, f"{left} {passage} {right}"), (3, "a b"), (4, None)])).collect()}
    assert {(h, p + 31) for h, p in found[1]} == {(h, p) for h, p in found[2] if 31 <= p <= 31 + 60 - K}
    assert len(found[1]) > 10 and not found[3] and not found[4]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def folded(parts):
    """Hash of several values, each seeded by the one before."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else (p & (1 << 64) - 1).to_bytes(8, "little"), seed=seed)
    return signed(seed)


def plain_anchors(text):
    """(hash, position) by the rule: the least inner S-mer is the first or the last one."""
    w = words(text)
    h = [folded(w[i:i + 2]) for i in range(len(w) - 1)]
    found = [(folded(h[i:i + 4]), i) for i in range(len(w) - 4)
             if min(h[i], h[i + 3]) <= min(h[i + 1], h[i + 2])]
    return found or ([(folded([" ".join(w)]), 0)] if w else [])


def plain_print(anchors):
    places = [p for _, p in anchors]
    return "".join(f"{min(b - a, 15):x}{h & 0xFFFFFFFF:08x}" for (h, b), a in zip(anchors, [0, *places]))


def test_fingerprints_equal_plain_python(spark):
    """Every length from 0 to 12 words, long texts, repeats: fingerprints, likeness and same places."""
    random.seed(11)
    rows = [(i, prose(900 + i, i % 13)) for i in range(60)] + [(100, LONG), (101, LONG + " x"), (102, "a b " * 40)]
    rows += [(103, prose(5, 300)), (104, prose(6, 40) + " " + prose(5, 300)), (None, "one two three four five six")]
    found = {r.doc_id: r for r in fingerprints(documents(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, text), (_, other) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edit = text[:len(text) - half] + other[:half]
        own, new, after = plain_anchors(text), plain_anchors(edit), plain_anchors(other)

        def dice(a, b):
            a, b = ({h & 0xFFFFFFFF for h, _ in x} for x in (a, b))
            return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0

        r = found[i]
        assert (r.fingerprint, r.edited_fingerprint) == (plain_print(own), plain_print(new))
        assert (r.near_edited, r.near_next) == pytest.approx((dice(own, new), dice(own, after)))
        assert (r.n_anchors, r.same_places) == (len(own), len(set(own) & set(new)))
        assert bool(r.fingerprint) == bool(words(text))
    assert found[103].near_next > 0.85      # a passage that moved is found in full


def test_neighbours_across_many_ranges(spark):
    rows = [(i * 7 % 501, prose(i, 8)) for i in range(501)] + [(None, "null one"), (None, "null two"), (250, "again")]
    got = with_next(documents(spark, rows), ranges=60).select("doc_id", "text", "next_text").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(((r.doc_id or -1, r.text, r.next_text) for r in got)) == \
        sorted((i or -1, t, u) for (i, t), (_, u) in zip(order, order[1:] + order[:1]))
