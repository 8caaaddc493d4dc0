"""Near-duplicates, repeated passages, decontamination and top-k against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from fiberqa.llm import components, decontaminate, minhash, substrings, topk
from fiberqa.llm.words import NOT_ALNUM, words_of


def shingle_set(text, k):
    w = (text or "").encode().lower().split() if text else []
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near_brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def family(seed, size=40, words=120):
    rng = random.Random(seed)
    base = [f"b{rng.randrange(60)}" for _ in range(words)]
    out = []
    for n in range(size):
        text = list(base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(words)] = f"e{rng.randrange(9)}"
        out.append((100 * seed + n, " ".join(text)))
    return out


def test_near_duplicates_of_families(sent):
    rows = [*family(1), *family(2), *family(3, 5, 6), (1, "a b"), (2, "A b"), (3, ""), (4, "alone is this text here")]
    for k in (4, 5):
        got = minhash.near_duplicates(sent.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == near_brute(rows, k, 80)


def test_near_duplicates_of_odd_documents(edge, nothing):
    got = sorted((tuple(r) for r in minhash.near_duplicates(edge).collect()), key=repr)
    assert len(got) == edge.count()
    assert {r[0]: r[2] for r in got}[5] == 1 and {r[0]: r[2] for r in got}[8] == 7
    assert [r[2:] for r in got if r[0] is None] == [(None, True)]
    assert all(r[1:] == (0, r[0], True) for r in got if r[0] in (2, 3, 4))
    assert minhash.near_duplicates(nothing).count() == 0


def test_components_of_chains_and_cycles(sent):
    links = [(i, i + 1) for i in range(1, 40)] + [(60, 50), (50, 70), (70, 60), (90, 90), (5, 4), (None, 1)]
    got = {r[0]: r[1] for r in components.components(sent.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 70: 50}


def removed_brute(rows, size):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    counts = {}
    for _, w in words:
        for i in range(len(w) - size + 1):
            counts[tuple(w[i : i + size])] = counts.get(tuple(w[i : i + size]), 0) + 1
    out = []
    for d, w in words:
        gone = [any(counts.get(tuple(w[j : j + size]), 0) > 1 for j in range(max(0, i - size + 1), i + 1) if j + size <= len(w)) for i in range(len(w))]
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeated_passages(sent, edge, nothing):
    rng = random.Random(5)
    passage = [f"p{rng.randrange(9)}" for _ in range(30)]
    rows = []
    for n in range(90):  # more different surroundings than one automaton takes
        text = [f"u{rng.randrange(50)}" for _ in range(rng.randrange(30))] + passage[rng.randrange(4) :] + [f"v{rng.randrange(50)}" for _ in range(20)]
        rows.append((n, " ".join(text)))
    rows += [(200, "x " * 50), (201, "y z " * 20), (202, None), (203, "short one"), (203, "short one")]
    frame = sent.createDataFrame(rows, "doc_id long, text string")
    for size in (12, 35):
        got = sorted((tuple(r) for r in substrings.remove_repeated(frame, size, texts=False).collect()), key=repr)
        assert got == removed_brute(rows, size)
    odd = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert sorted((tuple(r) for r in substrings.remove_repeated(edge, 35, texts=False).collect()), key=repr) == removed_brute(odd, 35)
    assert substrings.remove_repeated(nothing, 35).count() == 0


def test_automaton_counts_substrings():
    rng = random.Random(2)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(6)]
    automaton = substrings.Automaton()
    for s in sequences:
        automaton.add(s, 1)
    automaton.close()
    for size in (1, 2, 5, 9):
        all_of = [tuple(s[i : i + size]) for s in sequences for i in range(len(s) - size + 1)]
        for s in sequences:
            want = sum(1 << i for i in range(len(s) - size + 1) if all_of.count(tuple(s[i : i + size])) > 1)
            assert automaton.repeated(s, size) == want


def tiles_brute(item, text, minimum):
    marked, used, total = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not marked[i + n] and not used[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < minimum:
            return total
        marked[i : i + n] = used[j : j + n] = [True] * n
        total += n


def test_tiles_cover_what_greedy_search_covers():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.randrange(12) for _ in range(rng.randrange(5, 40))]
        parts = [item[a : a + rng.randrange(3, 15)] for a in (rng.randrange(len(item)) for _ in range(4))]
        text = [x for p in parts for x in [*p, *(rng.randrange(12) for _ in range(rng.randrange(4)))]]
        x, y = np.array(item, np.uint64) + np.uint64(7), np.array(text, np.uint64) + np.uint64(7)
        found = decontaminate.tiles(x, y, np.zeros(len(y), bool), 4)
        assert all((x[i : i + n] == y[j : j + n]).all() and n >= 4 for n, i, j in found)
        assert sum(n for n, _, _ in found) == tiles_brute(item, text, 4)


def test_contamination(sent, edge, nothing):
    rng = random.Random(4)
    items = [(i, " ".join(f"q{rng.randrange(400)}" for _ in range(40))) for i in range(6)] + [(9, None), (None, "a b c d e f"), (10, "too short"), (11, "")]
    halves = items[0][1].split()
    docs = [
        (1, "noise " * 30 + items[0][1].upper() + " tail"),
        (2, " ".join(halves[20:]) + " middle words here " + " ".join(halves[:20])),
        (3, " ".join(halves[:15]) + " little of it"),
        (4, "nothing at all of these"), (5, None), (6, items[1][1] + " " + items[2][1]), (6, items[1][1] + " " + items[2][1]),
    ]
    frame, bench = sent.createDataFrame(docs, "doc_id long, text string"), sent.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK, 300):
        got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contamination(frame, bench, block=block).collect())
        assert got == [(1, 0), (2, 0), (6, 1), (6, 1), (6, 2), (6, 2)]
    assert decontaminate.contamination(edge, bench).count() == decontaminate.contamination(nothing, bench).count() == 0
    assert decontaminate.contamination(frame, bench.where("false")).count() == 0


def test_contamination_by_repeated_words(sent):
    """Few different words cover most places of an item."""
    items = [(1, "a b c d e " * 3 + " ".join(f"r{i}" for i in range(10))), (2, "f g h i j " * 2 + " ".join(f"s{i}" for i in range(5)))]
    docs = [(1, "x " * 9 + "a b c d e " * 3 + "y"), (2, "f g h i j " * 2), (3, "a b c d e " * 2), (4, "x y " + "f g h i j")]
    frame, bench = sent.createDataFrame(docs, "doc_id long, text string"), sent.createDataFrame(items, "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.contamination(frame, bench).collect()) == [(1, 1, 15, 25), (2, 2, 10, 15)]


def test_top_k(sent):
    rng = np.random.default_rng(1)
    x = rng.integers(-40, 40, size=(700, 6))
    x[100:300] = x[100]  # a very common vector
    rows = [(int(i), [int(v) for v in r]) for i, r in enumerate(x)] + [(None, [1] * 6), (900, None), (901, [])]
    frame = sent.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    got = topk.top_k(frame, frame.where("vec_id % 50 = 0"), k=5, sample=64).collect()
    want = []
    every = [(i, v) for i, v in rows if i is not None and v is not None]
    for q, v in every:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in every if i != q)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(frame.where("false"), frame).count() == topk.top_k(frame, frame.where("false")).count() == 0
    few = frame.where("vec_id < 3")
    assert topk.top_k(few, few).count() == 6


def test_scaled_vectors(sent):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001]), (2, [nan]), (3, [inf]), (4, [None, 1.0]), (5, None), (6, [])]
    frame = sent.createDataFrame(rows, "vec_id long, e array<float>")
    assert {r[0]: r[1] for r in frame.select("vec_id", topk.scaled("e")).collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_words_and_hashes():
    w = words_of(pa.array(["The cat, sat", None, "", "the\x0bCAT"]), NOT_ALNUM)
    assert w.counts.tolist() == [3, 0, 0, 2]
    assert w.hashes[0] == w.hashes[3] and w.hashes[1] == w.hashes[4] and len(set(w.hashes.tolist())) == 3
