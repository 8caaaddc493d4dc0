"""The Merkle manifest against plain recursion."""

from hashlib import sha256

import pytest
from fiberqa.llm import merkle
from pyspark.sql import functions as F


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(digests):
    """Levels of a tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        k = i // 8 * 8
        out.append((level[k:i], level[i + 1 : k + 8]))
        i //= 8
    return out


def plain(rows, tampered):
    """(doc_id, leaf, subroot, root, proof, folded) of each row."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for x in names:
        trees[x].sort(key=lambda t: t[:3])
    levels = {x: climb([t[2] for t in trees[x]]) for x in names}
    top = climb([levels[x][-1][0] for x in names])
    out = []
    for g, x in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(trees[x]):
            way = siblings(levels[x], i) + siblings(top, g)
            folded = plain_leaf(r, lowered(r["text"])) if tampered(r) else leaf
            for left, right in way:
                folded = H(*left, folded, *right)
            proof = [s for left, right in way for s in (*left, *right)]
            out.append((r["doc_id"], leaf, levels[x][-1][0], top[-1][0], H(*proof), folded, folded == top[-1][0], tuple(proof)))
    return sorted(out, key=repr)


def run(docs, tampered):
    made = merkle.proofs(merkle.manifest(merkle.leaf_digests(docs, tampered)), siblings=True)
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(((*(r[c] for c in names), tuple(r["siblings"])) for r in made.collect()), key=repr)


@pytest.mark.parametrize("shelf", [8, 1024])
def test_proofs_as_by_recursion(sent, monkeypatch, shelf):
    """Trees of one leaf, of many levels and many trees, on shelves that hold parts of trees and many trees."""
    monkeypatch.setattr(merkle, "SHELF", shelf)
    sizes = {None: 3, "a": 1, "b": 8, "c": 9, "d": 65, "e": 700, "é": 2, "z": 64} | {f"t{k:02}": 1 + k % 3 for k in range(70)}
    rows, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n * 7919 % 10007, f"Text {n}" if n % 11 else None, lang, f"s{n % 5}" if n % 3 else None, n))
    docs = sent.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = run(docs, F.col("doc_id") % 2 == 0)
    want = plain([r.asDict() for r in docs.collect()], lambda r: r["doc_id"] % 2 == 0)
    assert got == want
    assert {r[6] for r in got} == {True, False}


def test_odd_documents(sent, edge, nothing):
    """Null ids and languages, repeated rows, long texts, foreign columns."""
    docs = edge.withColumn("tree", F.lit("x")).withColumn("level", F.lit(1))
    got = run(docs, F.col("doc_id") % 2 == 1)
    assert got == plain([r.asDict() for r in edge.collect()], lambda r: (r["doc_id"] or 0) % 2 == 1)
    assert run(nothing, F.lit(True)) == []
    one = run(edge.where("doc_id = 6"), F.lit(False))
    assert len(one) == 1 and one[0][1] == one[0][2] == one[0][3] == one[0][5] and one[0][4] == H() and one[0][6]


def test_nodes_fetched_are_the_least(sent):
    """What a shelf fetches is what it cannot derive, and no more than seven nodes a side and level."""
    for n, first, last in [(1000, 100, 400), (1000, 0, 999), (9, 8, 8), (1, 0, 0), (513, 3, 511), (4096, 2048, 2055)]:
        runs = sent.createDataFrame([(1, 0, n, first, last)], "shelf long, tree long, n long, first long, last long")
        got = {(r["level"], r["idx"]) for r in merkle.missing(runs).collect()}
        want, lo, hi, level, m = set(), first, last, 0, n
        while m > 1:
            needed = {i // 8 * 8 + k for i in range(lo, hi + 1) for k in range(8)}
            want |= {(level, i) for i in needed if i < m and not lo <= i <= hi}
            lo, hi, level, m = lo // 8, hi // 8, level + 1, -(-m // 8)
        assert got == want
