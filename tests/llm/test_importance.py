"""Importance resampling against plain Python."""

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from fiberqa.llm import importance
from hypothesis import given, settings
from hypothesis import strategies as st

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)], len(words)


def plain(docs, target, percent=5, min_words=20):
    def buckets(text):
        return Counter(crc32(f.encode()) % 10000 for f in plain_features(text)[0])

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        found, words = plain_features(text)
        weight = sum(gain[b] * n for b, n in buckets(text).items())
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), words, weight, score, None])
    able = sorted((r for r in rows if r[2] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1]))
    for k in range(percent * len(able) // 100):
        able[k][5] = k + 1
    return sorted(map(tuple, rows), key=repr)


def run(docs, target, **more):
    names = ("doc_id", "n_features", "n_words", "weight", "score", "rank")
    return sorted((tuple(r[c] for c in names) for r in importance.resample(docs, target, **more).collect()), key=repr)


def test_as_plain_python(sent):
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta", "été", "x1", "Ω", "日本", "w" * 70] + [f"w{k}" for k in range(60)]
    rows = [(i if i % 50 else None, " .,".join(rng.choice(words, rng.integers(0, 80)))) for i in range(300)]
    rows += [(7, rows[7][1]), (301, None), (302, ""), (303, " -- \n "), (304, "y" * 20_000 + " " + " ".join(words) * 40)]
    target = [" ".join(rng.choice(words[:20], 50)) for _ in range(30)] + [None, ""]
    docs = sent.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, bucket string, score double")
    aim = sent.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 100):
        assert run(docs, aim, percent=percent) == plain(rows, target, percent)


def test_odd_documents_and_no_documents(sent, edge, nothing):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert run(edge, edge, percent=50) == plain(rows, [t for _, t in rows], 50)
    assert run(edge, nothing, percent=50) == plain(rows, [], 50)
    assert run(nothing, edge) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAb Zé. 1日\n")), st.text(alphabet="ab ", max_size=400)), max_size=8))
def test_buckets_of_features(texts):
    got = [[] for _ in texts]
    for bucket, text in importance.features(pa.array(texts, pa.string())):
        for b, t in zip(bucket.tolist(), text.tolist()):
            got[t].append(b)
    assert got == [[crc32(f.encode()) % 10000 for f in plain_features(t)[0]] for t in texts]


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    texts = pa.array(["one two three one two", "two one"])
    want = [b.tolist() for b, _ in importance.features(texts)]
    words_of = importance.words_of

    def clash(*a):
        words = words_of(*a)
        words.hashes[:] = 1
        return words

    monkeypatch.setattr(importance, "words_of", clash)
    assert [b.tolist() for b, _ in importance.features(texts)] == want


def test_crc_matrix():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 7, 40):
        rows = rng.integers(0, 256, (size, 50), dtype=np.uint8)
        assert importance.crc_matrix(rows).tolist() == [crc32(rows[:, k].tobytes()) for k in range(50)]
