"""What the classifiers learn from: texts of any length, all of a text, all labelled rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from fiberqa.llm import language, quality, sampling, toxicity

WORDS = {n: ["".join(random.Random(f"{n}{i}").choices("abcdefghijklmnop", k=6)) for i in range(60)] for n in "xy"}


def words(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_pieces_reach_from_begin_to_end():
    assert sampling.spread("abc", 3, 2) == ["abc"] and sampling.spread("", 0, 5) == [""] and sampling.spread("abc", 0, 5) == []
    parts = sampling.spread(bytes(range(100)), 30, 10)
    assert [p[0] for p in parts] == [0, 45, 90] and parts[-1][-1] == 99
    text = " ".join(f"w{i}" for i in range(4000))
    kept = toxicity.excerpt(text, 3000)
    assert len(kept) <= 3000 and set(kept.split()) <= set(text.split()) and toxicity.excerpt(text, len(text)) == text
    assert sampling.spread("x" * 10, 1, 600) == ["x"]


@pytest.mark.parametrize("lengths, total", [([5, 5, 5], 9), ([1, 100, 100], 101), ([3, 4], 50), ([], 10), ([7] * 10, 3)])
def test_even_share_is_the_greatest_that_fits(lengths, total):
    most = sampling.even_share(lengths, total)
    fits = [m for m in range(200) if sum(min(n, m) for n in lengths) <= total]
    assert most == min(max(fits), max(lengths, default=0)) or sum(min(n, most) for n in lengths) == sum(min(n, max(fits)) for n in lengths)


def test_language_is_learned_behind_leading_digits(sent):
    rng = random.Random(1)
    rows = [(i, "1 23 " * 120 + words(rng, lang, 150), lang) for i, lang in enumerate("xy" * 20)] + [(0, "1 23", "x"), (50, None, "x"), (None, "abc", "y"), (51, "", "z")]
    model = language.fit(sent.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert min(len(d) for d in model.dictionaries) > 1000
    asked = sent.createDataFrame([(i, words(rng, "xy"[i % 2], 30)) for i in range(40)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict_language(asked, model).collect()}
    assert got == {i: "xy"[i % 2] for i in range(40)}


def test_language_sizes_are_those_of_single_pieces():
    rng = random.Random(2)
    model = language.Model(["x", "y"], [words(rng, n, 300).encode() for n in "xy"])
    texts = [words(rng, n, k).encode() for n in "xy" for k in (0, 3, 900)]
    for row, text in zip(language.sizes(texts, model), texts):
        for size, content in zip(row, model.dictionaries):
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            press = zstandard.ZstdCompressor(dict_data=made, compression_params=zstandard.ZstdCompressionParameters(**language.SEARCH, **language.BARE))
            assert size == sum(len(press.compress(text[k : k + language.PIECE])) for k in range(0, len(text), language.PIECE))


def long_texts(sent):
    rng = random.Random(3)
    rows = [(i, words(rng, "x", 10_800 // (1 + i % 3)) + (" vile scum die " * 40 if i % 2 else " SPAM!!! @@@ " * 0), i % 2) for i in range(24)]
    rows = [(i, t + ("  ### !!! ~~ " * 3000 if not y else ""), y) for i, t, y in rows]
    docs = sent.createDataFrame([(i, t) for i, t, _ in rows] + [(0, "~")], "doc_id long, text string")
    return docs, sent.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id long, toxic int, quality int"), rows


def test_long_labelled_texts_are_learned(sent):
    docs, labels, rows = long_texts(sent)
    docs = docs.where("text <> '~'")  # a short one of another kind, labelled bad
    assert max(len(t) for _, t, _ in rows) > 75_000
    ranked = quality.fit(docs, labels)
    assert ranked.weights is not None
    network = toxicity.fit(docs, labels, size=200_000)
    assert network.parameters is not None
    asked = pa.array([t for _, t, _ in rows])
    assert [s >= quality.CUT for s in ranked.scores(asked)] == [y == 1 for *_, y in rows]


def test_quality_cut_is_the_quantile_of_all_labelled_rows(sent):
    docs, labels, _ = long_texts(sent)
    model = quality.fit(docs, labels, per_class=3)
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    read = [(r["doc_id"], r["text"]) for r in docs.collect()]
    raw = model.raw(pa.array([t for _, t in read]))
    share = np.mean([label[i] == 0 for i, _ in read])
    assert model.cut == pytest.approx(np.quantile(raw, share), rel=1e-9)


def test_quality_weights_are_the_optimum(rng=np.random.default_rng(4)):
    good, bad = rng.normal(0.3, 1, (50, quality.FEATURES)), rng.normal(0, 1, (50, quality.FEATURES))
    model = quality.train(good, bad, pairs=4000)
    draw = np.random.default_rng(1)
    both = np.concatenate([good, bad])
    x = (good[draw.integers(50, size=4000)] - bad[draw.integers(50, size=4000)]) / both.std(axis=0)
    w = model.weights * both.std(axis=0)
    loss = lambda w: np.log1p(np.exp(-x @ w)).mean() + quality.RIDGE / 2 * w @ w
    for k in range(quality.FEATURES):
        step = np.eye(quality.FEATURES)[k] * 1e-4
        assert abs(loss(w + step) - loss(w - step)) / 2e-4 < 1e-5


def test_score_is_that_of_the_worst_window():
    rng = random.Random(5)
    texts = [words(rng, "xy"[i % 2], 40) for i in range(80)]
    model = toxicity.train(texts, np.array([i % 2 for i in range(80)]), steps=40)
    long = words(rng, "x", 130).split()
    long[60:70] = words(rng, "y", 10).split()
    parts = [long[a : a + toxicity.WINDOW] for a in range(0, len(long), toxicity.STRIDE)]
    parts = [" ".join(p) for p in parts if len(p) == toxicity.WINDOW] + [" ".join(long[-toxicity.WINDOW :])]
    whole = model.scores(pa.array([" ".join(long)]))[0]
    assert whole >= model.scores(pa.array(parts)).max() - 1e-6
