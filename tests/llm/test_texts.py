"""Classifiers, tokenizers and secret scans: held-out accuracy, exact parity, brute force."""

import os
import random
import re

import pyarrow as pa
import pytest
from fiberqa.llm import counts, language, pieces, quality, secrets, toxicity
from fiberqa.llm.queries import DEFAULT_PIECE_MODEL, QUERIES
from pyspark.sql import functions as F

LARGER = "/root/testdata/sf0.1"
model_file = pytest.mark.skipif(not os.path.exists(DEFAULT_PIECE_MODEL), reason="no tokenizer files here")
ODD = ["", " ", "  ", "   a  b ", "\n\n x", "<s> hi </s><unk>", "日本語 🎉🎊", "a\tb　c", "▁▁x ▁", "<0x41>", " aaaa aaaaaa", "x" * 500, "à" * 7, None]


def test_held_out_accuracy(sent):
    docs, labels = (sent.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    spoken = QUERIES["op3_language"](sent, LARGER).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert spoken.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    for name, label in (("op4_toxicity", "toxic"), ("op5_quality", "quality")):
        judged = QUERIES[name](sent, LARGER).where("held_out").join(labels.where(F.col(label).isNotNull()), "doc_id")
        right = judged.groupBy(label).agg(F.avg((F.col(label) == F.col("predicted")).cast("int")).alias("right")).collect()
        assert len(right) == 2 and all(r["right"] > 0.9 for r in right), right


def test_scores_of_odd_documents(sent, edge, nothing):
    labels = sent.createDataFrame([(1, 1, 1), (5, 0, 0), (6, 0, 0), (7, 1, 0), (7, 0, 1), (99, 1, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    for module, fit, score in ((toxicity, toxicity.fit, toxicity.score_toxicity), (quality, quality.fit, quality.score_quality)):
        for model in (fit(edge, labels), fit(nothing, labels), fit(edge, labels.where("false"))):
            rows = score(edge, model).collect()
            assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
            assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
            assert score(nothing, model).count() == 0


def test_language_of_odd_documents(edge, nothing):
    model = language.fit(edge)
    rows = language.predict_language(edge, model).collect()
    assert len(rows) == edge.count()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {2, 3, 4, 9}
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = language.fit(nothing)
    assert {r["lang_pred"] for r in language.predict_language(edge, empty).collect()} == {"und"}
    assert language.predict_language(nothing, model).count() == 0


def test_every_language_is_learned(sent):
    """More languages than 64, a rare one of long texts only, and dictionaries in several blocks."""
    rng = random.Random(7)
    words = {f"l{n:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for n in range(70)}

    def text(lang, size):
        return " ".join(rng.choice(words[lang]) for _ in range(size))

    rows = [(2 * n + i, text(lang, 60), lang) for n, lang in enumerate(words) for i in range(2 if n < 66 else 1)]
    rows = [r for r in rows if r[2] != "l00"] + [(1000 + i, text("l00", 60) + " 1" * 40_000, "long") for i in range(3)] + [(1010, "12 34", "none")]
    model = language.fit(sent.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == sorted({r[2] for r in rows})
    asked = sent.createDataFrame([(n, text(lang, 40)) for n, lang in enumerate(words)], "doc_id long, text string")
    for block in (language.BLOCK, 4000):
        got = {r["doc_id"]: r["lang_pred"] for r in language.predict_language(asked, model, block=block).collect()}
        assert got == {n: "long" if lang == "l00" else lang for n, lang in enumerate(words)}


def test_each_text_has_its_share_of_a_dictionary():
    made = language.dictionary(["a" * 500, "b" * 3, "c" * 500, "d" * 500, "12"], 300)
    assert len(made) <= 300 and made.count(b"b") == 3
    assert min(made.count(x) for x in (b"a", b"c", b"d")) >= 95


@model_file
def test_pieces_match_the_original_library(sent, edge, nothing):
    import sentencepiece

    rng = random.Random(1)
    texts = [t for t in ODD if t is not None] + ["".join(rng.choice("ab thé.,\n▁ ß日<>0x") for _ in range(rng.randrange(80))) for _ in range(300)]
    assert pieces.mismatches(DEFAULT_PIECE_MODEL, texts) == []
    original = sentencepiece.SentencePieceProcessor(model_file=DEFAULT_PIECE_MODEL)
    rows = pieces.encode(edge, DEFAULT_PIECE_MODEL).collect()
    given = {r["doc_id"]: r["text"] or "" for r in edge.collect()}
    assert len(rows) == edge.count()
    for r in rows:
        assert r["ids"] == original.encode(given[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["same"] == (r["decoded"] == given[r["doc_id"]]) and (r["same"] or "▁" in given[r["doc_id"]])
    back = pieces.decode(pieces.encode(edge, DEFAULT_PIECE_MODEL).select("doc_id", "ids", "decoded"), DEFAULT_PIECE_MODEL)
    assert sorted(map(repr, back.select("doc_id", "decoded").collect())) == sorted(repr(x) for x in pieces.encode(edge, DEFAULT_PIECE_MODEL).select("doc_id", "decoded").collect())
    assert pieces.encode(nothing, DEFAULT_PIECE_MODEL).count() == 0


def unigram(fallback: bool) -> pieces.PieceModel:
    letters = [("<unk>", 0.0, pieces.UNKNOWN), ("▁", -3.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("c", -4.0, 1)]
    longer = [("ab", -6.0, 1), ("▁a", -6.0, 1), ("bc", -6.5, 1), ("▁ab", -9.0, 1), ("▁▁", -5.0, 1), ("abc", -10.0, 1)]
    single = [(f"<0x{i:02X}>", -20.0, pieces.BYTE) for i in range(256)] if fallback else []
    return pieces.PieceModel(letters + longer + single, pieces.UNIGRAM, fallback, squeeze=False)


@pytest.mark.parametrize("fallback", [True, False])
def test_counts_follow_the_tokenizer_in_ties(fallback):
    model = unigram(fallback)
    tokenizer, counter = pieces.build(model), counts.Counter(model)
    rng = random.Random(1)
    texts = ["", "abc", "é", "éé a éé", "  a"] + ["".join(rng.choice("aabbc  éz") for _ in range(rng.randrange(25))) for _ in range(400)]
    number, score = counter.counts(pa.array(texts))
    assert number.tolist() == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    again, _ = counter.counts(pa.array(texts[::-1]))
    assert again.tolist() == number.tolist()[::-1]


@model_file
def test_counts_with_a_real_vocabulary(edge, nothing):
    with open(DEFAULT_PIECE_MODEL, "rb") as f:
        model = pieces.parse(f.read())
    model.kind = pieces.UNIGRAM
    tokenizer = pieces.build(model)
    rows = counts.count_tokens(edge, DEFAULT_PIECE_MODEL).collect()
    given = {r["doc_id"]: r["text"] or "" for r in edge.collect()}
    assert len(rows) == edge.count()
    assert all(r["n_tokens"] == len(tokenizer.encode(given[r["doc_id"]], add_special_tokens=False).ids) for r in rows)
    assert counts.count_tokens(nothing, DEFAULT_PIECE_MODEL).count() == 0


def spans_brute(text):
    out = []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, m.end(), "assign")] if len(m[2]) >= 6 else []
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets(sent, edge, nothing):
    live, copied = "AKIA" + "Q7" * 8, "AKIA" + "Z3" * 9
    texts = [
        f"é🎉 key {live} and password = token: abcdefgh, Token='short' api_key:\"{'0a' * 14}\"",
        f"copied {copied} twice {copied}", f"{copied} PASSWORD==hunter2secret", "secret: tiny", "deadbeef" * 3 + " mixed9Token8With7Digits6xx", None, "",
    ]
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)] + [(0, texts[0], "s0"), (None, texts[2], None)]
    frame = sent.createDataFrame(rows, "doc_id long, text string, source string")
    got = secrets.scan_secrets(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"] if r["doc_id"] is not None else 2] or ""
        assert [(s["start"], s["order"], s["end"], s["kind"]) for s in r["base"]] == spans_brute(text)
        assert all(s["live"] == (text[s["start"] : s["end"]] != copied and r["doc_id"] not in (2, None)) for s in r["spans"] if s["kind"] == "access")
    assert any(s["kind"] == "token" for r in got if r["doc_id"] == 4 for s in r["spans"])
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(frame).collect()}
    assert live not in clean[0] and copied in clean[1] and clean[3] == texts[3] and clean[5] is None
    assert secrets.MARK in clean[0]
    assert secrets.scan_secrets(edge).count() == edge.count() and secrets.scan_secrets(nothing).count() == 0
