"""Byte-pair encoding against the library whose files it reads."""

import random
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from fiberqa.llm import bytepairs
from hypothesis import given, settings
from hypothesis import strategies as st

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    ranks = bytepairs.read_ranks(P.path(request.param))
    return bytepairs.Codec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode([text])[0], "<u4").tolist()


def test_odd_texts(both):
    codec, library = both
    rng = random.Random(3)
    texts = ["", " ", "\n\n  x", "a" * 5000, "ab" * 3000, "don't  we'll I'd", "<|endoftext|>", "日本語のテキスト" * 50, "\x00\x1c\x85　", "🎉🎉 é é", "١٢٣ ²½"]
    texts += ["".join(rng.choice("abcde") for _ in range(n)) for n in (2, 30, 3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x500), rng.randrange(0x4E00, 0x9FFF)])) for _ in range(300)) for _ in range(20)]
    for t in texts:
        assert ids(codec, t) == library.encode_ordinary(t)
        assert codec.decode(codec.encode([t])[0]) == t.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    codec, library = _first()
    assert ids(codec, text) == library.encode_ordinary(text)


_PAIR: list = []


def _first():
    if not _PAIR:
        ranks = bytepairs.read_ranks(P.path(FILES[0]))
        _PAIR[:] = [bytepairs.Codec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})]
    return _PAIR


def plain_merge(tokens, data):
    if data in tokens:
        return [tokens[data]]
    parts = [bytes([b]) for b in data]
    while True:
        ranks = [(tokens[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in tokens]
        if not ranks:
            return [tokens[p] for p in parts]
        _, i = min(ranks)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_many_texts_and_small_blocks(both, monkeypatch):
    """Texts that end inside, at and behind the border of a block, while generations change."""
    codec, library = both
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["the", "cat", "zqx", "q" * 90, "é"]) + str(rng.randrange(40)) for _ in range(rng.randrange(30))) for _ in range(200)]
    for block, kept in [(1, 3), (7, 20), (64, 10**6)]:
        monkeypatch.setattr(bytepairs, "BLOCK", block)
        monkeypatch.setattr(bytepairs, "KEPT", kept)
        monkeypatch.setattr(bytepairs, "LONG", block)
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_any_ranks():
    """Ranks that no training would give: a merge may make a pair of lower rank than its own."""
    rng = random.Random(11)
    for _ in range(300):
        tokens = {bytes([b]): b for b in range(256)}
        for k in range(rng.randrange(1, 120)):
            tokens.setdefault(bytes(rng.choice(b"ab") for _ in range(rng.randrange(2, 7))), 256 + k)
        codec = bytepairs.Codec(tokens, ".+")
        texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(4))]
        assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [plain_merge(tokens, t.encode()) if t else [] for t in texts]


def take(queue):
    rank = queue.lowest()
    place = min(queue.places[rank])
    queue.places[rank].remove(place)
    if not queue.places[rank]:
        queue.clear(rank)
    return rank, place


def test_rank_queue_takes_the_lowest_rank_and_the_leftmost_place():
    rng = random.Random(2)
    queue, held = bytepairs.RankQueue(300_000), []
    for _ in range(5000):
        if held and rng.random() < 0.45:
            held.sort()
            assert take(queue) == held.pop(0)
        else:
            entry = (rng.choice([rng.randrange(300_000), rng.randrange(5)]), rng.randrange(10**6))
            held.append(entry)
            queue.push(*entry)
    for entry in sorted(held):
        assert take(queue) == entry
    assert queue.lowest() is None


def test_pre_token_of_a_million_bytes(both):
    codec, _ = both
    text = "".join(random.Random(1).choices("etaoin", k=1_000_000))
    start = time.perf_counter()
    found = codec.encode([text])[0]
    assert time.perf_counter() - start < 60
    assert codec.decode(found) == text.encode()


def test_tables(sent, edge, nothing):
    model = P.path(FILES[0]), P.PATTERN
    _, library = _first()
    encoded = bytepairs.encode(edge, *model)
    rows = bytepairs.decode(encoded.selectExpr("*", "'x' decoded", "1 AS place"), *model).collect()
    got = sorted(((r["doc_id"], r["n_tokens"], bytes(r["decoded"]).decode()) for r in rows), key=repr)
    want = [(r["doc_id"], len(library.encode_ordinary(r["text"] or "")), r["text"] or "") for r in edge.collect()]
    assert got == sorted(want, key=repr)
    stored = {(r["doc_id"], r["n_tokens"]): np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in encoded.collect()}
    assert stored == {(i, n): library.encode_ordinary(t) for i, n, t in want}
    assert bytepairs.decode(bytepairs.encode(nothing, *model), *model).collect() == []


def test_query(sent):
    from hashlib import sha256

    from fiberqa.llm.queries import QUERIES

    from ..conftest import DATA

    _, library = _first()
    want = []
    for r in sent.read.parquet(f"{DATA}/documents.parquet").collect():
        found = library.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(found), sha256(np.array(found, "<u4").tobytes()).hexdigest(), sha256((r["text"] or "").encode()).hexdigest()))
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(tuple(r[c] for c in names) for r in QUERIES["op13_bytepairs"](sent, DATA).collect()) == sorted(want)
