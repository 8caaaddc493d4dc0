"""Encoding and decoding with SentencePiece models by the ``tokenizers`` library.

The model file is parsed here, and its normaliser, white-space marker, scores or merges and
byte fallback are built anew. What was built is held against the original library: on every
text that is handed to ``mismatches``, and by decoding whatever was encoded.

Where no piece goes on with white space behind other characters, a run of spaces and the word
after it is encoded alone. Then a worker encodes each such group once and puts the texts
together from numbers; the groups that it has not met go through the library in one batch.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from .words import bytes_of, chunks, hash_words

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while i < len(data):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or (varint() if kind == 2 else None)
        if size is None or i + size > len(data):
            raise ValueError("not a SentencePiece model")
        yield number, data[i : i + size]
        i += size


@dataclass
class PieceModel:
    """What a model file says. Field numbers and defaults are those of the published format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @property
    def unknown(self) -> int:
        return next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)


def parse(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            said = dict(_fields(value))
            model.kind, model.byte_fallback = said.get(3, model.kind), bool(said.get(35, model.byte_fallback))
        elif number == 3:
            said = dict(_fields(value))
            model.charsmap = said.get(2, b"")
            model.dummy_prefix, model.squeeze, model.escape = (bool(said.get(n, 1)) for n in (3, 4, 5))
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """All ways to make a piece of two others, best piece first."""
    usable = {p: (score, i) for i, (p, score, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, (score, i) in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-score, i, usable[left][1], usable[right][1], left, right))
    return [(x[4], x[5]) for x in sorted(found)]


def crosses(model: PieceModel) -> bool:
    """Whether some piece goes on with white space behind other characters."""
    return any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind != CONTROL)


def build(model: PieceModel, prefix: bool = True) -> Tokenizer:
    """``prefix=False`` leaves the marker in front of a text out, for groups inside a text."""
    if model.kind == BPE:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model), unk_token=model.pieces[model.unknown][0],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    else:
        raise ValueError("only unigram and byte-pair models are built")
    tokenizer = Tokenizer(core)
    prefix = prefix and model.dummy_prefix
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.escape and not crosses(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    tail = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(tail + [decoders.Strip(" ", 1, 0)] * prefix)
    return tokenizer


class Encoder:
    """Ids and round trips of batches of texts.

    Groups are kept by a 64-bit hash, as arrays: where a group's ids begin, how many there are,
    and whether they decode to the group. When ``KEPT`` groups are passed, all are forgotten.
    """

    KEPT, AT_ONCE = 1_000_000, 50_000

    def __init__(self, model: PieceModel):
        self.tokenizer = build(model)
        plain = model.escape and model.dummy_prefix and not model.squeeze and not model.charsmap
        self.groups = build(model, prefix=False) if plain and not crosses(model) else None
        self.leads = np.array([p.startswith(MARK) for p, _, _ in model.pieces], bool)
        self.pure = np.array([p != "" and not p.strip(MARK) for p, _, _ in model.pieces], bool)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.size, self.true, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int32)

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.groups.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.groups.decode_batch(ids, skip_special_tokens=False)
        size = np.array([len(x) for x in ids], np.int64)
        return size, np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), np.array([a == b for a, b in zip(texts, back)], bool)

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for groups that may follow each other in one text, where each begins with a marker."""
        whole = "".join(texts)
        ids = np.array(self.groups.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.int32)
        start = self.leads[ids]
        start[1:] &= ~self.pure[ids[:-1]]
        at = np.flatnonzero(start)
        if len(at) != len(texts) or self.groups.decode(ids.tolist(), skip_special_tokens=False) != whole:
            return self._apart(texts)
        return np.diff(np.append(at, len(ids))), ids, np.ones(len(texts), bool)

    def _learn(self, hashes: np.ndarray, names: list[bytes]) -> None:
        alone = np.array([x.isspace() for x in names], bool)
        for kind, encode in ((True, self._apart), (False, self._together)):
            chosen = np.flatnonzero(alone == kind)
            for i in range(0, len(chosen), self.AT_ONCE):
                some = chosen[i : i + self.AT_ONCE]
                size, flat, true = encode([names[j].decode() for j in some])
                self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
                self.size, self.flat, self.true = (np.concatenate(x) for x in ((self.size, size), (self.flat, flat), (self.true, true)))
                self.hashes = np.concatenate([self.hashes, hashes[some]])
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.begin, self.size, self.true = (x[order] for x in (self.hashes, self.begin, self.size, self.true))

    def _places(self, distinct: np.ndarray, name) -> np.ndarray:
        """Where each group is kept; those that are not kept yet are encoded first."""
        for again in (False, True):
            at = np.searchsorted(self.hashes, distinct)
            there = at < len(self.hashes)
            there[there] = self.hashes[at[there]] == distinct[there]
            new = np.flatnonzero(~there)
            if not len(new):
                return at
            if not again and len(self.hashes) + len(new) > self.KEPT:
                self._forget()
                new = np.arange(len(distinct))
            self._learn(distinct[new], [name(j) for j in new])
        return np.searchsorted(self.hashes, distinct)

    def encode(self, column: pa.Array) -> tuple[pa.ListArray, pa.Array, np.ndarray]:
        """Ids, decoded texts, and whether these are the given texts."""
        column = column.fill_null("")
        if self.groups is None:
            ids, decoded, same = self._whole(column.to_pylist())
            return pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), np.array(same, bool)
        marked = pc.match_substring(column, MARK)
        if pc.any(marked).as_py():  # beside spaces such a marker joins two groups
            lists, decoded, same = (list(x) for x in self._split(pc.if_else(marked, "", column), to_lists=True))
            at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
            for i, *found in zip(at, *self._whole(column.take(pa.array(at)).to_pylist())):
                lists[i], decoded[i], same[i] = found
            return pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string()), np.array(same, bool)
        return self._split(column)

    def _whole(self, texts: list[str]) -> tuple[list[list[int]], list[str], list[bool]]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return ids, decoded, [a == b for a, b in zip(texts, decoded)]

    def _split(self, column: pa.Array, to_lists: bool = False):
        """By groups."""
        data, offsets = bytes_of(pc.binary_join_element_wise(pa.scalar(" "), column, ""))
        starts, ends, first = _groups(data, offsets)
        distinct, at, token = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        at = self._places(distinct, lambda j: data[starts[at[j]] : ends[at[j]]].tobytes())[token]
        each = self.size[at]
        total = np.concatenate([[0], np.cumsum(each)])
        place = np.repeat(self.begin[at] - total[:-1], each) + np.arange(total[-1])
        wrong = np.concatenate([[0], np.cumsum(~self.true[at])])
        same = wrong[first[1:]] == wrong[first[:-1]]
        ids = pa.ListArray.from_arrays(pa.array(total[first].astype(np.int32)), pa.array(self.flat[place]))
        decoded = column
        if not same.all():
            odd = np.flatnonzero(~same)
            texts = self.tokenizer.decode_batch([ids[int(i)].as_py() for i in odd], skip_special_tokens=False)
            every = column.to_pylist()
            for i, t in zip(odd, texts):
                same[i], every[i] = t == every[i], t
            decoded = pa.array(every, pa.string())
        return (ids.to_pylist(), decoded.to_pylist(), same) if to_lists else (ids, decoded, same)


def _groups(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of spaces with the word behind them, of texts that each begin with an added space."""
    space = data == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offsets[:-1]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    empty = np.diff(offsets) == 1
    if empty.any():
        full = ~np.isin(starts, offsets[:-1][empty])
        starts, ends = starts[full], ends[full]
    return starts, ends, np.searchsorted(starts, offsets)


_BUILT: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    """The encoder of a shipped model file, built once in a worker."""
    path = SparkFiles.get(name)
    if path not in _BUILT:
        with open(path, "rb") as f:
            _BUILT[path] = Encoder(parse(f.read()))
    return _BUILT[path]


def shipped(spark: SparkSession, path: str) -> str:
    """Send a model file to the executors; its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def mismatches(path: str, texts: list[str]) -> list[str]:
    """Those texts that the original library encodes differently."""
    import sentencepiece

    with open(path, "rb") as f:
        own = Encoder(parse(f.read()))
    original = sentencepiece.SentencePieceProcessor(model_file=path)
    ours = own.encode(pa.array(texts, pa.string()))[0].to_pylist()
    return [t for t, a, b in zip(texts, ours, original.encode(texts, num_threads=1)) if a != b]


def _encoded(batches: Iterator[pa.RecordBatch], name: str, threads: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    # The library's threads share a task's cores.
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    encoder = _encoder(name)
    for batch in chunks(batches):
        ids, decoded, same = encoder.encode(batch.column("text"))
        kept = batch.select([c for c in batch.schema.names if c != "text"])
        counts = pa.array(np.diff(ids.offsets.to_numpy()).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, ids, counts, *[decoded] * keep_text, pa.array(same)], names=[*kept.schema.names, "ids", "n_tokens", *["decoded"] * keep_text, "same"]
        )


def encode(docs: DataFrame, path: str, threads: int = 1, keep_text: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded, same), one row for each row of ``docs(doc_id, text)``.

    ``path`` is a SentencePiece model on the driver; Spark sends it to the executors. ``same``
    says whether the decoded text is the given one; a model whose normaliser changes texts
    gives its normalised form. A null text is an empty one: no tokens, ``decoded`` empty,
    ``same`` true. Repeated rows are encoded alike; an empty table gives none; other columns
    are not read. No special tokens are added, and their names in a text are ordinary text.
    ``keep_text=False`` leaves ``decoded`` out.
    """
    name = shipped(docs.sparkSession, path)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {kind}, ids array<int>, n_tokens long, " + "decoded string, " * keep_text + "same boolean"
    return chosen.mapInArrow(lambda it: _encoded(it, name, threads, keep_text), kinds)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its column ``ids``; null ids give a null text."""
    name = shipped(encoded.sparkSession, path)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _encoder(name).tokenizer
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            some = tokenizer.decode_batch([[t for t in x or [] if t is not None] for x in ids], skip_special_tokens=False)
            yield batch.append_column("decoded", pa.array([None if x is None else t for x, t in zip(ids, some)], pa.string()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.drop("decoded").schema.fields)
    return encoded.drop("decoded").mapInArrow(texts, f"{kinds}, decoded string")
