"""Language of texts by compression.

Each language has a zstandard dictionary that is nothing but text of it. A text is cut into
pieces, each piece is compressed with every dictionary, and the language whose dictionary
makes the sum smallest is chosen. Pieces are short because a compressor soon learns the text
itself, after which the dictionary says little. Only letters count, in lower case, with single
spaces for all else. A narrow margin is a rejection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.frames import cut, join_per_group
from .sampling import spread
from .words import chunks

PIECE = 2048
#: Matches from three bytes on are what tells short pieces apart; a small window suffices.
SEARCH = {"strategy": zstandard.STRATEGY_LAZY2, "min_match": 3, "window_log": 16, "chain_log": 15, "hash_log": 15, "search_log": 3}
BARE = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
#: At most so many texts of a language, and so many bytes of them, make its dictionary.
PER_LANGUAGE, DICTIONARY = 300, 1 << 15
#: A long text gives so many pieces of itself.
PARTS = 4
#: Bytes of dictionaries that are sent to the tasks at once. More languages take more blocks.
BLOCK = 8 << 20
#: The smallest share by which the runner-up must be larger.
MARGIN = 0.01
UNKNOWN = "und"


_TO_SPACE = bytes(x if x >= 0x80 or chr(x).isalpha() else 0x20 for x in range(256))


def letters_of(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split())


@dataclass
class Model:
    languages: list[str]
    dictionaries: list[bytes]


def dictionary(texts: list[str], size: int) -> bytes:
    """Letters of all ``texts``, an equal share of ``size`` of each; what short ones leave goes to the others."""
    letters = [letters_of(t) for t in texts]
    left, parts = size, [b""] * len(letters)
    for n, i in enumerate(sorted(range(len(letters)), key=lambda i: len(letters[i]))):
        parts[i] = letters[i][: max(0, left // (len(letters) - n) - 1)]
        left -= len(parts[i]) + 1
    return b" ".join(filter(None, parts))


def _shares(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Of each whole text ``share`` bytes of letters, in pieces from its begin to its end."""
    for batch in chunks(batches):
        parts = [b" ".join(spread(letters_of(t), share, share // PARTS)).decode("utf-8", "ignore") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(parts, pa.string())], names=["doc_id", "lang", "text"])


def _dictionaries(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [dictionary([t["text"] for t in texts], size) for texts in batch.column("texts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(made, pa.binary())], names=["lang", "content"])


def fit(docs: DataFrame, learn: Column | None = None, per_language: int = PER_LANGUAGE, size: int = DICTIONARY) -> Model:
    """Dictionaries from at most ``per_language`` texts of each non-null ``lang``.

    The texts are taken in order of a hash of their doc_id; each gives letters from its begin to
    its end. Dictionaries are made in tasks; the
    driver holds ``size`` bytes of each language.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        usable = usable.where(learn)
    usable = usable.where(F.length("text") > 0)
    keys = [F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")]
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = usable.select(*keys).withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_language)
    first = cut(ranked.select("doc_id", "lang").distinct())
    share = 4 * size // per_language + 1  # bytes of a text; the sample is bounded in bytes, too
    texts = join_per_group(usable.select(*keys, F.col("text").cast("string").alias("text")), first, ["doc_id", "lang"])
    texts = texts.select("doc_id", "lang", "text").mapInArrow(lambda it: _shares(it, share), "doc_id long, lang string, text string")
    each = texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))  # repeated ids are one text
    per = each.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("texts"))
    rows = sorted(tuple(r) for r in per.mapInArrow(lambda it: _dictionaries(it, size), "lang string, content binary").collect())
    return Model([r[0] for r in rows], [bytes(r[1]) for r in rows])


def sizes(texts: list[bytes], model: Model) -> np.ndarray:
    """Compressed bytes of each text (rows) with each dictionary (columns)."""
    out = np.zeros((len(texts), len(model.languages)))
    for j, content in enumerate(model.dictionaries):
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parameters = zstandard.ZstdCompressionParameters(**SEARCH, **BARE)
        made.precompute_compress(compression_params=parameters)
        press = zstandard.ZstdCompressor(compression_params=parameters, dict_data=made).compress
        for i, text in enumerate(texts):
            out[i, j] = sum(len(press(text[k : k + PIECE])) for k in range(0, len(text), PIECE))
    return out


def _predicted(batches: Iterator[pa.RecordBatch], blocks: list[Broadcast], margin: float) -> Iterator[pa.RecordBatch]:
    languages = [name for block in blocks for name in block.value.languages]
    for batch in chunks(batches):
        read = batch.column("text").to_pylist()
        able = np.array([any(map(str.isalpha, t or "")) for t in read], bool)
        texts = [letters_of(t or "") for t in read]
        best, least, second = np.zeros(len(texts), int), np.full(len(texts), np.inf), np.full(len(texts), np.inf)
        begin = 0
        for block in blocks:
            total = sizes(texts, block.value)
            best = np.where(total.min(axis=1) < least, begin + total.argmin(axis=1), best)
            least, second = np.sort(np.column_stack([least, second, total]), axis=1)[:, :2].T
            begin += total.shape[1]
        if not languages:
            least = second = np.ones(len(texts))
        second = np.where(np.isinf(second), least * 2, second)
        gap = np.where(able & (second > 0), (second - least) / np.maximum(second, 1), 0.0)
        able &= len(languages) > 0
        names = [languages[b] if ok else UNKNOWN for b, ok in zip(best, able)]
        kept = batch.select([c for c in batch.schema.names if c != "text"])
        columns = [pa.array(names, pa.string()), pa.array(np.where(able, np.clip(0.5 + gap * 5, 0, 1), 0.0)), pa.array(able & (gap >= margin))]
        yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, "lang_pred", "score", "accepted"])


def predict_language(docs: DataFrame, model: Model, margin: float = MARGIN, block: int = BLOCK) -> DataFrame:
    """(doc_id, lang_pred, score, accepted), one row for each row of ``docs(doc_id, text)``.

    Whole texts are compressed. ``lang_pred`` is a learned language (the first of equals), or
    ``und`` for a null text, one without a letter, or where nothing was learned; then ``score``
    is 0. Else it grows with the margin from 0.5 to 1. ``accepted`` is false where the margin is
    below ``margin``: the caller may treat these as unknown. Repeated rows are treated alike, an
    empty table gives none, other columns are not read. Dictionaries are sent in blocks of a
    bounded size, all of which a text meets in one pass.
    """
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    ends = np.cumsum([0, *map(len, model.dictionaries)])[:-1] // block
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)] if len(ends) else []
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(Model(model.languages[a:b], model.dictionaries[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
    return chosen.mapInArrow(lambda it: _predicted(it, blocks, margin), f"doc_id {kind}, lang_pred string, score double, accepted boolean")
