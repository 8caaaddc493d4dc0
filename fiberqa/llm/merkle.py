"""A Merkle tree over a table of documents, and the inclusion proof of every row.

Every language is a tree of its own whose subroots are the leaves of the top tree. A node has
up to eight children; the last node of a level may have fewer. A node's digest is the SHA-256 of
its children's digests as hexadecimal text.

Rows are sorted by (lang, doc_id) in ranges and lie on shelves of ``SHELF`` consecutive leaves.
A shelf sends only the nodes that it holds whole and whose parent it does not (at most seven on
either side of a level), from which the nodes across shelves are made, level by level. For
the proofs a shelf needs the union of the siblings of all its leaves' paths without what it can
derive itself: again at most seven nodes on either side of a level. These coordinates follow
from the places of its first and last leaf. They are fetched by one join; the shelf then derives
the interior nodes that its proofs share and expands the proof of each leaf.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.placement import placed
from ..sources.frames import cut

BITS = 3
WIDTH = 1 << BITS
SHELF = 1024
#: The number of the tree over the subroots. Languages are numbered from 0 in their order.
TOP = -1
_DEEPEST = 21

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    """``leaves`` have a place in their tree and a shelf; ``nodes`` are those that shelves exchange."""

    leaves: DataFrame  # doc_id, leaf, claimed, tree, n_trees, place, n, shelf
    nodes: DataFrame  # tree, n, level, idx, digest
    root: DataFrame  # root


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts, each as its number of bytes, a colon and the value, or ``-`` if null."""
    texts = [p.cast("string") for p in parts]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def leaf_digests(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, claimed): ``claimed`` is the leaf of the text that a checker would see.

    Where ``tampered`` holds, that text has its A-Z lower-cased. Elsewhere ``claimed`` is null,
    and the leaf itself is claimed.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    # ``translate`` makes an object of every character, ``lower`` none where all are ASCII.
    plain = F.octet_length(text) == F.char_length(text)
    changed = digest(*fields, F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        digest(*fields, F.col("text")).alias("leaf"),
        F.when(F.lit(False) if tampered is None else tampered, changed).alias("claimed"),
    )


def _hash(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _climb(first: int, digests: list[str], n: int, known: dict[tuple[int, int], str]) -> tuple[list[tuple[int, list[str]]], str]:
    """All levels above consecutive leaves of a tree of ``n`` as (first index, digests), and the root."""
    levels = []
    while n > 1:
        last = first + len(digests) - 1
        base, stop = first & -WIDTH, min((last | (WIDTH - 1)) + 1, n)
        level = len(levels)
        row = [known[level, i] for i in range(base, first)] + digests + [known[level, i] for i in range(last + 1, stop)]
        levels.append((base, row))
        first, n = base >> BITS, -(-n // WIDTH)
        digests = [_hash(row[k : k + WIDTH]) for k in range(0, len(row), WIDTH)]
    return levels, digests[0]


def _whole(first: int, digests: list[str], n: int) -> list[tuple[int, int, str]]:
    """(level, index, digest) of nodes that lie whole in a run of leaves and whose parent does not."""
    out, level = [], 0
    while digests:
        last = first + len(digests) - 1
        if n == 1:
            return [*out, (level, first, digests[0])]
        begin = -(-first // WIDTH) * WIDTH
        stop = last + 1 if last + 1 == n else (last + 1) // WIDTH * WIDTH
        if stop <= begin:
            return out + [(level, first + k, d) for k, d in enumerate(digests)]
        out += [(level, first + k, d) for k, d in enumerate(digests) if not begin <= first + k < stop]
        inner = digests[begin - first : stop - first]
        digests = [_hash(inner[k : k + WIDTH]) for k in range(0, len(inner), WIDTH)]
        first, n, level = begin >> BITS, -(-n // WIDTH), level + 1
    return out


def _runs(table: pa.Table) -> list[tuple[int, int, int, list[int]]]:
    """(tree, size, first place, rows) of each tree on a shelf, trees and rows in order."""
    trees, places, sizes = (table.column(c).to_pylist() for c in ("tree", "place", "n"))
    runs: dict[int, list[int]] = {}
    for i in sorted(range(len(trees)), key=lambda i: (trees[i], places[i])):
        runs.setdefault(trees[i], []).append(i)
    return [(t, sizes[rows[0]], places[rows[0]], rows) for t, rows in runs.items()]


_NODE = "tree long, n long, level int, idx long, digest string"


def _exchanged(table: pa.Table) -> pa.Table:
    leaves = table.column("leaf").to_pylist()
    rows = []
    for tree, n, first, at in _runs(table):
        rows += [(tree, n, *node) for node in _whole(first, [leaves[i] for i in at], n)]
    columns = list(zip(*rows))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["tree", "n", "level", "idx", "digest"])


def _size() -> Column:
    """Leaves under a full node of the row's level."""
    return F.expr(f"shiftleft(bigint(1), int(level * {BITS}))")


def _risen(nodes: DataFrame) -> DataFrame:
    """``nodes`` and all nodes above them. No node's parent may be there as well."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    level, parts = 0, [nodes]
    now = nodes.where("level = 0")
    while WIDTH**level < largest:
        children = now.where(F.col("n") > WIDTH**level)
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]), "")
        made = children.groupBy("tree", "n", F.shiftright("idx", BITS).alias("up")).agg(F.sha2(joined, 256).alias("digest"))
        level += 1
        made = cut(made.select("tree", "n", F.lit(level).alias("level"), F.col("up").alias("idx"), "digest"))
        parts.append(made)
        now = nodes.where(F.col("level") == level).unionByName(made)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _roots(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("n") <= _size())


def manifest(leaves: DataFrame) -> Manifest:
    """The trees over ``leaves(doc_id, lang, leaf, claimed)``.

    Rows without lang are a tree of their own, before all others; rows without doc_id come first
    in their tree. Rows of one doc_id are in order of their leaves, equal rows in any order. An
    empty table has no tree and no root.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    rows = placed(leaves, ["lang"], order, at="at")
    trees = placed(rows.select("lang", "n").distinct(), [], [F.col("lang").asc_nulls_first()], "tree", "n_trees")
    trees = cut(trees.select(F.col("lang").alias("__lang"), "tree", "n_trees"))
    rows = rows.join(trees, rows["lang"].eqNullSafe(trees["__lang"]))
    shelf = F.shiftright("at", SHELF.bit_length() - 1).alias("shelf")
    rows = cut(rows.select("doc_id", "leaf", "claimed", "tree", "n_trees", "place", "n", shelf))

    whole = cut(rows.select("shelf", "tree", "place", "n", "leaf").groupBy("shelf").applyInArrow(_exchanged, _NODE))
    nodes = _risen(whole)
    tops = trees.select("tree", "n_trees").join(_roots(nodes).select("tree", "digest"), "tree")
    tops = cut(tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("n_trees").alias("n"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "digest"))
    top = _risen(tops)
    return Manifest(rows, cut(nodes.unionByName(top)), cut(_roots(top).select(F.col("digest").alias("root"))))


def missing(runs: DataFrame) -> DataFrame:
    """(shelf, tree, level, idx) of the nodes that proofs of consecutive leaves need from elsewhere.

    ``runs`` has (shelf, tree, n, first, last). These are the siblings on the paths of the first
    and the last leaf that lie outside the run; all others can be derived.
    """
    levels = runs.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(_DEEPEST - 1)))).where(F.col("n") > _size())
    shift = "int(level * %d)" % BITS
    levels = levels.select(
        "shelf", "tree", "level",
        F.expr(f"shiftright(first, {shift})").alias("lo"),
        F.expr(f"shiftright(last, {shift})").alias("hi"),
        F.expr(f"shiftright(n - 1, {shift})").alias("end"),
    )
    left = F.expr(f"transform(sequence(0, {WIDTH - 2}), k -> lo - lo % {WIDTH} + k)")
    right = F.expr(f"transform(sequence(1, {WIDTH - 1}), k -> hi - hi % {WIDTH} + k)")
    outside = F.concat(F.filter(left, lambda i: i < F.col("lo")), F.filter(right, lambda i: (i > F.col("hi")) & (i <= F.col("end"))))
    return levels.select("shelf", "tree", "level", F.explode(outside).alias("idx"))


def _expanded(leaves: pa.Table, fetched: pa.Table, siblings: bool) -> pa.Table:
    known: dict[int, dict[tuple[int, int], str]] = {}
    for tree, level, idx, d in zip(*(fetched.column(f"{c}_of_node").to_pylist() for c in ("tree", "level", "idx", "digest"))):
        known.setdefault(tree, {})[level, idx] = d
    ids, digests, claims = (leaves.column(c).to_pylist() for c in ("doc_id", "leaf", "claimed"))
    runs = _runs(leaves)
    made = [_climb(first, [digests[i] for i in rows], n, known.get(tree, {})) for tree, n, first, rows in runs]
    if runs:
        top, root = _climb(runs[0][0], [m[1] for m in made], leaves.column("n_trees")[0].as_py(), known.get(TOP, {}))
    out = []
    for (tree, _, first, rows), (levels, subroot) in zip(runs, made):
        # The levels of the way to the root, with the place of a leaf at each.
        way = [(level, base, row) for level, (base, row) in enumerate(levels)]
        above = _beside(tree, top)
        shared: list[tuple[int, list[tuple[str, str]]] | None] = [None] * (len(way) + 1)

        def beside(place: int, level: int = 0) -> list[tuple[str, str]]:
            """(left, right) siblings at each level from ``level`` up; kept for the next leaf under the same node."""
            at = place >> (BITS * level)
            if level == len(way):
                return above
            if shared[level] is None or shared[level][0] != at:
                _, base, row = way[level]
                group = (at & -WIDTH) - base
                pair = ("".join(row[group : at - base]), "".join(row[at - base + 1 : group + WIDTH]))
                shared[level] = (at, [pair, *beside(place, level + 1)])
            return shared[level][1]

        for k, i in enumerate(rows):
            pairs = beside(first + k)
            proof = "".join([s for pair in pairs for s in pair])
            folded = root
            if claims[i] is not None and claims[i] != digests[i]:
                folded = claims[i]
                for left, right in pairs:
                    folded = sha256(f"{left}{folded}{right}".encode()).hexdigest()
            row = (ids[i], digests[i], subroot, sha256(proof.encode()).hexdigest(), folded)
            out.append((*row, [proof[c : c + 64] for c in range(0, len(proof), 64)]) if siblings else row)
    names = ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root", "siblings"][: 5 + siblings]
    types = [pa.int64(), *[pa.string()] * 4, pa.list_(pa.string())]
    columns = list(zip(*out)) or [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _beside(place: int, levels: list[tuple[int, list[str]]]) -> list[tuple[str, str]]:
    out = []
    for base, row in levels:
        group = (place & -WIDTH) - base
        out.append(("".join(row[group : place - base]), "".join(row[place - base + 1 : group + WIDTH])))
        place >>= BITS
    return out


def proofs(made: Manifest, siblings: bool = False) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row for each leaf.

    ``folded_root`` is recomputed from the claimed leaf and the siblings of the proof, which
    ``siblings=True`` adds as an array, level by level to the root and left to right.
    """
    leaves = made.leaves
    runs = leaves.groupBy("shelf", "tree", "n").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    tops = leaves.groupBy("shelf", F.col("n_trees").alias("n")).agg(F.min("tree").alias("first"), F.max("tree").alias("last"))
    runs = runs.unionByName(tops.withColumn("tree", F.lit(TOP).cast("long")))
    fetched = missing(runs).join(made.nodes.select("tree", "level", "idx", "digest"), ["tree", "level", "idx"])
    # New names: both sides of the grouping come from the same table.
    fetched = fetched.select(*[F.col(c).alias(f"{c}_of_node") for c in ("shelf", "tree", "level", "idx", "digest")])
    schema = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string" + (", siblings array<string>" if siblings else "")
    grouped = leaves.groupBy("shelf").cogroup(fetched.groupBy("shelf_of_node"))
    expanded = grouped.applyInArrow(lambda a, b: _expanded(a, b, siblings), schema)
    more = ["siblings"] if siblings else []
    # One row: the root.
    return expanded.crossJoin(F.broadcast(made.root)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), *more
    )
