"""Merkle manifest of a table: one tree a group, one over the groups, and proofs by octopus multiproofs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latticework.operators.joins import lookup
from latticework.session import materialize

# Children of a node.
ARITY = 3
# Levels that one task builds at once: a block is the leaves, or nodes, below one node of that height.
BLOCK_LEVELS = 8


def encoded(value: Column) -> Column:
    """A field as text: ``-`` for null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(id, grp, digest, claimed) of documents: the digest of each row, grouped by source.

    ``claimed`` is what a tampered copy would claim: where the CRC-32 of the decimal id is even, the text without
    its line feeds; a null id is not tampered with.
    """
    def digest(text: Column) -> Column:
        return leaf_digest([*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text])

    text = F.col("text")
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(text, F.lit("\n"))
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text", digest(text).alias("digest"))
    claimed = F.when(tampered, digest(F.replace(text, F.lit("\n"), F.lit("")))).otherwise(F.col("digest"))
    return rows.select(F.col("doc_id").cast("long").alias("id"), F.col("source").alias("grp"), "digest", claimed.alias("claimed"))


def _digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# Leaves by number ---------------------------------------------------------------------------------------------


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of each group in the order in which a task gets them, sorted by group."""
    task, last, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        groups = batch.column("grp").to_pylist()
        numbers = np.zeros(len(groups), np.int64)
        for i, group in enumerate(groups):
            at = at + 1 if group == last else 0
            numbers[i], last = at, group
        columns = [*batch.columns, pa.array(np.full(len(groups), task), pa.int32()), pa.array(numbers)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "task", "place"])


def numbered(leaves: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``leaves`` with ``ix``, their number from 0 in their group (column grp, not null), and ``n``, the group's size.

    Rows are ranged by group and order and numbered inside the ranges; then one row a range and group carries how
    many come before. Rows that are the same in all of ``order`` are spread too.
    """
    spread = leaves.withColumn("spread", F.monotonically_increasing_id())
    keys = ["grp", *(F.col(c).asc_nulls_first() for c in order), "spread"]
    ranged = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    placed = materialize(ranged.mapInArrow(_number, f"{fields}, task int, place long"), label)
    sizes = materialize(placed.groupBy("grp", "task").agg(F.count("*").alias("rows")), label)
    # Ranges are few and a group has one row in each; running sums go over tasks of one group.
    earlier = Window.partitionBy("grp").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = sizes.select(
        "grp", "task", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("begun"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("n"),
    )
    found = lookup(placed, begun, ["grp", "task"]).withColumn("ix", F.col("begun") + F.col("place"))
    return found.drop("task", "place", "begun")


# Nodes --------------------------------------------------------------------------------------------------------


def _grow(arity: int, levels: int):
    def run(block: pa.Table) -> pa.Table:
        """The nodes above a block of nodes of one level, up to ``levels`` higher."""
        group, n, level = (block.column(c)[0].as_py() for c in ("grp", "n", "level"))
        order = np.argsort(np.asarray(block.column("ix")))
        digests = block.column("digest").take(pa.array(order)).to_pylist()
        first = int(block.column("ix")[int(order[0])].as_py())
        rows = []
        for step in range(1, levels + 1):
            if n <= 1:
                break
            digests = [_digest(digests[i : i + arity]) for i in range(0, len(digests), arity)]
            first, n = first // arity, -(-n // arity)
            rows += [(level + step, first + i, digest) for i, digest in enumerate(digests)]
        return pa.table(
            {
                "grp": pa.array([group] * len(rows), pa.string()),
                "level": pa.array([r[0] for r in rows], pa.int32()),
                "ix": pa.array([r[1] for r in rows], pa.int64()),
                "digest": pa.array([r[2] for r in rows], pa.string()),
            }
        )

    return run


def grow(leaves: DataFrame, label: str, arity: int = ARITY, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(grp, level, ix, digest) of all nodes above ``leaves`` (grp, ix, n, digest); the last of a group is its root.

    Each round takes blocks of ``arity ** levels`` neighbours and makes the nodes of ``levels`` more levels, so a
    block is bounded whatever a group holds, and rounds are few. A node joins ``arity`` consecutive ones of the
    level below, the last of a level fewer; a group of one leaf has no node above it.
    """
    width, found = arity**levels, None
    level, below = 0, leaves.select("grp", "ix", "n", "digest", F.lit(0).alias("level"))
    while True:
        blocks = below.where("n > 1").groupBy("grp", F.floor(F.col("ix") / width).alias("block"))
        made = materialize(
            blocks.applyInArrow(_grow(arity, levels), "grp string, level int, ix long, digest string"), label
        )
        found = made if found is None else found.unionByName(made)
        level += levels
        tops = made.where(F.col("level") == level)
        sizes = tops.groupBy("grp").agg((F.max("ix") + 1).alias("n")).where("n > 1")
        if sizes.isEmpty():
            return found
        below = lookup(tops, sizes, ["grp"], "inner").select("grp", "ix", "n", "digest", "level")


# Proofs -------------------------------------------------------------------------------------------------------


def missing(leaves: Iterable[int], n: int, arity: int = ARITY) -> list[tuple[int, int]]:
    """(level, ix) of the fewest nodes that prove ``leaves`` of a tree of ``n`` together: none of them can be
    derived from the leaves or from each other."""
    known, found, level = sorted(set(leaves)), [], 0
    while n > 1:
        have, parents = set(known), sorted({ix // arity for ix in known})
        for parent in parents:
            run = range(parent * arity, min(parent * arity + arity, n))
            found += [(level, ix) for ix in run if ix not in have]
        known, n, level = parents, -(-n // arity), level + 1
    return found


class Paths:
    """Nodes of a tree of ``n`` leaves, those given and those that follow from them."""

    def __init__(self, n: int, given: dict[tuple[int, int], str], arity: int = ARITY):
        self.sizes, self.arity, self.nodes = [n], arity, dict(given)
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // arity))

    def derive(self, leaves: dict[int, str]) -> None:
        """Adds ``leaves`` and, level by level, each node above them."""
        self.nodes.update(((0, ix), digest) for ix, digest in leaves.items())
        known = set(leaves)
        for level in range(len(self.sizes) - 1):
            known = {ix // self.arity for ix in known}
            for ix in known:
                run = self._run(level, ix)
                self.nodes[level + 1, ix] = _digest(self.nodes[level, i] for i in run)

    def _run(self, level: int, parent: int) -> range:
        return range(parent * self.arity, min((parent + 1) * self.arity, self.sizes[level]))

    def siblings(self, leaf: int) -> list[tuple[str, str]]:
        """From the leaf's level up, what stands left and right of its ancestors."""
        found, ix = [], leaf
        for level in range(len(self.sizes) - 1):
            run = self._run(level, ix // self.arity)
            left = "".join(self.nodes[level, i] for i in run if i < ix)
            found.append((left, "".join(self.nodes[level, i] for i in run if i > ix)))
            ix //= self.arity
        return found

    def root(self) -> str:
        return self.nodes[len(self.sizes) - 1, 0]


def fold(digest: str, siblings: Iterable[tuple[str, str]]) -> str:
    """The root that follows from a leaf and its proof."""
    for left, right in siblings:
        digest = _digest((left, digest, right))
    return digest


def _missing_rows(arity: int):
    def run(part: pa.Table) -> pa.Table:
        group, block, n = (part.column(c)[0].as_py() for c in ("grp", "block", "n"))
        found = missing(part.column("ix").to_pylist(), n, arity)
        return pa.table(
            {
                "grp": pa.array([group] * len(found), pa.string()),
                "block": pa.array([block] * len(found), pa.int64()),
                "level": pa.array([level for level, _ in found], pa.int32()),
                "ix": pa.array([ix for _, ix in found], pa.int64()),
            }
        )

    return run


def fetched(leaves: DataFrame, nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """(grp, block, level, ix, digest): the nodes that each block of ``leaves`` (grp, block, ix, n) misses, fetched
    once for all its proofs."""
    rows = leaves.select("grp", "block", "ix", "n").groupBy("grp", "block")
    wanted = rows.applyInArrow(_missing_rows(arity), "grp string, block long, level int, ix long")
    return lookup(wanted, nodes.select("grp", "level", "ix", "digest"), ["grp", "level", "ix"], "inner")


def _given(rows: pa.Table) -> dict[tuple[int, int], str]:
    columns = (rows.column(c).to_pylist() for c in ("level", "ix", "digest"))
    return {(level, ix): digest for level, ix, digest in zip(*columns)}


def _group_proofs(arity: int):
    def run(key, groups: pa.Table, fetched: pa.Table) -> pa.Table:
        """Of each group: its subroot's siblings up to the root, as two lists, and the root."""
        if not groups.num_rows:
            return pa.table({c: pa.array([], t) for c, t in _UPPER})
        paths = Paths(groups.column("n")[0].as_py(), _given(fetched), arity)
        at = groups.column("ix").to_pylist()
        paths.derive(dict(zip(at, groups.column("digest").to_pylist())))
        proofs = [paths.siblings(ix) for ix in at]
        values = [
            groups.column("member").to_pylist(),
            groups.column("digest").to_pylist(),
            [paths.root()] * len(at),
            [[left for left, _ in proof] for proof in proofs],
            [[right for _, right in proof] for proof in proofs],
        ]
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(_UPPER, values)})

    return run


_UPPER = [
    ("grp", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
    ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())),
]


def _proofs(arity: int):
    def run(key, leaves: pa.Table, ways: pa.Table) -> pa.Table:
        names = ["id", "leaf", "subroot", "root", "proof", "folded_root"]
        if not leaves.num_rows:
            return pa.table({c: pa.array([], pa.int64() if c == "id" else pa.string()) for c in names})
        head = ways.filter(ways.column("level").is_null()).slice(0, 1).to_pylist()[0]
        given = ways.filter(ways.column("level").is_valid())
        at, digests = leaves.column("ix").to_pylist(), leaves.column("digest").to_pylist()
        paths = Paths(leaves.column("n")[0].as_py(), _given(given), arity)
        paths.derive(dict(zip(at, digests)))
        upper = list(zip(head["lefts"], head["rights"]))
        top = "".join(left + right for left, right in upper)
        proofs, folded, same = [], [], {}
        for ix, claimed in zip(at, leaves.column("claimed").to_pylist()):
            siblings = paths.siblings(ix)
            proofs.append(_digest((*(left + right for left, right in siblings), top)))
            subroot = fold(claimed, siblings)
            # Leaves that fold to one subroot go on alike.
            if subroot not in same:
                same[subroot] = fold(subroot, upper)
            folded.append(same[subroot])
        ids = leaves.column("id").to_pylist()
        values = [ids, digests, [head["subroot"]] * len(at), [head["root"]] * len(at), proofs, folded]
        return pa.table({c: pa.array(v, pa.int64() if c == "id" else pa.string()) for c, v in zip(names, values)})

    return run


def manifest(leaves: DataFrame, arity: int = ARITY, levels: int = BLOCK_LEVELS) -> dict[str, DataFrame]:
    """Stored tables of the manifest of ``leaves`` (id, grp, digest, ...): numbered leaves, nodes, groups, group nodes.

    ``leaves`` has one row a row of the table, ``grp`` null or text. Leaves ascend by id in each group, nulls first,
    then by digest, and else in any order; groups ascend by the bytes of their name, null first. ``leaves`` come back with ``ix`` and
    ``n``; ``nodes`` are (grp, level, ix, digest) with the leaves as level 0; ``groups`` are (grp, member, ix, n, digest): the
    subroots as leaves of one more tree, whose nodes are ``upper``. Names of groups are marked so that none is null.
    """
    group = F.coalesce(F.concat(F.lit("g"), F.col("grp").cast("string")), F.lit(""))
    # Narrow rows, which are read again to find the ranges: digests are made once.
    marked = materialize(leaves.withColumn("grp", group), "merkle-digests")
    rows = materialize(numbered(marked, ["id", "digest"], "merkle-leaves"), "merkle-leaves")
    inner = grow(rows, "merkle-nodes", arity, levels)
    nodes = rows.select("grp", F.lit(0).alias("level"), "ix", "digest").unionByName(inner)
    tops = nodes.groupBy("grp").agg(F.max_by("digest", "level").alias("digest"))
    members = tops.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    groups = materialize(numbered(members, ["member"], "merkle-groups"), "merkle-groups")
    upper = grow(groups, "merkle-upper", arity, levels)
    upper = groups.select("grp", F.lit(0).alias("level"), "ix", "digest").unionByName(upper)
    return {"leaves": rows, "nodes": nodes, "groups": groups, "upper": upper}


def prove(
    tables: dict[str, DataFrame], wanted: DataFrame | None = None, arity: int = ARITY, levels: int = BLOCK_LEVELS
) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root) of the leaves ``wanted`` of a manifest, all by default.

    ``wanted`` are rows of its leaves with a column ``claimed``, the digest that is to be proved. A partition is a
    block of ``arity ** levels`` neighbours of one group. It lists the coordinates of the fewest nodes that its leaves
    miss together, which are fetched once; it derives the nodes that its proofs share and expands each
    proof for itself. ``proof`` is the SHA-256 of the siblings from the leaf to the root, left to right;
    ``folded_root`` is the claimed digest folded with them. Subroots are proved in the tree over the groups in the
    same way. No leaves: no rows.
    """
    width = arity**levels
    blocked = lambda rows: rows.withColumn("block", F.floor(F.col("ix") / width))
    groups = blocked(tables["groups"])
    above = (
        groups.groupBy("grp", "block")
        .cogroup(fetched(groups, tables["upper"], arity).groupBy("grp", "block"))
        .applyInArrow(_group_proofs(arity), "grp string, subroot string, root string, lefts array<string>, rights array<string>")
    )
    above = materialize(above, "merkle-proofs")
    wanted = tables["leaves"] if wanted is None else wanted
    leaves = blocked(wanted.select("id", "grp", "ix", "n", "digest", "claimed"))
    # What a block needs beside its leaves: one row of its group's way to the root, and the fetched nodes.
    heads = lookup(leaves.select("grp", "block").distinct(), above, ["grp"], "inner")
    ways = fetched(leaves, tables["nodes"], arity).unionByName(heads, allowMissingColumns=True)
    return (
        leaves.groupBy("grp", "block")
        .cogroup(ways.groupBy("grp", "block"))
        .applyInArrow(
            _proofs(arity), "id long, leaf string, subroot string, root string, proof string, folded_root string"
        )
    )
