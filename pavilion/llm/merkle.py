"""A Merkle tree over the rows of a dataset, a subtree for each group, by time-forward processing.

Nodes are worked on in the order of their labels (level, place); a node's digest is handed forward to its
parent through a priority queue ordered by label. Over the whole dataset Spark's sort is that queue: rows
are dealt to blocks of ``arity ** block_levels`` neighbours, a task takes a block in label order with a queue
of its own, and the blocks' roots are the rows of the next layer, until a group has one node left.
A sweep the other way, from the root's label down, hands every node its proof: a layer's proofs
are the messages that its blocks' rows meet in the layer below. No task holds more than a block,
whatever the size of a group, and layers shrink by the block's size.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pavilion.operators.rank import global_rank
from pavilion.session import materialize, new_folder

_NODE = "__group string, __place bigint, __digest string"
_PROOF = "array<struct<before: string, after: string>>"


def row_digest(columns: Sequence[str]) -> Column:
    """Hex SHA-256 of the columns' values: ``-`` for a null, else UTF-8 byte count, ``:``, value."""

    def field(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


def node_digest(children: str) -> str:
    return hashlib.sha256(children.encode()).hexdigest()


def forward(digests: Sequence[str], arity: int, levels: int, alone: bool) -> list[list[str]]:
    """Digests of all nodes of a block by level, taken in the order of their labels.

    A block rises ``levels`` levels; one that is ``alone`` in its group stops at a single node.
    """
    sizes = [len(digests)]
    while len(sizes) <= levels and not (alone and sizes[-1] == 1):
        sizes.append(-(-sizes[-1] // arity))
    tree: list[list[str]] = [[] for _ in sizes]
    queue = [(0, i, 0, d) for i, d in enumerate(digests)]  # in order, so a heap already
    while queue:
        level, place, _, digest = heapq.heappop(queue)
        children = [digest]
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        own = node_digest("".join(children)) if level else digest
        tree[level].append(own)
        if level + 1 < len(sizes):
            heapq.heappush(queue, (level + 1, place // arity, place % arity, own))
    return tree


def backward(tree: Sequence[Sequence[str]], arity: int, above: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """The proof of every row of a block, from the root's proof ``above`` down in reversed order of labels.

    A step holds the digests before and after the node among its parent's children.
    """
    out: list[list[tuple[str, str]]] = [above] * len(tree[0])
    queue = [(1 - len(tree), 0, above)]
    while queue:
        level, place, proof = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            out[place] = proof
            continue
        first = place * arity
        children = tree[level - 1][first : first + arity]
        for i in range(len(children)):
            step = ("".join(children[:i]), "".join(children[i + 1 :]))
            heapq.heappush(queue, (1 - level, -(first + i), [step, *proof]))
    return out


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """The sorted rows as tables that end where a block ends, with the row ranges of their blocks."""
    left: pa.Table | None = None

    def ranges(rows: pa.Table) -> list[tuple[int, int]]:
        keys = list(zip(rows.column("__group").to_pylist(), rows.column("__block").to_pylist(), strict=True))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        return list(zip(cuts, cuts[1:], strict=False)) if keys else []

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows])
        found = ranges(rows)
        if len(found) > 1:
            last = found[-1][0]
            yield rows.slice(0, last).combine_chunks(), found[:-1]
            rows = rows.slice(last)
        left = rows.combine_chunks()
    if left is not None and left.num_rows:
        yield left, ranges(left)


def _riser(arity: int, levels: int):
    def rise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, blocks in _whole_blocks(batches):
            digests = rows.column("__digest").to_pylist()
            first = [a for a, _ in blocks]
            block = rows.column("__block").take(pa.array(first)).to_pylist()
            roots = [forward(digests[a:z], arity, levels, b == 0)[-1][0] for (a, z), b in zip(blocks, block, strict=True)]
            group = rows.column("__group").take(pa.array(first)).combine_chunks()
            group = group.chunk(0) if isinstance(group, pa.ChunkedArray) else group
            yield pa.RecordBatch.from_arrays(
                [group, pa.array(block, pa.int64()), pa.array(roots, pa.string())], ["__group", "__place", "__digest"]
            )

    return rise


def _faller(arity: int, levels: int, carried: str):
    def fall(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, blocks in _whole_blocks(batches):
            digests = rows.column("__digest").to_pylist()
            block = rows.column("__block").to_pylist()
            above = rows.column("__proof")
            nodes, before, after, bounds, subroots = [], [], [], [0], []
            for a, z in blocks:
                # The message from above comes first, then the block's rows.
                root = [(s["before"], s["after"]) for s in above[a].as_py()]
                subroot = rows.column("__subroot")[a].as_py()
                tree = forward(digests[a + 1 : z], arity, levels, block[a] == 0)
                for i, proof in enumerate(backward(tree, arity, root)):
                    nodes.append(a + 1 + i)
                    subroots.append(subroot)
                    before += [s[0] for s in proof]
                    after += [s[1] for s in proof]
                    bounds.append(len(before))
            steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
            kept = rows.select(["__group", "__place", "__digest", carried]).take(pa.array(nodes, pa.int64())).combine_chunks()
            columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in kept.columns]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(subroots, pa.string()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), steps)],
                [*kept.column_names, "__subroot", "__proof"],
            )

    return fall


class _Forest:
    """Trees over ``nodes`` (__group, __place from 0, __digest, and a struct __row), one for each group."""

    def __init__(self, nodes: DataFrame, arity: int, block_levels: int, folder: str) -> None:
        self.arity, self.levels, self.folder = arity, block_levels, folder
        self.layers = [nodes]
        while len(self.layers) == 1 or not self.layers[-1].where("__place > 0").isEmpty():
            self.layers.append(self._rise(self.layers[-1]))

    @property
    def roots(self) -> DataFrame:
        return self.layers[-1]

    def _dealt(self, rows: DataFrame, *order: str) -> DataFrame:
        return rows.repartition("__group", "__block").sortWithinPartitions("__group", "__block", *order)

    def _blocked(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("__block", F.expr(f"__place div {self.arity ** self.levels}L"))

    def _rise(self, nodes: DataFrame) -> DataFrame:
        narrow = self._blocked(nodes.select("__group", "__place", "__digest"))
        made = self._dealt(narrow, "__place").mapInArrow(_riser(self.arity, self.levels), _NODE)
        return materialize(made, "layer", self.folder)

    def proofs(self, above: DataFrame) -> DataFrame:
        """The first layer's rows with __proof and __subroot, from those of the groups' roots (__group, __subroot, __proof)."""
        messages = above.select("__group", F.lit(0).cast("bigint").alias("__place"), "__subroot", "__proof")
        for number, nodes in reversed(list(enumerate(self.layers[:-1]))):
            row = F.col("__row") if number == 0 else F.struct(F.lit(0).alias("none"))
            rows = self._blocked(nodes).select("__group", "__block", F.lit(1).alias("__kind"), "__place", "__digest", row.alias("__row"))
            sent = messages.select("__group", F.col("__place").alias("__block"), F.lit(0).alias("__kind"), "__subroot", "__proof")
            both = self._dealt(rows.unionByName(sent, allowMissingColumns=True), "__kind", "__place")
            kind = rows.schema["__row"].dataType.simpleString()
            made = both.mapInArrow(
                _faller(self.arity, self.levels, "__row"), f"{_NODE}, __row {kind}, __subroot string, __proof {_PROOF}"
            )
            messages = made if number == 0 else materialize(made.drop("__row"), "messages", self.folder)
        return messages


def merkle_proofs(
    leaves: DataFrame, group: Column, order: Sequence[Column], leaf_col: str = "leaf", arity: int = 3, block_levels: int = 6
) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``proof``, one row for each.

    A group's leaves, in ``order``, are the first level of its tree; every ``arity`` consecutive nodes become the SHA-256 of their
    digests (hex text, concatenated), the last run being shorter, until one node is left, the subroot. Subroots
    in order of their groups (null first, then UTF-8 bytewise) become the root in the same way. ``proof`` has a step
    for every level, subroots' levels included: the digests before and after the own one in its run; see
    ``fold_proof``. ``order`` ends in the leaf's digest by itself, so rows that tie in all of it are equal leaves. A lone
    leaf is its group's subroot, with no steps of its own; an empty table stays empty. Groups may have any
    size. ``leaf_col`` must not be null. Columns named subroot, root and proof are replaced.
    """
    spark = leaves.sparkSession
    folder = new_folder(spark, "merkle")
    rows = leaves.drop("subroot", "root", "proof")
    named = rows.select(group.cast("string").alias("__group"), F.col(leaf_col).alias("__digest"), F.struct(*rows.columns).alias("__row"), *[c.alias(f"__order_{i}") for i, c in enumerate(order)])
    keys = [F.col(f"__order_{i}").asc_nulls_first() for i in range(len(order))]
    ranked = global_rank(named, F.col("__group").asc_nulls_first(), *keys, F.col("__digest"), name="__rank", folder=folder)
    starts = ranked.groupBy(F.col("__group").alias("__of")).agg(F.min("__rank").alias("__first"))
    placed = ranked.join(starts, F.col("__group").eqNullSafe(F.col("__of")))
    nodes = placed.select("__group", (F.col("__rank") - F.col("__first")).alias("__place"), "__digest", "__row")
    forest = _Forest(materialize(nodes, "leaves", folder), arity, block_levels, folder)
    names = F.struct(F.col("__group").alias("name")).alias("__row")
    ordered = global_rank(forest.roots, F.col("__group").asc_nulls_first(), name="__rank", folder=folder)
    tops = ordered.select(F.lit("").alias("__group"), (F.col("__rank") - 1).alias("__place"), "__digest", names)
    top = _Forest(materialize(tops, "subroots", folder), arity, block_levels, folder)
    root = top.roots.first()  # a single row
    if root is None:
        return rows.withColumns({"subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string"), "proof": F.lit(None).cast(_PROOF)})
    whole = F.array().cast(_PROOF)
    subtrees = top.proofs(top.roots.select("__group", F.col("__digest").alias("__subroot"), whole.alias("__proof")))
    above = subtrees.select(F.col("__row.name").alias("__group"), F.col("__digest").alias("__subroot"), "__proof")
    made = forest.proofs(materialize(above, "groups", folder))
    return made.select("__row.*", F.col("__subroot").alias("subroot"), F.lit(root["__digest"]).alias("root"), F.col("__proof").alias("proof"))


def fold_proof(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(proof, digest, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """Hex SHA-256 of all digests of a proof, level by level, each from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def tampered_digests(docs: DataFrame, columns: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``leaf`` and ``tampered``, the digests of the row as it is and without the line feeds of its text.

    Only rows where 2 divides the unsigned crc32 of the id's decimal form are tampered with; a null id or
    text leaves the row as it is.
    """
    chosen = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    docs = docs.withColumn("leaf", row_digest(columns))
    changed = docs.withColumn(text_col, F.when(chosen, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col)))
    return changed.withColumn("tampered", F.when(chosen & F.col(text_col).isNotNull(), row_digest(columns)).otherwise(F.col("leaf")))
