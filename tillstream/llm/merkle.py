"""A Merkle manifest of a data set: a tree for each source, and one over the sources.

A parent's digest is that of its children's digests as text, sixteen at most.
Parents keep a copy of their hash state before each child slot (``midstates``).
To fold a changed leaf up the tree, the state before its slot is resumed with
the replacement and the siblings to its right; those to the left are not read.

Trees are built in blocks of 4,096 nodes, three levels at a time, so a task
holds one block whatever a source's share of the rows. The tops of the blocks
are the nodes of the next step. On the way down every block gets the path above
it: for each level the state before its slot and the siblings.

Leaves ascend by doc_id, nulls first, then by their digests. Equal rows are
equal leaves; they are numbered as a run, so no number of them meets in one task.
Null fields are written ``-``. A null source is a source of its own, before all
others. A row without a doc_id is never tampered with. An empty table gives no
rows. Texts of any length are hashed where they lie; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillstream.llm import midstates
from tillstream.llm.collocations import LOWER, UPPER
from tillstream.llm.common import materialize, task_count

FANOUT = 16
LEVELS = 3
BLOCK = FANOUT**LEVELS
#: Rows of (source, doc_id, leaf) that a task numbers.
TASK_ROWS = 400_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<state: binary, slot: int, siblings: binary>>"
NODES = ("group", "block", "at", "total", "digest")
TOPS = "group string, place bigint, total bigint, digest binary"
PATHS = f"group string, block bigint, path {PATH}"


def field(value: Column) -> Column:
    text = value.cast("string")
    counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(counted, F.lit("-"))


def leaf(text: Column) -> Column:
    """SHA-256 of a row, as bytes; ``text`` stands for its text."""
    values = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*[field(value) for value in values]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """group, doc_id, leaf and tampered (null: as the leaf)."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    source = F.col("source").cast("string")
    return docs.select(
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)).alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(F.col("text")).alias("leaf"),
        F.when(hit, leaf(F.translate(F.col("text").cast("string"), UPPER, LOWER))).alias(
            "tampered"
        ),
    )


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (group, copies and more) by ``order`` as nodes: block, at, total.

    A row stands for ``copies`` equal nodes in a row.
    """
    parts = task_count(rows.count(), TASK_ROWS)
    dealt = materialize(
        rows.repartitionByRange(parts, "group", *[F.asc_nulls_first(name) for name in order])
        .withColumn("part", F.spark_partition_id())
    )
    counts = dealt.groupBy("group", "part").agg(F.sum("copies").alias("nodes"))
    groups = Window.partitionBy("group")
    before = groups.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "group",
        "part",
        F.coalesce(F.sum("nodes").over(before), F.lit(0)).alias("before"),
        F.sum("nodes").over(groups).alias("total"),
    )
    within = (
        Window.partitionBy("group", "part")
        .orderBy(*[F.asc_nulls_first(name) for name in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("before") + F.coalesce(F.sum("copies").over(within), F.lit(0))
    runs = dealt.join(starts, ["group", "part"]).withColumn("first", first)
    last, block = F.col("first") + F.col("copies") - 1, F.col("block")
    # a run is cut at the blocks before its nodes are spread out
    cut = runs.withColumn("last", last).withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK))),
    )
    inside = F.sequence(
        F.greatest(F.col("first"), block * BLOCK), F.least(F.col("last"), (block + 1) * BLOCK - 1)
    )
    nodes = cut.withColumn("place", F.explode(inside))
    return nodes.withColumn("at", (F.col("place") - block * BLOCK).cast("int")).drop(
        "part", "before", "first", "last", "place", "copies"
    )


class Forest:
    """Blocks of consecutive nodes, the levels above each, and the states kept there.

    ``first`` has the place of each block's first node, and the number of nodes.
    A block of a larger group goes up all its levels, a lone last node too.
    """

    def __init__(self, digests: np.ndarray, first: np.ndarray, totals: np.ndarray):
        self.digests, self.first, self.levels = [digests], [first], []
        for _ in range(LEVELS):
            self._climb(totals > 1)
            totals = -(-totals // FANOUT)

    def _climb(self, active: np.ndarray) -> None:
        first, own = self.first[-1], self.digests[-1]
        counts = np.diff(first)
        above = np.where(active, -(-counts // FANOUT), counts)
        new_first = np.concatenate([[0], np.cumsum(above)])
        of = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(own)) - first[of]
        moves = active[of]
        slot = np.where(moves, at % FANOUT, 0)
        parent = new_first[of] + np.where(moves, at // FANOUT, at)
        end = np.minimum(np.arange(len(own)) - slot + FANOUT, first[of + 1])
        kept, states = np.zeros((len(own), 8), np.uint32), midstates.start(new_first[-1])
        blocks = midstates.hex_blocks(own)
        for step in range(FANOUT):
            children = np.flatnonzero(moves & (slot == step))
            if not len(children):
                break
            runs = parent[children]
            kept[children] = states[runs]
            states[runs] = midstates.update(states[runs], blocks[children])
        digests = np.empty((new_first[-1], 32), np.uint8)
        digests[parent[~moves]] = own[~moves]
        heads = np.flatnonzero(moves & (slot == 0))
        if len(heads):
            digests[parent[heads]] = midstates.finish(states[parent[heads]], end[heads] - heads)
        self.levels.append((moves, slot, parent, end, kept, blocks))
        self.digests.append(digests)
        self.first.append(new_first)

    @property
    def tops(self) -> np.ndarray:
        """One digest for each block."""
        return self.digests[-1]

    def paths(self) -> list[list[dict]]:
        """For each node: state before its slot, slot and siblings, level by level."""
        found = []
        for index in range(len(self.digests[0])):
            path = []
            for own, (moves, slot, parent, end, kept, _) in zip(
                self.digests, self.levels, strict=False
            ):
                if moves[index]:
                    near = own[index - slot[index] : end[index]]
                    rest = np.delete(near, slot[index], axis=0).tobytes()
                    state = kept[index].tobytes()
                    path.append({"state": state, "slot": int(slot[index]), "siblings": rest})
                index = parent[index]
            found.append(path)
        return found

    def fold(self, changed: np.ndarray) -> np.ndarray:
        """The top of its block for each node, with the node's digest in ``changed`` instead."""
        index, now = np.arange(len(changed)), changed.copy()
        for moves, slot, parent, end, kept, blocks in self.levels:
            lanes = np.flatnonzero(moves[index])
            here = index[lanes]
            if len(lanes):
                states = midstates.update(kept[here], midstates.hex_blocks(now[lanes]))
                for step in range(1, FANOUT):
                    rows = np.flatnonzero(here + step < end[here])
                    if not len(rows):
                        break
                    states[rows] = midstates.update(states[rows], blocks[here[rows] + step])
                now[lanes] = midstates.finish(states, end[here] - here + slot[here])
            index = parent[index]
        return now

    def proofs(self, above: list[bytes]) -> list[str]:
        """Digest of each node's siblings, those of its ancestors, and its block's ``above``."""
        shared = above
        for own, (moves, slot, parent, end, _, _) in zip(
            self.digests[-2::-1], self.levels[::-1], strict=True
        ):
            text = own.tobytes().hex().encode()
            shared = [
                text[64 * (k - slot[k]) : 64 * k] + text[64 * (k + 1) : 64 * end[k]] + shared[parent[k]]
                if moves[k]
                else shared[parent[k]]
                for k in range(len(own))
            ]
        return [hashlib.sha256(siblings).hexdigest() for siblings in shared]


def resume(paths: list[list[dict]], changed: np.ndarray) -> np.ndarray:
    """The root for each digest in ``changed``, up its path of states and siblings."""
    now = changed.copy()
    for level in range(max(map(len, paths), default=0)):
        lanes = np.array([k for k, path in enumerate(paths) if len(path) > level])
        steps = [paths[k][level] for k in lanes]
        kept = np.array([np.frombuffer(step["state"], np.uint32) for step in steps])
        rights = [step["siblings"][32 * step["slot"] :] for step in steps]
        counts = np.array([len(right) // 32 for right in rights])
        padded = b"".join(right.ljust(32 * FANOUT, b"\0") for right in rights)
        blocks = np.frombuffer(padded, np.uint8).reshape(len(steps), FANOUT, 32)
        states = midstates.update(kept, midstates.hex_blocks(now[lanes]))
        for step in range(counts.max()):
            rows = np.flatnonzero(counts > step)
            states[rows] = midstates.update(
                states[rows], midstates.hex_blocks(blocks[rows, step])
            )
        sizes = np.array([len(step["siblings"]) // 32 + 1 for step in steps])
        now[lanes] = midstates.finish(states, sizes)
    return now


#: Nodes that a task works on together.
TOGETHER = 2 * BLOCK


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole blocks from rows in the order of group and block."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < TOGETHER:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = _block_starts(table)
        if starts[-1]:
            yield table.slice(0, starts[-1])
        held = table.slice(starts[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if len(table):
            yield table


def _block_starts(table: pa.Table) -> np.ndarray:
    group, block = table["group"], table["block"]
    new = pc.or_(
        pc.not_equal(group.slice(1), group.slice(0, len(group) - 1)),
        pc.not_equal(block.slice(1), block.slice(0, len(block) - 1)),
    )
    return np.concatenate([[0], np.flatnonzero(new.to_numpy()) + 1])


def _forest(nodes: pa.Table) -> Forest:
    starts = _block_starts(nodes)
    digests = np.frombuffer(b"".join(nodes["digest"].to_pylist()), np.uint8).reshape(-1, 32)
    totals = nodes["total"].to_numpy()[starts]
    return Forest(digests, np.append(starts, len(nodes)), totals)


def _in_blocks(nodes: DataFrame, function, schema: str, extra: DataFrame | None = None) -> DataFrame:
    """``function`` of every few whole blocks; a row of ``extra`` heads its block."""
    rows = nodes
    if extra is not None:
        rows = nodes.unionByName(
            extra.withColumn("at", F.lit(-1)), allowMissingColumns=True
        )
    dealt = rows.repartition("group", "block").sortWithinPartitions("group", "block", "at")
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for table in _whole_blocks(batches):
            yield from pa.table(function(table), schema=out).to_batches()

    return dealt.mapInArrow(run, schema)


def _tops(nodes: pa.Table) -> list:
    heads = nodes.take(_block_starts(nodes))
    totals = [-(-total // BLOCK) for total in heads["total"].to_pylist()]
    tops = [top.tobytes() for top in _forest(nodes).tops]
    return [heads["group"], heads["block"], totals, tops]


def _split(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Nodes, and the extra row of each block."""
    is_node = pc.greater_equal(table["at"], 0)
    return table.filter(is_node).combine_chunks(), table.filter(pc.invert(is_node))


def _node_paths(table: pa.Table) -> list:
    """The path above every node of the blocks, themselves below paths of their own."""
    nodes, heads = _split(table)
    forest, above = _forest(nodes), heads["path"].to_pylist()
    of = np.repeat(np.arange(len(above)), np.diff(forest.first[0]))
    places = pc.add(pc.multiply(nodes["block"], BLOCK), pc.cast(nodes["at"], pa.int64()))
    paths = [own + above[k] for own, k in zip(forest.paths(), of, strict=True)]
    return [nodes["group"], places, paths]


def climb(base: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The written nodes of every step from ``base`` up, and each group's top digest."""
    steps, tops = [base], []
    largest = base.agg(F.max("total")).first()[0] or 0
    while True:
        found = materialize(_in_blocks(steps[-1].select(*NODES), _tops, TOPS))
        tops.append(found.where("total = 1").select("group", "digest"))
        largest = -(-largest // BLOCK)
        if largest <= 1:
            break
        place = F.col("place")
        steps.append(
            found.where("total > 1").select(
                "group",
                F.floor(place / BLOCK).alias("block"),
                (place % BLOCK).cast("int").alias("at"),
                "total",
                "digest",
            )
        )
    all_tops = tops[0]
    for more in tops[1:]:
        all_tops = all_tops.unionByName(more)
    return steps, all_tops


def descend(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """(group, block, path) for the blocks of the lowest step.

    ``above`` has the path over the top of every group.
    """
    paths = None
    for k in range(len(steps) - 1, -1, -1):
        # a group has its top here if one block holds all of it
        small = steps[k].where((F.col("total") <= BLOCK) & (F.col("at") == 0)).select("group")
        own = above.join(small, "group").select("group", F.lit(0).cast("long").alias("block"), "path")
        paths = own if paths is None else own.unionByName(paths)
        if k:
            paths = materialize(_in_blocks(steps[k].select(*NODES), _node_paths, PATHS, paths))
    return paths


RESULT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def _proved(root: bytes):
    def prove(table: pa.Table) -> list:
        nodes, heads = _split(table)
        forest, paths = _forest(nodes), heads["path"].to_pylist()
        of = np.repeat(np.arange(len(paths)), np.diff(forest.first[0]))
        kept = nodes["digest"].to_pylist()
        changed = [new or own for new, own in zip(nodes["tampered"].to_pylist(), kept, strict=True)]
        tops = forest.fold(np.frombuffer(b"".join(changed), np.uint8).reshape(-1, 32))
        # most leaves are unchanged and share one way up from their block's top
        ways, which = np.unique(
            np.hstack([of[:, None].astype(">i8").view(np.uint8), tops]), axis=0, return_inverse=True
        )
        blocks = ways[:, :8].copy().view(">i8")[:, 0]
        folded = resume([paths[k] for k in blocks], np.ascontiguousarray(ways[:, 8:]))
        folded = [own.tobytes() for own in folded]
        folded = [folded[k] for k in which.reshape(-1)]
        siblings = [b"".join(step["siblings"] for step in path).hex().encode() for path in paths]
        subroots = [own.hex() for own in heads["subroot"].to_pylist()]
        return [
            nodes["doc_id"],
            [own.hex() for own in kept],
            [subroots[k] for k in of],
            [root.hex()] * len(kept),
            forest.proofs(siblings),
            [own.hex() for own in folded],
            [own == root for own in folded],
        ]

    return prove


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and the root folded from the tampered leaf, for every row."""
    rows = leaves(docs).groupBy("group", "doc_id", "leaf", "tampered")
    rows = rows.agg(F.count(F.lit(1)).alias("copies"))
    base = materialize(
        numbered(rows, ["doc_id", "leaf"]).withColumnRenamed("leaf", "digest")
    )
    steps, subroots = climb(base)
    subroots = materialize(subroots)

    sources = subroots.select(
        F.lit("").alias("group"),
        F.col("group").alias("source"),
        "digest",
        F.lit(1).cast("long").alias("copies"),
    )
    root_base = materialize(numbered(sources, ["source"]))
    root_steps, roots = climb(root_base)
    roots = materialize(roots)
    found = roots.first()
    root = bytes(found["digest"]) if found else b""
    nothing = F.array().cast(PATH)
    top_path = roots.select("group", nothing.alias("path"))
    over_sources = descend(root_steps, top_path)
    source_paths = _in_blocks(
        root_base.select(*NODES), _node_paths, PATHS, over_sources
    ).withColumnRenamed("block", "place")
    named = root_base.select(
        "source", (F.col("block") * BLOCK + F.col("at")).alias("place")
    ).join(source_paths, "place")
    above = materialize(named.select(F.col("source").alias("group"), "path"))

    paths = descend(steps, above).join(
        subroots.select("group", F.col("digest").alias("subroot")), "group"
    )
    return _in_blocks(base.select(*NODES, "doc_id", "tampered"), _proved(root), RESULT, paths)
