"""The trie of conversation prefixes: which conversations share their first turns, and how many tokens that spares.

Conversations are rebuilt first: conversation c takes the first h turns of conversation c - c % 100 and its own turns
after its first h. Turns get their numbers in their conversation from one global sort of narrow rows (keys, a digest of
role and text, a length), so that a conversation that holds a third of all turns is spread over tasks. A prefix is named by its
depth and the exclusive or of its turns' 64-bit hashes, two of them, each over the turn's place and SHA-256 digest; that is a
prefix sum, taken within blocks of a fixed number of turns and over the blocks, and undone by one turn it names the parent.

Digests are screened by a count-min sketch of three rows. Its cells count to two, which is all the screening asks:
where one of a digest's cells holds one, the prefix belongs to a single conversation, and so do all prefixes that go on
from it. The nodes of such tails are written where they are, without a shuffle. Only the other prefixes, which may be shared,
are grouped, and grouping settles which are. The sketch has four cells per prefix and row up to `most_cells`; what it then
screens out less goes through the exact grouping, so results do not depend on its size.

Subtree sums need no walk over the levels. In a conversation, the nodes of which it is the smallest member are those from some
depth on, as members only become fewer. So each node has one such conversation, and sums over the distinct nodes of a subtree
are sums over its members of what lies from that depth on: a number per conversation, joined to its prefixes and added up.

Lists of conversations that end at a node are written in order in pieces by a range sort; only pieces meet in one place, where
their digest is taken piece by piece.

Defined results: turns are ordered by turn (NULL first), then role, then the digest of role and text; turns equal in all of
these are turns of their own. NULL roles and texts are empty. Rows without conv_id belong to no conversation and are left
out. Conversations without turns after rebuilding end at the root. An empty table gives no nodes, not even a root. Texts of any
length count by their code points. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.numbering import global_row_number
from tidemark.workspace import materialise

SHARED_HEAD = 6
FAMILY = 100
BLOCK_TURNS = 4096
SKETCH_ROWS = 3
CELL_BLOCK = 1 << 16
MOST_CELLS = 1 << 24
PIECE_IDS = 1 << 16
NODE = ["depth", "a", "b"]
NO_ENDS = hashlib.sha256(b"").hexdigest()
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, number (over all turns, in order), digest and chars of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    numbered = global_row_number(turns, ["conv_id", "turn", "role", "digest"], "number")
    return numbered.select("conv_id", "number", "digest", "chars")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """conv_id, depth, turns (how many the conversation has), digest and chars; depth 0 has no digest."""
    own = turns.groupBy("conv_id").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("own"))
    own = materialise(own, "conversations")
    base = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % SHARED_HEAD).join(base, "base", "left")
    head = F.least("h", F.coalesce("base_own", F.lit(0)))
    convs = convs.withColumn("head", head).withColumn("turns", head + F.greatest(F.col("own") - F.col("h"), F.lit(0)))

    place = F.col("number") - F.col("first") + 1
    of_own = turns.join(convs.select("conv_id", "first", "h", "head", "turns"), "conv_id").where(place > F.col("h"))
    of_own = of_own.select("conv_id", (F.col("head") + place - F.col("h")).alias("depth"), "turns", "digest", "chars")
    heads = turns.where(F.col("conv_id") % FAMILY == 0).join(own, "conv_id").where(place < SHARED_HEAD)
    heads = heads.select(F.col("conv_id").alias("base"), place.alias("depth"), "digest", "chars")
    of_base = convs.where(F.col("h") > 0).join(heads, "base").where(F.col("depth") <= F.col("h"))
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), "turns",
                         F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return roots.unionByName(of_base.select(*roots.columns)).unionByName(of_own)


def prefixes(turns: DataFrame) -> DataFrame:
    """Every conversation's prefixes: digest a, b; that of the parent; chars of the turns before the last one."""
    block = F.floor(F.col("depth") / BLOCK_TURNS)
    hashed = turns.select(
        "conv_id", "depth", "turns", "chars", block.alias("block"),
        F.coalesce(F.when(F.col("digest").isNotNull(), F.xxhash64("depth", "digest")), F.lit(0)).alias("term_a"),
        F.coalesce(F.when(F.col("digest").isNotNull(), F.xxhash64(F.lit("b"), "digest", "depth")), F.lit(0)).alias("term_b"))
    sums = [F.bit_xor("term_a"), F.bit_xor("term_b"), F.sum("chars")]
    blocks = hashed.where(F.col("turns") >= BLOCK_TURNS).groupBy("conv_id", "block").agg(
        *[s.alias(n) for s, n in zip(sums, ("all_a", "all_b", "all_chars"))])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[
        F.coalesce(f(c).over(before), F.lit(0)).alias(f"before_{c[4:]}")
        for f, c in ((F.bit_xor, "all_a"), (F.bit_xor, "all_b"), (F.sum, "all_chars"))])
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("conv_id", "block", "depth", "turns", "chars", "term_a", "term_b", *[
        s.over(within).alias(n) for s, n in zip(sums, ("run_a", "run_b", "run_chars"))])
    joined = running.join(blocks, ["conv_id", "block"], "left")
    earlier = lambda c: F.coalesce(F.col(f"before_{c}"), F.lit(0))
    named = joined.select(
        "conv_id", "depth", "turns", "chars", "term_a", "term_b",
        F.col("run_a").bitwiseXOR(earlier("a")).alias("a"), F.col("run_b").bitwiseXOR(earlier("b")).alias("b"),
        (F.col("run_chars") + earlier("chars") - F.col("chars")).alias("chars_before"))
    return named.select(
        "conv_id", "depth", "turns", "chars", "chars_before", "a", "b",
        F.col("a").bitwiseXOR(F.col("term_a")).alias("parent_a"), F.col("b").bitwiseXOR(F.col("term_b")).alias("parent_b"))


def _cells(a: np.ndarray, width: int) -> list[np.ndarray]:
    """A digest's cell in every row of the sketch, as numbers over all rows."""
    with np.errstate(over="ignore"):
        mixed = [a.view(np.uint64) * np.uint64(odd) for odd in _ODD[:SKETCH_ROWS]]
    return [((m >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64) + row * width for row, m in enumerate(mixed)]


class Sketch:
    """Count-min sketch whose cells count none, one, or more. Kept: a bit per cell that holds more than one."""

    def __init__(self, width: int, many: np.ndarray):
        self.width, self.many = width, many

    def single(self, a: np.ndarray) -> np.ndarray:
        """True where a digest that was counted has the estimate one."""
        found = np.zeros(len(a), bool)
        for cell in _cells(a, self.width):
            found |= self.many[cell >> 3] >> (cell & 7).astype(np.uint8) & 1 == 0
        return found


def sketch(rows: DataFrame, most_cells: int = MOST_CELLS) -> Sketch:
    """The sketch of the digests `a`. A task sends the cells it met, two bytes each (twice if met again), block by block;
    blocks are merged in parallel, each from a stream. What comes to the driver is a bit per cell."""
    width = CELL_BLOCK
    n = rows.count()
    while width < min(4 * n, most_cells):
        width *= 2
    blocks = SKETCH_ROWS * width // CELL_BLOCK

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(SKETCH_ROWS * width, np.uint8)
        for batch in batches:
            for cell in _cells(batch.column("a").to_numpy(), width):
                again = np.bincount(cell - cell.min()) if len(cell) else np.empty(0, int)
                some = np.flatnonzero(again)
                at = some + (cell.min() if len(cell) else 0)
                met[at] = np.minimum(met[at] + np.minimum(again[some], 2), 2)
        for block in range(blocks):
            part = met[block * CELL_BLOCK : (block + 1) * CELL_BLOCK]
            cells = np.concatenate([np.flatnonzero(part), np.flatnonzero(part > 1)]).astype("<u2")
            if len(cells):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([cells.tobytes()])], names=["block", "cells"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELL_BLOCK, np.uint8)
        for batch in batches:
            for cells in batch.column("cells"):
                met = np.bincount(np.frombuffer(cells.as_py(), "<u2"), minlength=CELL_BLOCK)
                total = np.minimum(total + met, 2).astype(np.uint8)
        bits = np.packbits(total > 1, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits])], names=["block", "bits"])

    merged = rows.select("a").mapInArrow(partial, "block int, cells binary").groupBy("block").applyInArrow(merge, "block int, bits binary")
    many = np.zeros(SKETCH_ROWS * width // 8, np.uint8)
    for block, bits in merged.collect():
        many[block * CELL_BLOCK // 8 : (block + 1) * CELL_BLOCK // 8] = np.frombuffer(bits, np.uint8)
    return Sketch(width, many)


def screen(rows: DataFrame, found: Sketch) -> DataFrame:
    """`rows` with `alone` and `parent_alone`: the sketch proves that one conversation alone has the prefix, or its parent."""
    shared = rows.sparkSession.sparkContext.broadcast((found.width, found.many))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Sketch(*shared.value)
        for batch in batches:
            flags = [pa.array(known.single(batch.column(c).to_numpy())) for c in ("a", "parent_a")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], names=[*batch.schema.names, "alone", "parent_alone"])

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, alone boolean, parent_alone boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the conversations' numbers, in order and joined by commas, for every node in `ends` (node and conv_id)."""
    kinds = "depth long, a long, b long"

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one node's conversations as text, a bounded number each."""
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in NODE]
            ids = batch.column("conv_id").to_pylist()
            turns = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if len(ids) else []
            starts = [0, *[int(t) for t in turns]] if len(ids) else []
            out = []
            for at, upto in zip(starts, [*starts[1:], len(ids)]):
                for piece in range(at, upto, PIECE_IDS):
                    text = ",".join(map(str, ids[piece : min(piece + PIECE_IDS, upto)]))
                    out.append((*[int(c[at]) for c in columns], ids[piece], text))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), [*[pa.int64()] * 4, pa.string()])], names=[*NODE, "first", "ids"])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces come node by node and in order, so one running digest is enough."""
        node, running, done = None, None, []
        for batch in batches:
            for *at, text in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if at == node:
                    running.update(b"," + text.encode())
                else:
                    if node is not None:
                        done.append((*node, running.hexdigest()))
                    node, running = at, hashlib.sha256(text.encode())
            if len(done) > 10_000:
                yield _digests(done)
                done = []
        if node is not None:
            done.append((*node, running.hexdigest()))
        if done:
            yield _digests(done)

    def _digests(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*done), [*[pa.int64()] * 3, pa.string()])], names=[*NODE, "ends"])

    pieces = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").select(*NODE, "conv_id")
    pieces = pieces.mapInArrow(join, f"{kinds}, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, f"{kinds}, ends string")


def trie(conversations: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node; see the columns at the end."""
    turns = numbered_turns(conversations)
    rows = materialise(prefixes(rebuilt_turns(turns)), "prefixes")
    rows = materialise(screen(rows, sketch(rows, most_cells)), "screened")
    is_end = F.col("depth") == F.col("turns")

    alone, shared = rows.where("alone"), rows.where(~F.col("alone"))
    beginning_tail = alone.where(~F.col("parent_alone") | (F.col("depth") == 0))

    # From which depth on a conversation is the smallest member, and whether it stands for a leaf.
    least = shared.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("turns").alias("deepest"), F.min("chars_before").alias("chars_before"))
    stands = least.select("conv_id", "depth", "chars_before", (F.col("deepest") == F.col("depth")).alias("leaf"))
    stands = stands.unionByName(beginning_tail.select("conv_id", "depth", "chars_before", F.lit(True).alias("leaf")))
    past = rows.where(is_end).select("conv_id", (F.col("depth") + 1).alias("depth"),
                                     (F.col("chars_before") + F.col("chars")).alias("chars_before"), F.lit(False).alias("leaf"))
    stands = stands.unionByName(past).groupBy("conv_id").agg(
        F.min("depth").alias("own_from"), F.min("chars_before").alias("chars_to_own"), F.max("leaf").alias("leaf"))

    met = shared.join(stands, "conv_id")
    nodes = met.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if((F.col("own_from") <= F.col("depth") + 1) & (F.col("depth") < F.col("turns"))).alias("n_children"),
        F.count_if("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.col("chars_to_own") - F.col("chars_before"), F.lit(0))).alias("saved_tokens"),
        F.min("parent_a").alias("parent_a"), F.min("parent_b").alias("parent_b"), F.max("parent_alone").alias("parent_alone"))
    nodes = materialise(nodes, "nodes")
    ends = end_digests(shared.where(is_end))

    text = F.col("conv_id").cast("string")
    one = F.lit(1).cast("long")
    tails = alone.select(
        *NODE, "conv_id", one.alias("n_convs"), F.when(is_end, F.lit(0)).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(is_end, F.sha2(text, 256)).otherwise(NO_ENDS).alias("ends_sha256"), "parent_a", "parent_b", "parent_alone")
    grouped = nodes.join(ends, NODE, "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    every = grouped.select(*tails.columns).unionByName(tails)
    return _with_parents(every, nodes)


def _with_parents(every: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes with their parents' conversations. A parent of a single conversation is known; the others are looked up."""
    known = F.col("parent_alone") | (F.col("depth") == 0)
    result = lambda parent: [
        "conv_id", "depth", parent.cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    within = every.where(known).select(*result(F.when(F.col("depth") > 0, F.col("conv_id"))))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent"))
    looked_up = every.where(~known).join(parents, ["depth", "parent_a", "parent_b"])
    return within.unionByName(looked_up.select(*result(F.col("parent"))))
