"""The prefix trie of conversations: count-min screening, then exact grouping.

Every prefix of a conversation has a 128-bit digest. A count-min sketch of all digests,
of bounded size, tells which prefixes may be shared: an estimate of one proves that no
other conversation has the prefix, nor any longer one. The nodes of such tails are
emitted where their rows are read. Only prefixes that may be shared are shuffled, as
rows without text, and grouped by their digests.

Sums over subtrees need no walk along the trie. A node is counted by the least
conversation that has it, so a sum over the nodes below one is a sum over its members,
each of which adds what it counts for on the rest of its own path.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.shingles import mix
from tickflow.llm.text import or_empty
from tickflow.session import materialize

#: Hash of no members.
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Slots of a sketch row that are merged and sent together.
BLOCK = 1 << 15
_U = np.uint64


@dataclass(frozen=True)
class SketchSize:
    """Rows of the count-min sketch, and slots of each: two per prefix, a power of two.

    ``most`` bounds a task's counters (1 byte a slot) to 96 MB and the broadcast table
    (1 bit a slot) to 12 MB. Beyond that estimates get looser: more prefixes are grouped
    exactly, and the result stays the same.
    """

    rows: int = 3
    least: int = 1 << 16
    most: int = 1 << 25

    def slots(self, prefixes: int) -> int:
        return min(max(1 << (2 * prefixes).bit_length(), self.least), self.most)


def numbered_turns(
    conversations: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, pos, ta, tb, bytes): a conversation's turns in order, as two hashes each.

    ``pos`` counts from 1 by turn, null first; turns with one number are ordered by role,
    then by a hash of their content. Null roles and texts are empty. Rows without an id
    belong to no conversation and are left out.
    """
    content = (or_empty(role_col), or_empty(text_col))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("_turn"),
        content[0].alias("_role"),
        F.xxhash64(F.lit(1), *content).alias("ta"),
        F.xxhash64(F.lit(2), *content).alias("tb"),
        F.octet_length(content[1]).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv").orderBy(
        F.col("_turn").asc_nulls_first(), "_role", "ta", "tb"
    )
    return rows.withColumn("pos", F.row_number().over(order)).drop("_turn", "_role")


def with_family_heads(turns: DataFrame, family: int, modulus: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first turns of their family's first one.

    A conversation c takes the first h turns of conversation ``c - c % family`` (all if it
    has fewer, none if there is no such one) and goes on with its own turns after its
    first h, where h is the CRC-32 of its decimal id modulo ``modulus``. Returns the turns
    (conv, d, n, ta, tb, bytes) and all conversations (conv, n), those without turns too.
    """
    head = F.crc32(F.col("conv").cast("string")) % modulus
    convs = turns.groupBy("conv").agg(F.count("*").alias("n_own"))
    convs = convs.select("conv", "n_own", head.alias("h"), (F.col("conv") - F.col("conv") % family).alias("first"))
    firsts = turns.filter(F.col("conv") % family == 0)
    sizes = convs.filter("conv = first").select("first", F.col("n_own").alias("n_first"))
    lead = F.least("h", F.coalesce("n_first", F.lit(0).cast("long")))
    after = F.greatest(F.col("n_own") - F.col("h"), F.lit(0).cast("long"))
    convs = materialize(
        convs.join(sizes, "first", "left").select("conv", "first", "h", lead.alias("lead"), (lead + after).alias("n")),
        "convs",
    )
    content = ("ta", "tb", "bytes")
    heads = firsts.filter(F.col("pos") < modulus).withColumnRenamed("conv", "first")
    led = convs.join(heads, "first").filter("pos <= h").select("conv", F.col("pos").cast("long").alias("d"), "n", *content)
    facts = convs.filter("n > lead").select("conv", "h", "lead", "n")
    own = turns.join(facts, "conv").filter("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("lead")).alias("d"), "n", *content)
    return led.unionByName(own), convs.select("conv", "n")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Turns (conv, d, n, ta, tb, bytes) with the digests of the prefix that ends there
    (da, db) and of the one before (pa, pb); the empty prefix has 0, 0."""
    upto = Window.partitionBy("conv").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    marked = turns.select(
        *("conv", "d", "n", "bytes"),
        F.xxhash64("ta", "d").alias("ta"),
        F.xxhash64("tb", "d").alias("tb"),
    )
    run = marked.select("*", F.bit_xor("ta").over(upto).alias("da"), F.bit_xor("tb").over(upto).alias("db"))
    before = [F.col(d).bitwiseXOR(F.col(t)).alias(p) for d, t, p in (("da", "ta", "pa"), ("db", "tb", "pb"))]
    return run.select("conv", "d", "n", "bytes", "da", "db", *before)


def _slots(da: np.ndarray, db: np.ndarray, row: int, slots: int) -> np.ndarray:
    """Slots of digests in a row of the sketch."""
    key = mix(da.view(_U) + mix(db.view(_U) + np.array([row + 1], dtype=_U)))
    return (key & _U(slots - 1)).astype(np.int64)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def count_min(digests: DataFrame, size: SketchSize, slots: int) -> np.ndarray:
    """A bit per sketch row and slot: whether two or more of (da, db) fell there.

    Tasks count up to two and send the blocks that they touched; blocks are merged where
    they meet, one group each, and only the merged bits come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((size.rows, slots), dtype=np.uint8)
        for batch in batches:
            da, db = _column(batch, "da"), _column(batch, "db")
            for i, row in enumerate(counts):
                at, times = np.unique(_slots(da, db, i, slots), return_counts=True)
                row[at] = np.minimum(row[at] + np.minimum(times, 2), 2)
        for i, row in enumerate(counts):
            for block in np.flatnonzero(row.reshape(-1, BLOCK).any(axis=1)).tolist():
                own = row[block * BLOCK : (block + 1) * BLOCK]
                bits = [zlib.compress(np.packbits(own >= k, bitorder="little").tobytes(), 1) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([block]), *[pa.array([b], type=pa.binary()) for b in bits]],
                    names=["row", "block", "once", "twice"],
                )

    def merge(parts: pa.Table) -> pa.Table:
        once = twice = np.zeros(BLOCK // 8, dtype=np.uint8)
        for a, b in zip(parts["once"].to_pylist(), parts["twice"].to_pylist(), strict=True):
            a, b = (np.frombuffer(zlib.decompress(x), dtype=np.uint8) for x in (a, b))
            twice = twice | b | (once & a)
            once = once | a
        return pa.table(
            {"row": parts["row"][:1], "block": parts["block"][:1], "twice": pa.array([twice.tobytes()], type=pa.binary())}
        )

    parts = digests.mapInArrow(count, "row long, block long, once binary, twice binary")
    merged = parts.groupBy("row", "block").applyInArrow(merge, "row long, block long, twice binary")
    bits = np.zeros((size.rows, slots // 8), dtype=np.uint8)
    width = BLOCK // 8
    for r in merged.toLocalIterator():
        bits[r.row, r.block * width : (r.block + 1) * width] = np.frombuffer(r.twice, dtype=np.uint8)
    return bits


def _screened(prefixes: DataFrame, bits: np.ndarray) -> DataFrame:
    """Prefixes with ``maybe`` and ``above``: whether they, and the ones before, may be shared."""
    table = prefixes.sparkSession.sparkContext.broadcast(bits)

    def shared(da: np.ndarray, db: np.ndarray) -> np.ndarray:
        out = np.ones(len(da), dtype=bool)
        for i, row in enumerate(table.value):
            slot = _slots(da, db, i, 8 * len(row))
            out &= (row[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return out

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = shared(_column(batch, "da"), _column(batch, "db"))
            above = shared(_column(batch, "pa"), _column(batch, "pb")) | (_column(batch, "d") == 1)
            names = ("conv", "d", "n", "bytes", "da", "db")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(maybe), pa.array(above)],
                names=[*names, "maybe", "above"],
            )

    schema = "conv long, d long, n long, bytes long, da long, db long, maybe boolean, above boolean"
    return prefixes.mapInArrow(screen, schema)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(da, db, ends): per node the SHA-256 of the ids (conv) that end there, ascending.

    Rows are ordered over all partitions by node and id, so that a node's ids may span
    many; each batch sends one text of consecutive ids per node. Those texts are hashed
    in order as a stream, so no task holds a node's ids.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            da, db, conv = (_column(batch, c) for c in ("da", "db", "conv"))
            cuts = np.flatnonzero((np.diff(da) != 0) | (np.diff(db) != 0)) + 1
            begin = np.concatenate([[0], cuts])
            joined = [",".join(map(str, part.tolist())) for part in np.split(conv, cuts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(da[begin]), pa.array(db[begin]), pa.array(conv[begin]), pa.array(joined)],
                names=["da", "db", "first", "ids"],
            )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()

        def row(node: tuple[int, int], digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"da": [node[0]], "db": [node[1]], "ends": [digest.hexdigest()]})

        for batch in batches:
            rows = []
            for da, db, ids in zip(*(batch.column(c).to_pylist() for c in ("da", "db", "ids")), strict=True):
                if node == (da, db):
                    digest.update(b",")
                else:
                    if node is not None:
                        rows.append(row(node, digest))
                    node, digest = (da, db), hashlib.sha256()
                digest.update(ids.encode())
            yield from rows
        if node is not None:
            yield row(node, digest)

    ordered = ends.repartitionByRange("da", "db", "conv").sortWithinPartitions("da", "db", "conv")
    parts = ordered.mapInArrow(texts, "da long, db long, first long, ids string")
    parts = parts.repartition("da", "db").sortWithinPartitions("da", "db", "first")
    return parts.mapInArrow(hashes, "da long, db long, ends string")


def _own_end(at_end: Column, conv: str = "conv") -> Column:
    """The hash of the members that end at a node with one member."""
    return F.when(at_end, F.sha2(F.col(conv).cast("string"), 256)).otherwise(F.lit(NO_ENDS))


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(turns: DataFrame, convs: DataFrame, size: SketchSize = SketchSize()) -> DataFrame:
    """The nodes of the trie of conversations, one row each.

    ``turns`` has one row per conversation and depth d = 1 ... n: conv, d, n, ta, tb (two
    hashes of the turn's content) and bytes; ``convs`` one row (conv, n) per conversation,
    also for those without turns. Columns: conv_id (the smallest member), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens (the
    bytes of turns that the node and those below it spare by being stored once) and
    ends_sha256 (of the members that end there). Prefixes with equal 128-bit digests
    are one. Repeated conversations share all their nodes. Without conversations there
    are no nodes, not even a root.
    """
    spark = turns.sparkSession
    root = convs.agg(F.min("conv")).first()[0]
    if root is None:
        return spark.createDataFrame([], NODE)
    prefixes = materialize(_prefixes(turns), "prefixes")
    bits = count_min(prefixes.select("da", "db"), size, size.slots(prefixes.count()))
    rows = materialize(_screened(prefixes, bits), "screened")
    shared = rows.filter("maybe")
    groups = shared.groupBy("da", "db").agg(
        F.count("*").alias("n_convs"),
        F.min("conv").alias("rep"),
        F.sum((F.col("d") == F.col("n")).cast("long")).alias("n_ends"),
        F.max("d").alias("depth"),
        F.max("bytes").alias("last_bytes"),
    )
    groups = materialize(groups, "groups")
    # Joined by a third column too: both sides are dealt out, so a hot prefix can be split.
    check = (F.hash("da", "db") % 2).alias("_check")
    facts = groups.select("da", "db", "n_convs", "rep", "n_ends", check)
    known = shared.select("conv", "d", "n", "bytes", "da", "db", check).join(facts, ["da", "db", "_check"])
    along = Window.partitionBy("conv").orderBy("d")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv")
    spared = F.when(F.col("rep") == F.col("conv"), 0).otherwise(F.col("bytes"))
    at_end = F.col("d") == F.col("n")
    leaf = F.max(F.when(at_end, ((F.col("n_ends") == F.col("n_convs")) & (F.col("rep") == F.col("conv"))).cast("long")))
    path = known.select(
        "*",
        F.lag("d").over(along).alias("_d_before"),
        F.lag("rep").over(along).alias("_rep_before"),
        F.lead("d").over(along).alias("_d_after"),
        F.lead("rep").over(along).alias("_rep_after"),
        (F.sum(spared).over(whole) - F.sum(spared).over(upto) + spared).alias("_saved"),
        F.coalesce(leaf.over(whole), F.lit(1).cast("long")).alias("_leaf"),
    )
    tail_next = ~at_end & ~F.col("_d_after").eqNullSafe(F.col("d") + 1)
    child = (~at_end & (tail_next | (F.col("_rep_after") == F.col("conv")))).cast("long")
    parent = (
        F.when(F.col("d") == 1, F.lit(root))
        .when(F.col("_d_before") == F.col("d") - 1, F.col("_rep_before"))
        .otherwise(F.col("conv"))
    )
    path = materialize(path.select("*", tail_next.alias("_tail"), child.alias("_child"), parent.alias("_parent")), "paths")
    nodes = path.groupBy("da", "db").agg(
        F.max("rep").alias("conv_id"),
        F.max("d").alias("depth"),
        F.max("_parent").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.sum("_child").alias("n_children"),
        F.sum("_leaf").alias("n_leaves"),
        F.sum("_saved").alias("saved_tokens"),
    )
    ends = shared.filter("d = n").select("da", "db", "conv")
    zero = F.lit(0).cast("long")
    turnless = convs.filter("n = 0").select(zero.alias("da"), zero.alias("db"), "conv")
    hashes = materialize(_end_hashes(ends.union(turnless)), "ends")
    nodes = nodes.unionByName(_root(convs, rows, groups))
    nodes = nodes.join(hashes, ["da", "db"], "left").select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    tails = rows.filter("NOT maybe AND (NOT above OR d = 1)")
    tails = _singles(tails, F.col("d"), F.when(F.col("d") == 1, F.lit(root)).otherwise(F.col("conv")))
    starts = _singles(path.filter("_tail"), F.col("d") + 1, F.col("rep"))
    return nodes.unionByName(starts).unionByName(tails)


def _singles(rows: DataFrame, depth: Column, parent: Column) -> DataFrame:
    """Nodes with one member, at a depth of the rows' conversations."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    return rows.select(
        F.col("conv").alias("conv_id"),
        depth.alias("depth"),
        parent.alias("parent_conv_id"),
        one.alias("n_convs"),
        (depth < F.col("n")).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        _own_end(depth == F.col("n")).alias("ends_sha256"),
    )


def _root(convs: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The root's row, from sums over conversations, screened rows and groups."""
    zero = F.lit(0).cast("long")

    def counts(df: DataFrame, conv: Column, convs: Column, children: Column, leaves: Column, saved: Column) -> DataFrame:
        return df.select(
            conv.alias("conv"), convs.alias("convs"), children.cast("long").alias("children"),
            leaves.cast("long").alias("leaves"), saved.alias("saved"),
        )

    none = F.lit(None).cast("long")
    alone = counts(rows.filter("NOT maybe"), none, zero, F.col("d") == 1, F.col("d") == F.col("n"), zero)
    spared = (F.col("n_convs") - 1) * F.col("last_bytes")
    grouped = counts(groups, none, zero, F.col("depth") == 1, F.col("n_ends") == F.col("n_convs"), spared)
    all_ = counts(convs, F.col("conv"), F.lit(1).cast("long"), zero, zero, zero)
    total = alone.union(grouped).union(all_).agg(
        *[f(c).alias(c) for c, f in (("conv", F.min), ("convs", F.sum), ("children", F.sum), ("leaves", F.sum), ("saved", F.sum))]
    )
    return total.select(
        zero.alias("da"),
        zero.alias("db"),
        F.col("conv").alias("conv_id"),
        zero.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("convs").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.greatest("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
    )
