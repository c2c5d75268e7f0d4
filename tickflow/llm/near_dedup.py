"""Near-duplicates: SetSketch registers, bands of register values, likelihood, full sets.

Texts with equal shingle sets are one class. Each class has one sketch; classes that
agree in all registers of a band share a bucket. In a bucket every member is compared
with one, its hub, never with all others, so a bucket of n near copies costs n
comparisons. Buckets whose members then belong to more than one component stay open.
Members of open buckets look for links to other components by their rarest shingles:
of a linked pair the smaller set has one that the larger one has too among so few that
it could not do without all of them. Large components are looked at as a whole first:
how many shingles of a set any of their members has bounds the similarity to all of
them. A candidate pair first has its similarity estimated from the sketches by
likelihood; pairs that could be similar are verified on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.batches import small_batches
from tickflow.llm.links import components, join_dealt
from tickflow.llm.set_sketch import SketchSpec, estimated_jaccard, registers
from tickflow.llm.shingles import mix, shingle_sets, slices, string_buffers
from tickflow.llm.slots import only, perhaps
from tickflow.session import materialize

#: An estimate's standard error is about 0.02 (448 registers). Similarities are taken to
#: be within five of them; pairs that can't reach the threshold are not read in full.
ESTIMATE_MARGIN = 0.1
#: The same for a first look at two bits of each register.
COARSE_MARGIN = 0.125
#: Members of open buckets from which a component is looked at as a whole first.
LARGE = 32


def sketches(docs: DataFrame, id_col: str, text_col: str, spec: SketchSpec) -> DataFrame:
    """Per row: id, a hash of the text, n_shingles, the set's hash and its registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffers(batch.column(2))
            for a, b in slices(offsets):
                part = offsets[a : b + 1]
                flat, bounds = shingle_sets(raw[part[0] : part[-1]], part - part[0])
                rows = registers(flat, bounds, spec)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(a, b - a) for i in (0, 1)],
                        pa.array(np.diff(bounds)),
                        set_hashes(flat, bounds),
                        pa.array([r.tobytes() for r in rows], type=pa.binary()),
                    ],
                    names=["_id", "text_hash", "n_shingles", "_named", "_registers"],
                )

    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("text_hash"), text).mapInArrow(
        sketch, "_id long, text_hash long, n_shingles long, _named long, _registers binary"
    )


def full_sets(docs: DataFrame) -> DataFrame:
    """(_named, _set) for rows (_text): a hash that names a set, and the set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffers(batch.column(0))
            for a, b in slices(offsets):
                part = offsets[a : b + 1]
                flat, bounds = shingle_sets(raw[part[0] : part[-1]], part - part[0])
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds, type=pa.int32()), pa.array(flat.view(np.int64))
                )
                names = set_hashes(flat, bounds)
                yield pa.RecordBatch.from_arrays([names, lists], names=["_named", "_set"])

    return docs.select("_text").mapInArrow(sets, "_named long, _set array<long>")


def set_hashes(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A hash that names each set."""
    sums = np.cumsum(mix(flat ^ np.uint64(0x5BD1E995)), dtype=np.uint64)
    return pa.array(np.diff(np.concatenate([[np.uint64(0)], sums])[bounds]).view(np.int64))


def _estimates(pairs: DataFrame, spec: SketchSpec) -> DataFrame:
    """Pairs (a, b) with the similarity their sketches make most likely."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(
                    -1, spec.registers
                )
                for c in (4, 5)
            )
            n_one, n_two = (batch.column(c).to_numpy().astype(float) for c in (2, 3))
            likely = estimated_jaccard(one, two, n_one, n_two, spec)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(likely)], names=["a", "b", "likely"]
            )

    return pairs.select("a", "b", "n_a", "n_b", "reg_a", "reg_b").mapInArrow(
        estimate, "a long, b long, likely double"
    )


class _Verifier:
    """Decides pairs of classes: by sketch first, then on full sets."""

    def __init__(self, docs: DataFrame, reps: DataFrame, spec: SketchSpec, percent: int) -> None:
        self.docs, self.reps, self.spec, self.percent = docs, reps, spec, percent

    def sets(self, reps: DataFrame) -> DataFrame:
        """(rep, _set) of classes: of rows with the id of one of their documents, the text
        that has the class's set. An id may stand on other texts as well."""
        ids = self.reps.join(reps.select("rep").distinct(), "rep").select("_id", "rep", "_named")
        texts = only(self.docs, ids.select("_id").distinct(), "_id").dropDuplicates(["_id", "_text"])
        sets = full_sets(texts).join(ids.select("rep", "_named"), "_named")
        return sets.drop("_named").dropDuplicates(["rep"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b), those that are similar enough, as a written table."""
        ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
        near = perhaps(self.reps, ends, ["rep"])
        side = lambda x: near.select(
            F.col("rep").alias(x),
            F.col("n_shingles").alias(f"n_{x}"),
            F.col("_registers").alias(f"reg_{x}"),
        )
        likely = _estimates(pairs.join(side("b"), "b").join(side("a"), "a"), self.spec)
        floor = self.percent / 100 - ESTIMATE_MARGIN
        close = materialize(likely.filter(F.col("likely") >= floor).select("a", "b"), "close")
        needed = close.select(F.col("a").alias("rep")).union(close.select("b"))
        sets = materialize(self.sets(needed), "sets")
        set_a = sets.select(F.col("rep").alias("a"), F.col("_set").alias("set_a"))
        set_b = sets.select(F.col("rep").alias("b"), F.col("_set").alias("set_b"))
        both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
        either = F.size("set_a") + F.size("set_b") - both
        verified = close.join(set_b, "b").join(set_a, "a")
        verified = verified.filter(100 * both >= self.percent * either)
        return materialize(verified.select("a", "b"), "links")


def _buckets(reps: DataFrame, spec: SketchSpec) -> DataFrame:
    """(key, rep, hub): members of buckets with at least two classes, and their hub.

    The hub is the member that is in most buckets, the least of several: of a group of
    near copies that is the one nearest to all others, and the same in most buckets.
    """
    width = spec.rows
    bands = reps.select(
        "rep",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.lit(spec.bands - 1)),
                lambda i: F.xxhash64(i, F.substring("_registers", i * width + 1, F.lit(width))),
            )
        ).alias("key"),
    )
    shared = bands.groupBy("key").agg(F.min("rep").alias("_least"), F.max("rep").alias("_most"))
    shared = materialize(shared.filter("_least < _most").select("key"), "shared")
    members = materialize(join_dealt(perhaps(bands, shared, ["key"]), shared, "key"), "members")
    often = members.groupBy("rep").agg(F.count("*").alias("often"))
    ranked = join_dealt(members, often, "rep").withColumn(
        "_place", F.struct(-F.col("often"), "rep")
    )
    hubs = ranked.groupBy("key").agg(F.min("_place").alias("_place"))
    hubs = hubs.select("key", F.col("_place.rep").alias("hub"))
    return materialize(join_dealt(members, hubs, "key"), "buckets")


def _packed(reps: DataFrame, spec: SketchSpec) -> DataFrame:
    """(rep, packed): the low two bits of each register, 32 registers to a long."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column(1).to_pylist())
            low = np.frombuffer(raw, dtype=np.uint8).reshape(-1, spec.registers) & 3
            low = np.pad(low, ((0, 0), (0, -spec.registers % 32)))
            low = low[:, ::4] | low[:, 1::4] << 2 | low[:, 2::4] << 4 | low[:, 3::4] << 6
            longs = np.ascontiguousarray(low).view("<i8")
            bounds = np.arange(len(low) + 1) * longs.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), longs.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["rep", "packed"])

    return reps.select("rep", "_registers").mapInArrow(pack, "rep long, packed array<long>")


def _coarsely_near(one: str, two: str, similarity: float, spec: SketchSpec) -> Column:
    """Whether two packed sketches agree as often as sets of that similarity may."""
    differ = F.lit(0)
    for i in range(-(-spec.registers // 32)):
        x = F.get(one, F.lit(i)).bitwiseXOR(F.get(two, F.lit(i)))
        some = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(some)
    # Of unequal registers a quarter agree in two bits.
    return differ <= 0.75 * spec.registers * (1 - similarity + COARSE_MARGIN)


class _Open:
    """Members of open buckets, and candidates for links between their components.

    ``members``: key, rep, component. A link asks for ``percent`` of the larger set, and
    for more of the smaller one, in common; so of shingles in order of rarity each set's
    first few tell. A shingle's rarity is the number of components that have it.
    """

    def __init__(self, members: DataFrame, verifier: _Verifier) -> None:
        self.members, self.percent, self.spec = members, verifier.percent, verifier.spec
        named = members.select("rep", "component").distinct()
        known = perhaps(verifier.reps, named, ["rep"]).join(named, "rep")
        facts = known.select("rep", "component", "n_shingles").join(_packed(known, self.spec), "rep")
        sizes = named.groupBy("component").agg(F.count("*").alias("_size"))
        self.facts = materialize(
            join_dealt(facts, sizes, "component").withColumn("large", F.col("_size") >= LARGE).drop("_size"), "facts"
        )
        sets = verifier.sets(named).select("rep", F.explode("_set").alias("shingle"))
        self.tokens = materialize(
            sets.join(self.facts.select("rep", "component", "n_shingles", "large"), "rep"), "tokens"
        )
        self.first = materialize(self._first(), "first")

    def _first(self) -> DataFrame:
        """(rep, shingle, place): the shingles that tell, from one on, if others have them."""
        held = self.tokens.select("shingle", "component").distinct()
        common = held.groupBy("shingle").agg(F.count("*").alias("_held")).filter("_held > 1")
        ranked = join_dealt(self.tokens, common, "shingle")
        others = ranked.groupBy("rep").agg(F.count("*").alias("_others"))
        order = Window.partitionBy("rep").orderBy("_held", "shingle")
        # Shingles that no other component has come first; they are not listed.
        alone = F.col("n_shingles") - F.col("_others")
        return (
            join_dealt(ranked.withColumn("_nth", F.row_number().over(order)), others, "rep")
            .withColumn("place", F.col("_nth") + alone)
            .filter(F.col("place") <= self._telling(F.lit(self.percent), F.lit(100)))
            .select("rep", "component", "n_shingles", "large", "shingle", "place")
        )

    def _telling(self, part: Column, whole: Column) -> Column:
        """How many of a set's shingles tell if a link has ``part / whole`` of them."""
        n = F.col("n_shingles")
        return n - F.floor((part * n + whole - 1) / whole) + 1

    def pairs(self) -> DataFrame:
        """Distinct pairs (a, b) of different components that may be linked."""
        return self._small().union(self._with_large()).distinct()

    def _side(self, rows: DataFrame, prefix: str) -> DataFrame:
        return rows.select([F.col(c).alias(prefix + c) for c in rows.columns])

    def _near(self, one: str, two: str) -> Column:
        return _coarsely_near(one, two, self.percent / 100, self.spec)

    def _small(self) -> DataFrame:
        """Pairs outside large components: the smaller set's first shingles meet the other's."""
        few = self._telling(F.lit(2 * self.percent), F.lit(100 + self.percent))
        mark = F.struct("place", "shingle", (F.col("place") <= few).alias("few"))
        telling = self.first.filter("NOT large").groupBy("rep").agg(F.array_sort(F.collect_list(mark)).alias("_marks"))
        telling = telling.select(
            "rep",
            F.col("_marks.shingle").alias("long"),
            F.transform(F.filter("_marks", lambda m: m["few"]), lambda m: m["shingle"]).alias("short"),
        )
        facts = self.facts.filter("NOT large").join(telling, "rep").drop("large")
        facts = materialize(facts, "telling")
        left = self._side(facts.withColumn("shingle", F.explode("short")), "a_").drop("a_long")
        right = self._side(facts.withColumn("shingle", F.explode("long")), "b_").drop("b_short")
        size = lambda x: F.struct(F.col(f"{x}_n_shingles").alias("n"), F.col(f"{x}_rep").alias("rep"))
        met = (
            (F.col("a_shingle") == F.col("b_shingle"))
            & (F.col("a_component") != F.col("b_component"))
            & (size("a") < size("b"))
            & (100 * F.col("a_n_shingles") >= self.percent * F.col("b_n_shingles"))
            & self._near("a_packed", "b_packed")
            # Only at the first shingle that they share.
            & (F.get(F.array_intersect("a_short", "b_long"), F.lit(0)) == F.col("a_shingle"))
        )
        return left.join(right, met).select(
            F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")
        )

    def _with_large(self) -> DataFrame:
        """Pairs with members of large components, where the component may have a link."""
        whole = self.tokens.filter("large").select(F.col("component").alias("_whole"), "shingle").distinct()
        whole = materialize(whole, "whole")
        least = self.facts.filter("large").groupBy(F.col("component").alias("_whole"))
        least = least.agg(F.min("n_shingles").alias("_least"))
        other = F.col("component") != F.col("_whole")
        # What a link with the component's smallest set, or any larger one, has in common.
        n, p = F.col("n_shingles"), self.percent
        need = F.greatest(
            F.floor((p * n + 99) / 100), F.floor((p * (n + F.col("_least")) + 99 + p) / (100 + p))
        )
        met = self.first.join(whole, "shingle").filter(other).join(least, "_whole")
        asked = met.filter(F.col("place") <= n - need + 1).select("rep", "_whole").distinct()
        asked = materialize(asked, "asked")
        shared = self.tokens.join(asked, "rep").join(whole, ["shingle", "_whole"])
        shared = shared.groupBy("rep", "_whole").agg(
            F.count("*").alias("shared"), F.max("n_shingles").alias("n_shingles")
        )
        n, most = F.col("n_shingles"), F.col("shared")
        bounded = (100 * most >= self.percent * n) & (
            100 * most >= self.percent * (n + F.greatest("_least", most) - most)
        )
        open_ = materialize(shared.join(least, "_whole").filter(bounded).select("rep", "_whole", "shared"), "asking")
        keys = self.members.groupBy("rep").agg(F.collect_set("key").alias("keys"))  # of its bands
        facts = self.facts.drop("component", "large").join(keys, "rep")
        asking = open_.join(facts, "rep").withColumn("key", F.explode("keys"))
        members = self.members.withColumnRenamed("component", "_whole").join(facts, "rep")
        met = self._side(asking, "a_").join(
            self._side(members, "b_"),
            (F.col("a_key") == F.col("b_key"))
            & (F.col("a__whole") == F.col("b__whole"))
            & (100 * F.col("a_shared") >= self.percent * (F.col("a_n_shingles") + F.col("b_n_shingles") - F.col("a_shared")))
            & self._near("a_packed", "b_packed")
            & (F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("a_key")),
        )
        return met.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))


def _labelled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components, with their components."""
    members = members.drop("component").withColumnRenamed("rep", "node")
    named = join_dealt(members, parts, "node", "left").withColumnRenamed("node", "rep")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    split = named.groupBy("key").agg(
        F.min("component").alias("_least"), F.max("component").alias("_most")
    )
    split = split.filter("_least < _most").select("key")
    return materialize(join_dealt(named, split, "key"), "open")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 75,
    spec: SketchSpec = SketchSpec(),
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, text_hash.

    Two documents are linked where their shingle sets' intersection is at least
    ``percent`` of the union; ``component_id`` is the smallest id reachable over links.
    Null and empty texts, and texts without a word, have no set, no links and their own
    id. Rows with equal sets are one node, whatever their ids; an id that stands on
    several texts has a node for each. Rows with a null id join no bucket: copies of a
    set that some row with an id has take its component, others none (null), and are
    kept. An empty table gives an empty result; other columns are not read.

    Shingles are 64-bit hashes, and a set is named by 64 bits. A pair exactly at the
    threshold shares no bucket with a probability of about (1 - 0.75^7)^64, 1 in 9,500,
    and less the more alike the two are; the margins of the estimates are five standard
    errors.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, id_col, text_col, percent, spec)


def _classes(named: DataFrame) -> DataFrame:
    """(_named, _id, rep) of the distinct sets: the least id of its rows, and its node.

    The node is that id, which packs well; where an id stands on several sets, it is one
    set's node and the others have their hashes.
    """
    classes = named.groupBy("_named").agg(F.min("_id").alias("_id"))
    owner = classes.groupBy("_id").agg(F.min("_named").alias("_owner"))
    node = F.when(F.col("_named") == F.col("_owner"), F.col("_id")).otherwise(F.col("_named"))
    return join_dealt(classes, owner, "_id").select("_named", "_id", node.alias("rep"))


def _near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, percent: int, spec: SketchSpec
) -> DataFrame:
    narrow = materialize(sketches(docs, id_col, text_col, spec), "sketches")
    named = narrow.filter("n_shingles > 0 and _id is not null")
    classes = materialize(_classes(named), "classes")
    reps = named.join(classes, ["_id", "_named"])
    reps = reps.select("rep", "_id", "_named", "n_shingles", "_registers").dropDuplicates(["rep"])
    reps = materialize(reps, "reps")
    buckets = _buckets(reps, spec).filter("rep <> hub")
    pairs = buckets.select(F.least("hub", "rep").alias("a"), F.greatest("hub", "rep").alias("b"))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    verifier = _Verifier(texts, reps, spec, percent)
    links = verifier.links(pairs.distinct())
    parts = components(links, "a", "b")
    members = _labelled(buckets.select("key", "rep"), parts)
    if not members.isEmpty():
        found = verifier.links(_Open(members, verifier).pairs())
        if not found.isEmpty():
            parts = components(links.union(found), "a", "b")
    named = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("_named", "_id", F.coalesce("component", "rep").alias("_part"))
    least = named.groupBy("_part").agg(F.min("_id").alias("_component"))
    named = materialize(join_dealt(named, least, "_part").select("_named", "_component"), "named")
    ids = narrow.select("_id", "text_hash", "n_shingles", "_named")
    own = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("_id"))
    return join_dealt(ids, named, "_named", "left").select(
        F.col("_id").alias("doc_id"),
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(F.col("_id") == own, own.isNull()).alias("kept"),
        "text_hash",
    )
