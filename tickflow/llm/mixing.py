"""Mixing sources to target weights: tempered shares, realised by block permutations.

A source's weight is its token share to the power of an exponent between 0 (all
sources alike) and 1 (as they come), normalised. The exponent is bisected until the
weights reach a target entropy, or as far as no source is repeated too often. A
source's budget is spent in epochs: whole ones first, then blocks of documents in a
permutation of their own, and in the block where the budget ends, documents in hash
order. Documents are dealt to a fixed number of blocks by hash, so a source with a
third of all rows is spread over as many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.links import join_dealt
from tickflow.llm.text import or_empty, words
from tickflow.session import materialize


@dataclass(frozen=True)
class MixSpec:
    #: Entropy to reach, as a share of the largest one (all sources alike).
    entropy_share: float = 0.95
    #: No source is used more often than this; it outranks the entropy.
    max_repeats: float = 2.0
    #: Tokens of the mixture, as a share of all tokens.
    budget_share: float = 1.0
    #: Blocks that each source's documents are dealt to.
    blocks: int = 4096
    seed: int = 17
    #: Candidate exponents in each step of the search, and steps: 15^5 places.
    branches: int = 15
    steps: int = 5


def _tokens(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, spec: MixSpec
) -> DataFrame:
    """Documents with tokens: doc_id, source, n_tokens, text_hash, and their place by hash."""
    return (
        docs.select(
            F.col(id_col).alias("doc_id"),
            or_empty(source_col).alias("source"),
            F.size(words(or_empty(text_col))).cast("long").alias("n_tokens"),
            F.xxhash64(text_col).alias("text_hash"),
        )
        .filter("n_tokens > 0")
        .withColumn("_place", F.xxhash64(F.lit(spec.seed), "source", "doc_id"))
        .withColumn("block", F.pmod("_place", F.lit(spec.blocks)).cast("int"))
    )


def tempering(totals: DataFrame, spec: MixSpec) -> float:
    """The exponent for sources with ``tokens``; one row per candidate comes back a step.

    Entropy falls and the most-repeated source's use falls as the exponent grows. The
    largest exponent that reaches the entropy is taken, or a larger one if the limit
    on repeats asks for it; 1 where even that breaks the limit or there is no token.
    """
    whole = totals.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("sources")).first()
    if not whole.sources:
        return 1.0
    shares = totals.select((F.col("tokens") / whole.tokens).alias("p"))

    def bisect(good_above: bool, test: str) -> float:
        """The border between exponents that pass ``test`` and those that don't."""
        low, high = 0.0, 1.0
        for _ in range(spec.steps):
            step = (high - low) / (spec.branches + 1)
            points = [low + step * k for k in range(1, spec.branches + 1)]
            tested = (
                shares.select("p", F.explode(F.array(*map(F.lit, points))).alias("x"))
                .withColumn("w", F.pow("p", "x"))
                .groupBy("x")
                .agg(
                    F.sum("w").alias("z"),
                    F.sum(F.col("w") * F.log("w")).alias("wl"),
                    F.max(F.col("w") / F.col("p")).alias("use"),
                )
                .selectExpr("x", f"{test} AS ok")
                .orderBy("x")
                .collect()
            )
            ok = [row.ok for row in tested]
            k = ok.index(good_above) if good_above in ok else len(ok)
            edges = [low, *points, high]
            low, high = edges[k], edges[k + 1]
        return high if good_above else low

    entropy = f"ln(z) - wl / z >= {spec.entropy_share} * ln({whole.sources}) - 1e-12"
    repeats = f"{spec.budget_share} * use / z <= {spec.max_repeats}"
    return max(bisect(False, entropy), bisect(True, repeats))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    spec: MixSpec = MixSpec(),
) -> DataFrame:
    """One row per use of a document: doc_id, source, n_tokens, weight, epoch, block, rank,
    text_hash.

    ``rank`` is the block's place in its epoch's permutation, so a reader that goes by
    epoch and rank sees each source's blocks in an order of their own. The tokens used of
    a source stay within its budget and miss it by less than one document.

    Tokens are words. Null, empty and wordless texts have none and are in no mixture.
    Null and empty sources are one source. Rows that repeat an id are documents of their
    own with the same place; ties in a block go by id. An empty table gives an empty
    result; other columns are not read.
    """
    rows = materialize(_tokens(docs, id_col, text_col, source_col, spec), "tokens")
    blocks = rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("_tokens"))
    blocks = materialize(blocks, "blocks")
    totals = materialize(blocks.groupBy("source").agg(F.sum("_tokens").alias("tokens")), "totals")
    exponent = tempering(totals, spec)
    tempered = totals.withColumn("_w", F.pow(F.col("tokens").cast("double"), F.lit(exponent)))
    norm = tempered.agg(F.sum("_w").alias("w"), F.sum("tokens").alias("tokens")).first()
    weight = F.col("_w") / (norm.w or 1.0)
    budget = F.floor(F.col("weight") * (spec.budget_share * (norm.tokens or 0))).cast("long")
    budgets = (
        tempered.withColumn("weight", weight)
        .withColumn("_budget", budget)
        .withColumn("_full", F.floor(F.col("_budget") / F.col("tokens")).cast("int"))
        .withColumn("_rest", F.col("_budget") - F.col("_full") * F.col("tokens"))
        .select("source", "weight", "_full", "_rest")
    )
    # At most `blocks` rows of a source meet in one task here.
    order = Window.partitionBy("source").orderBy("_turn", "block")
    last_turn = F.xxhash64(F.lit(spec.seed), F.col("_full"), "source", "block")
    plan = (
        blocks.join(budgets, "source")
        .withColumn("_turn", last_turn)
        .withColumn("_before", F.sum("_tokens").over(order) - F.col("_tokens"))
        .withColumn("_left", F.col("_rest") - F.col("_before"))
        .withColumn(
            "_state",
            F.when(F.col("_left") >= F.col("_tokens"), 2).when(F.col("_left") > 0, 1).otherwise(0),
        )
        .select(
            F.xxhash64("source", "block").alias("_cell"),
            F.col("source").alias("_source"),
            *("weight", "_full", "_left", "_state"),
        )
    )
    keyed = rows.withColumn("_cell", F.xxhash64("source", "block"))
    placed = join_dealt(keyed, plan, "_cell").filter("source = _source")
    # One block of each source is cut; only its rows are put in order.
    within = (
        Window.partitionBy("source", "block")
        .orderBy("_place", "doc_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    cut = (
        placed.filter("_state = 1")
        .withColumn("_used", F.sum("n_tokens").over(within))
        .withColumn("_part", (F.col("_used") <= F.col("_left")).cast("int"))
        .drop("_used")
    )
    others = placed.filter("_state <> 1").withColumn("_part", (F.col("_state") == 2).cast("int"))
    return (
        others.unionByName(cut)
        .withColumn("_uses", F.col("_full") + F.col("_part"))
        .filter("_uses > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_uses") - 1)))
        .withColumn("rank", F.xxhash64(F.lit(spec.seed), "epoch", "source", "block"))
        .select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "rank", "text_hash")
    )
