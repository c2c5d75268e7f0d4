"""Incremental gold refresh over stored bar tables.

A table of progress is committed with each build: per product the next grid step, the
newest bar seen and the bar that the next build's first return starts from. A refresh
reads the bars' newest days to see which products went on, then per product the bars
that its pending grid points can see. Nothing older is opened, in bars or in gold; rows
are checked as they are added. Products that lag behind are read on their own, so none
pulls the others' scans back.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions.clock import floor_div, micros, step_ceil, step_floor, step_time
from tickflow.operators import gold, quality
from tickflow.session import materialize
from tickflow.sinks.tables import BatchTable, VersionedTable
from tickflow.sources.relations import since
from tickflow.spec import BarSpec

BAR_DAY = "bar_date"
GOLD_DAY = "as_of_date"
#: How long before the newest bar others may still come in without a scan of their own.
LOOKBACK = timedelta(days=2)


def gold_table(root: str) -> VersionedTable:
    return VersionedTable(root, schemas.with_day(schemas.GOLD, GOLD_DAY), "as_of_ts", GOLD_DAY)


def live_trade_bars(root: str) -> BatchTable:
    return BatchTable(root, schemas.with_day(schemas.TRADE_BAR, BAR_DAY), "bar_ts", BAR_DAY)


def live_book_bars(root: str) -> BatchTable:
    return BatchTable(root, schemas.with_day(schemas.BOOK_BAR, BAR_DAY), "bar_ts", BAR_DAY)


def trade_bar_table(root: str) -> VersionedTable:
    return VersionedTable(root, schemas.with_day(schemas.TRADE_BAR, BAR_DAY), "bar_ts", BAR_DAY)


def book_bar_table(root: str) -> VersionedTable:
    return VersionedTable(root, schemas.with_day(schemas.BOOK_BAR, BAR_DAY), "bar_ts", BAR_DAY)


def progress_table(target: VersionedTable) -> VersionedTable:
    """Where the progress of a gold table is kept: one row per product and version."""
    schema = schemas.with_day(schemas.PROGRESS, BAR_DAY)
    return VersionedTable(f"{target.root.rstrip('/')}-progress", schema, "bars_to", BAR_DAY)


@dataclass(frozen=True)
class BuildReport:
    rows_before: int
    rows_added: int
    low_coverage: int = 0

    @property
    def rows_total(self) -> int:
        return self.rows_before + self.rows_added


def _first_seen(step: Column, spec: BarSpec) -> Column:
    """The instant after which bars count for grid points from ``step`` on."""
    return step_time(step - spec.history, spec.step_us)


def scanned_progress(
    book: DataFrame, built: DataFrame | None = None, spec: BarSpec = BarSpec()
) -> DataFrame:
    """Progress worked out from whole tables, for a gold table that has none yet."""
    bounds = gold.grid_bounds(book, spec).select("product_id", "start_step")
    ends = book.groupBy("product_id").agg(F.max("bar_ts").alias("bars_to"))
    found = bounds.join(ends, "product_id")
    if built is None:
        found = found.withColumns({"_high": F.lit(None).cast("long"), "rows": F.lit(0).cast("long")})
    else:
        have = built.groupBy("product_id").agg(
            F.max(step_ceil("as_of_ts", spec.step_us)).alias("_high"), F.count("*").alias("rows")
        )
        found = found.join(have, "product_id", "left")
    found = found.select(
        "product_id",
        F.greatest("start_step", F.col("_high") + 1).alias("next_step"),
        "bars_to",
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
    )
    return _with_base(found, book.select("product_id", "bar_ts", "mid_close"), spec)


def _with_base(progress: DataFrame, bars: DataFrame, spec: BarSpec) -> DataFrame:
    """Add the newest bar that lies before everything pending grid points see."""
    lo = progress.select("product_id", _first_seen(F.col("next_step"), spec).alias("_lo"))
    older = bars.join(lo, "product_id").where("bar_ts <= _lo")
    base = older.groupBy("product_id").agg(
        F.max("bar_ts").alias("base_ts"), F.max_by("mid_close", "bar_ts").alias("base_mid")
    )
    return progress.join(base, "product_id", "left").select(*[f.name for f in schemas.PROGRESS])


def newest(progress: DataFrame) -> datetime | None:
    return progress.agg(F.max("bars_to")).first()[0]


def pending_products(
    book: DataFrame, progress: DataFrame, spec: BarSpec = BarSpec(), lookback: timedelta = LOOKBACK
) -> DataFrame:
    """Progress of all products with ``start_step``, ``end_step`` and ``lo``: the instant
    after which their bars are needed. Pending are those that start at or before the end.

    Bars newer than the newest one seen less ``lookback`` are looked at; of a product
    that is new, only those count.
    """
    top = newest(progress)
    fresh = book if top is None else since(book, "bar_ts", BAR_DAY, top - lookback)
    fresh = fresh.groupBy("product_id").agg(
        F.min("bar_ts").alias("_first"), F.max("bar_ts").alias("_last")
    )
    own = _first_seen(F.col("next_step"), spec)
    begun = floor_div(micros("_first"), spec.step_us) + spec.history + 1
    end = floor_div(micros(F.greatest("_last", "bars_to")), spec.step_us) - spec.label_horizon
    before_all = F.col("_first") - F.make_dt_interval(secs=F.lit(1))
    return progress.join(fresh, "product_id", "full").select(
        "product_id",
        F.coalesce("next_step", begun).alias("start_step"),
        end.alias("end_step"),
        F.coalesce(own, before_all).alias("lo"),
        F.greatest("_last", "bars_to").alias("bars_to"),
        *("base_ts", "base_mid"),
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
    )


@dataclass(frozen=True)
class Reach:
    """How far back scans for pending products go: ``start`` for those whose ``lo`` is at
    ``border`` or later, ``lagging`` for the others, if there are any."""

    start: datetime
    border: datetime
    lagging: datetime | None

    @staticmethod
    def of(todo: DataFrame, lookback: timedelta) -> Reach | None:
        ends = todo.agg(F.min("lo").alias("lo"), F.max("lo").alias("hi")).first()
        if ends.hi is None:
            return None
        border = ends.hi - lookback
        if ends.lo >= border:
            return Reach(ends.lo, border, None)
        recent = todo.where(F.col("lo") >= F.lit(border).cast("timestamp_ntz"))
        return Reach(recent.agg(F.min("lo")).first()[0], border, ends.lo)


def seen_by(
    table: DataFrame, todo: DataFrame, ts_column: str, day_column: str, reach: Reach
) -> DataFrame:
    """Rows of the products in ``todo`` after their own ``lo``, as pruned scans.

    Products whose ``lo`` lies far before the newest one are read by a scan of their own,
    so the others' scan starts at recent days.
    """

    def scan(start: datetime, group: DataFrame) -> DataFrame:
        own = group.select("product_id", F.col("lo").alias("_lo"))
        rows = since(table, ts_column, day_column, start).join(own, "product_id")
        return rows.where(F.col(ts_column) > F.col("_lo")).drop("_lo")

    if reach.lagging is None:
        return scan(reach.start, todo)
    border = F.lit(reach.border).cast("timestamp_ntz")
    recent = scan(reach.start, todo.where(F.col("lo") >= border))
    return recent.unionByName(scan(reach.lagging, todo.where(F.col("lo") < border)))


def _built_since(built: DataFrame, todo: DataFrame, spec: BarSpec, lookback: timedelta) -> DataFrame:
    """Gold rows from the pending grid points of ``todo`` on."""
    late = todo.withColumn("lo", step_time(F.col("start_step") - 1, spec.step_us))
    return seen_by(built, late, "as_of_ts", GOLD_DAY, Reach.of(late, lookback))


@dataclass(frozen=True)
class Pending:
    """What a refresh has to do: products with bounds, and the bars they need."""

    products: DataFrame
    todo: DataFrame
    book: DataFrame
    trade: DataFrame

    def rows(self, spec: BarSpec = BarSpec(), built_at: Column | None = None) -> DataFrame:
        """The gold rows that are not there yet."""
        us = spec.step_us
        bounds = self.todo.select(
            *("product_id", "start_step", "end_step"),
            step_time("start_step", us).alias("start_ts"),
            step_time("end_step", us).alias("end_ts"),
        )
        return gold.gold(self.book, self.trade, spec, bounds=bounds, built_at=built_at)


def pending(
    book: DataFrame,
    trade: DataFrame,
    progress: DataFrame,
    built: DataFrame | None = None,
    spec: BarSpec = BarSpec(),
    lookback: timedelta = LOOKBACK,
) -> Pending | None:
    """What ``progress`` lacks; None when it is complete.

    ``built`` is the gold table where rows may be newer than the progress, as after a
    build that ended before it could commit it; only days that could hold such are read.
    """
    products = materialize(pending_products(book, progress, spec, lookback), "gold-todo")
    todo = products.where("start_step <= end_step")
    reach = Reach.of(todo, lookback)
    if built is not None and reach:
        have = _built_since(built, todo, spec, lookback).groupBy("product_id").agg(
            F.max(step_floor("as_of_ts", spec.step_us)).alias("_high"), F.count("*").alias("_more")
        )
        ahead = F.greatest("start_step", F.col("_high") + 1)
        rows = F.col("rows") + F.coalesce("_more", F.lit(0))
        products = products.join(have, "product_id", "left")
        products = products.withColumns({"start_step": ahead, "rows": rows}).drop("_high", "_more")
        products = materialize(products, "gold-todo")
        todo = products.where("start_step <= end_step")
        reach = Reach.of(todo, lookback)
    if reach is None:
        return None
    # The bar before everything that is needed: only its price matters.
    base = todo.where("base_ts IS NOT NULL").select(
        "product_id", F.col("base_ts").alias("bar_ts"), F.col("base_mid").alias("mid_close")
    )
    recent = seen_by(book, todo, "bar_ts", BAR_DAY, reach)
    return Pending(
        products,
        todo,
        recent.unionByName(base, allowMissingColumns=True),
        seen_by(trade, todo, "bar_ts", BAR_DAY, reach),
    )


def advanced(work: Pending, added: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """The progress after a build that added rows; idle products keep theirs."""
    counts = added.groupBy("product_id").agg(
        F.count("*").alias("_n"), F.max(step_floor("as_of_ts", spec.step_us)).alias("_high")
    )
    done = work.todo.join(counts, "product_id", "left").select(
        "product_id",
        F.coalesce(F.col("_high") + 1, "start_step").alias("next_step"),
        "bars_to",
        (F.col("rows") + F.coalesce("_n", F.lit(0))).alias("rows"),
    )
    done = _with_base(done, work.book.select("product_id", "bar_ts", "mid_close"), spec)
    idle = work.products.where("start_step > end_step").withColumnRenamed("start_step", "next_step")
    return done.unionByName(idle.select(done.columns))


def checked(added: DataFrame, built: DataFrame | None, work: Pending, spec: BarSpec) -> int:
    """Raise where added rows are corrupt or there already; return the low-coverage count."""
    low = quality.require_gold_quality(added, spec)
    if built is not None:
        keys = ["product_id", "as_of_ts"]
        there = _built_since(built, work.todo, spec, LOOKBACK).select(*keys)
        if not added.join(there, keys, "left_semi").isEmpty():
            raise quality.QualityError("gold corrupt: rows are built already")
    return low


def refresh(
    spark: SparkSession,
    book: VersionedTable | BatchTable,
    trade: VersionedTable | BatchTable,
    target: VersionedTable,
    spec: BarSpec = BarSpec(),
    built_at=None,
    lookback: timedelta = LOOKBACK,
) -> BuildReport:
    """Extend the gold table by checked rows. Running it again adds nothing.

    Rows are checked before they are added, and the progress is committed after them;
    if that fails, the next refresh finds the added rows in the gold table.
    """
    store = progress_table(target)
    built = target.read(spark) if target.versions(spark) else None
    books = book.read(spark)
    if store.versions(spark):
        progress, known = store.read(spark).select(*[f.name for f in schemas.PROGRESS]), built
    else:
        progress, known = materialize(scanned_progress(books, built, spec), "gold-progress"), None
    before = progress.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    work = pending(books, trade.read(spark), progress, known, spec, lookback)
    if work is None:
        if known is None:
            store.publish(progress)
        return BuildReport(before, 0)
    before = work.products.agg(F.sum("rows")).first()[0]
    added = materialize(work.rows(spec, built_at), "gold-added")
    low = checked(added, known, work, spec)
    target.append(added)
    store.publish(materialize(advanced(work, added, spec), "gold-progress"))
    store.retain(spark, keep=2)
    return BuildReport(before, added.count(), low)


def start_over(spark: SparkSession, *tables: VersionedTable | BatchTable) -> None:
    """Empty bar tables and what is derived from them, always together: a replay
    need not reproduce every bar at the edges of lateness."""
    for table in tables:
        table.reset(spark)
        if isinstance(table, VersionedTable) and progress_table(table).versions(spark):
            progress_table(table).reset(spark)
