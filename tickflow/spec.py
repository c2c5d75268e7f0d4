"""Sizes and thresholds. Everything data-dependent is a parameter."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BarSpec:
    """Shape of bars, of the feature grid on top of them, and of the label.

    Horizons are counted in grid steps, which makes every window edge fall on a
    grid point: that is what allows features to be built from per-step partial
    aggregates (see ``operators.gold``).
    """

    # Fixed values of the feature definition.
    bar_seconds: int = 1
    step_seconds: int = 60
    horizons: tuple[int, ...] = (1, 5, 15, 60)
    flow_horizon: int = 5
    label_horizon: int = 5
    train_coverage: int = 290
    serve_coverage: int = 250
    min_train_rows: int = 60
    test_fraction: float = 0.2
    promotion_min_skill: float = 0.0

    # Ordered work on one product is cut into chunks of this many grid steps,
    # so a hot product spreads over many tasks (1,440 one-minute steps = a day).
    chunk_steps: int = 1440

    def __post_init__(self) -> None:
        whole = (*self.horizons, self.flow_horizon, self.label_horizon, self.chunk_steps)
        if any(not isinstance(h, int) or h < 1 for h in whole):
            raise ValueError("horizons must be positive whole numbers of grid steps")
        if self.flow_horizon > self.history:
            raise ValueError("flow_horizon may not exceed the longest horizon")
        if self.chunk_steps < self.history + self.label_horizon:
            raise ValueError("chunk_steps must cover the longest window plus the label")
        if self.step_seconds % self.bar_seconds:
            raise ValueError("step_seconds must be a multiple of bar_seconds")

    @property
    def history(self) -> int:
        return max(self.horizons)

    @property
    def step_us(self) -> int:
        return self.step_seconds * 1_000_000

    @property
    def label_seconds(self) -> int:
        return self.label_horizon * self.step_seconds


@dataclass(frozen=True)
class FeedSpec:
    """Raw feed limits and chunking of the arrival order."""

    # Fixed values of the feed contract.
    max_message_bytes: int = 10 * 1024 * 1024
    truncated_bytes: int = 1024
    depth_levels: int = 5
    watermark: str = "30 seconds"
    sync_margin_seconds: int = 2
    idle_seconds: int = 5
    history_ttl_seconds: int = 7200

    # Arrival numbers per chunk. Arrival numbers are unique, so this bounds the
    # rows that any one ordered task holds; a book replay holds about as many changes,
    # or as many as the book has levels where that is more.
    chunk_rows: int = 1 << 17

    @property
    def bucket_rows(self) -> int:
        """Arrival numbers per bucket, which book chunks are put together from."""
        return max(min(self.chunk_rows // 8, 1 << 20), 1)
