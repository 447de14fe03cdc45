"""Run settings, passed explicitly to every operator that needs them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RunConfig:
    """Settings of one run.

    ``snapshot`` is the fixed "today" of the run. It is never taken from the
    clock: a moving date would let later orders leak into features and labels.
    """

    snapshot: str = "2024-12-31"
    churn_window_days: int = 90
    score_bins: int = 5
    horizon_months: int = 12
    test_share: float = 0.2
    top_share: float = 0.1
    seed: int = 42
    min_customers: int = 1_000
    penalizer: float = 0.01
    # A property of the orders, not looked up in them: every order date is a midnight, so gaps add up to the span.
    orders_at_midnight: bool = False

    @property
    def horizon_days(self) -> int:
        """Prediction horizon; a month counts 30 days."""
        return self.horizon_months * 30


@dataclass(frozen=True)
class JdbcSource:
    """Where to read the orders table from, and how to split the read.

    ``partition_column`` should be evenly spread and numeric, date or timestamp;
    the order id is the default because one customer may own most of the rows.
    Bounds that are not given are the column's least and greatest value, which
    the database is asked for. Rows beyond given bounds are read, by the outer
    parts. Where the column is text, or few of its values own most rows, let
    ``split`` be ``hash`` (parts by a hash that the database computes) or
    ``counts`` (bounds with equally many rows between them, asked of the
    database by one sorted query).
    """

    url: str
    table: str = "orders"
    partition_column: str = "order_id"
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    num_partitions: int = 64
    fetch_size: int = 10_000
    split: str = "range"
    properties: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class SyntheticSource:
    """Size of a generated orders table."""

    orders: int = 50_000
    customers: int = 8_000
    partitions: int | None = None


@dataclass(frozen=True)
class ClassifierConfig:
    """Boosting budget of the churn classifier."""

    trees: int = 400
    depth: int = 5
    learning_rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    validation_share: float = 0.1
    # Rounds without a higher area under the curve of the validation slice after which boosting ends.
    patience: int = 30
    checkpoint_interval: int = 10
    max_memory_mb: int = 256
