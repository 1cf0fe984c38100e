"""Job parameters. Column lists are parameters: no default feature list exists."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SeriesConfig:
    """Irregular observations → regular series → split and packed series."""

    item: str = "item"
    ts: str = "ts"
    units: str = "units"
    freq: str = "D"
    how: str = "sum"
    min_bins: int = 29
    train_share: float = 0.85
    context: int = 28
    horizon: int = 28
    quantile: float = 0.5
    stride: int = 1
    season: int = 7
    unseen_code: int = 100
    view: str = "distributor_view"
    preferred_view: str = "Manufacturing"
    period: str = "period"
    period_value: str = "DAILY"
    rmse_gate: float = 8.0


@dataclass(frozen=True)
class TabularConfig:
    """Campaign rows → encoded features → boosted trees."""

    target: str
    features: tuple[str, ...]
    date: str = "date"
    encode: tuple[str, ...] = ("asin", "ad_group_name")
    # A unique column; None numbers the rows by their content.
    row_key: str | None = "row_id"
    train_percent: int = 70
    val_percent: int = 20
    seed: int = 1729
    oversample: int = 8
    rounds: int = 150
    trials: int = 5
    outlier_column: str = "spend"
    outlier_limit: float = 500.0
    outlier_share: float = 0.2
    rmse_gate: float = 12.0
    renames: dict = field(
        default_factory=lambda: {"advertised_asin": "asin", "closest_cluster": "Cluster"}
    )


@dataclass(frozen=True)
class AutoForecastConfig:
    """Mean-resampled series → candidate forecasts → best by a backtest metric."""

    item: str = "item"
    ts: str = "ts"
    units: str = "units"
    flag: str | None = None
    freq: str = "D"
    min_bins: int = 300
    cutoff: str = "2022-12-31"
    horizon: int = 24
    context: int = 28
    season: int = 7
    # Whether smoothing with level, trend and season, fitted per item, is a candidate.
    states: bool = True
    # Whether the autoregression per item is one.
    autoregression: bool = True
    # Whether the piecewise trend with a Fourier season is one.
    trend: bool = True
    # Whether the quantile model over all items is a candidate beside the statistical ones.
    global_model: bool = True
    # Windows of the backtest, and the bins between their starts (the horizon unless given).
    backtest_windows: int = 1
    backtest_stride: int | None = None
    metric: str = "wape"
    rmse_gate: float = 30.0
