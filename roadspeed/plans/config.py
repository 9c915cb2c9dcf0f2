"""Settings of the pipelines."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from roadspeed.functions import micros

# The road links kept in silver.
DEFAULT_LINKS = (
    "1920161400", "1920161500", "1920121301", "1920121401", "1920161902", "1920162205", "1920162400",
    "1920000702", "1920000801", "1920121000", "1920121302", "1920121402", "1920235801", "1920189001",
    "1920139400", "1920161801", "1920162207", "1920162304", "1920162500", "1920171200", "1920171600",
    "1920188900", "1920138500",
)


@dataclass(frozen=True)
class LakeConfig:
    """Places of one lake. Without ``jdbc`` gold is a day-partitioned Parquet table.

    With ``versioned`` bronze, silver and Parquet gold are tables of versioned days, so readers never see half a write.
    """

    archives: str
    base: str
    links: tuple[str, ...] | None = DEFAULT_LINKS
    step: str = "5 minutes"
    encoding: str = "UTF-8"
    versioned: bool = False
    drop_invalid_time: bool = True
    # A number fixes the files per day. None keeps the scan's splits (bronze) or lets Spark size them (silver).
    bronze_files_per_day: int | None = None
    silver_files_per_day: int | None = None
    bucket: str = "lake"
    kafka_servers: str | None = None
    kafka_topic: str = "raw_files"
    jdbc: dict[str, str] | None = None
    jdbc_slices_per_day: int = 1

    def zone(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"


@dataclass(frozen=True)
class TrainConfig:
    """Settings of the forecasting data and model. ``value`` is forecast from the past of ``channels``."""

    # Window and horizon, split, threshold and trailing days.
    seq_len: int = 36
    horizon: int = 1
    val_days: int = 30
    train_frac: float = 0.8
    step: str = "5 minutes"
    width: str = "31 minutes"
    chunk: str | None = None
    threshold_pct: float = 25.0
    window_days: int = 30
    rounds: int = 12
    patience: int | None = 4
    channels: tuple[str, ...] = ("self_mean",)
    value: str = "self_mean"

    @property
    def measures(self) -> list[str]:
        """The columns that are filled and scaled."""
        return list(dict.fromkeys([*self.channels, self.value]))

    @property
    def own_channel(self) -> int:
        """The place of ``value`` among the channels, whose last value is the first guess; the first if it is none."""
        return self.channels.index(self.value) if self.value in self.channels else 0

    @property
    def span(self) -> timedelta:
        """Time chunk for windows: ``chunk``, or some windows' worth of steps, so that a chunk is no single row."""
        rows = max(288, 8 * self.seq_len)
        return timedelta(microseconds=micros(self.chunk) if self.chunk else micros(self.step) * rows)
