"""Run parameters, grouped the way a run uses them."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields

# Readings that mean "no measurement" in the raw telemetry.
SENTINELS = (99, 999, 9999, 99999)


@dataclass(frozen=True)
class Columns:
    station: str = "STATION"
    timestamp: str = "DATE"
    numeric: tuple[str, ...] = ()
    directional: tuple[str, ...] = ()
    width: str = "1h"


@dataclass(frozen=True)
class Quality:
    small_gap: int = 2
    medium_gap: int = 6
    drop_large_gap_rows: bool = False
    clip_low: float = 0.005
    clip_high: float = 0.995
    sentinels: tuple[float, ...] = SENTINELS


@dataclass(frozen=True)
class Windows:
    multiscale: bool = True
    size: int = 12
    step: int = 6
    stats: tuple[str, ...] = ("mean", "std", "min", "max")
    scales: tuple[int, ...] = (6, 24, 72)
    stride: int = 3


@dataclass(frozen=True)
class Models:
    candidates: tuple[int, ...] = (2, 3, 4, 5)
    seed: int = 42
    restarts: int = 20
    min_segment: int = 3
    super_regimes: int = 3
    hmm_iterations: int = 300
    hmm_tolerance: float = 1e-2
    latent_dim: int = 32
    boundary_tolerance: int = 2
    changepoint_penalty: float = 8.0
    changepoint_search: str = "landmarks"  # or "pairs", which compares every two rows that are searched together
    changepoint_segment: int | None = None  # with "pairs", rows searched together; None: whole series
    changepoint_bandwidth: float | None = None  # None: the median squared distance, of a sample or of all pairs
    silhouette: str = "sampled"  # judged points against all; or "squared"; or "exact", which compares all pairs


@dataclass(frozen=True)
class Params:
    columns: Columns = field(default_factory=Columns)
    quality: Quality = field(default_factory=Quality)
    windows: Windows = field(default_factory=Windows)
    models: Models = field(default_factory=Models)

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, raw: dict) -> "Params":
        """Build from nested mappings such as a parsed YAML or JSON file; absent keys keep defaults."""

        def load(section_type, values):
            known = {f.name for f in fields(section_type)}
            unknown = set(values) - known
            if unknown:
                raise ValueError(f"unknown settings for {section_type.__name__}: {sorted(unknown)}")
            clean = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items()}
            return section_type(**clean)

        sections = {"columns": Columns, "quality": Quality, "windows": Windows, "models": Models}
        return cls(**{name: load(kind, raw.get(name, {})) for name, kind in sections.items()})
