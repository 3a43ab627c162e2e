"""Settings of the three plans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, fields

from scoreloom.sources.delimited import MISSING_SPELLINGS

ALGORITHMS = ("DL", "LR", "GBM", "NB", "RF", "Stacking", "KM")


@dataclass
class LearnConfig:
    """What to read, how to prepare it and what to train.

    Exactly one of ``table`` (catalog) and ``path`` (delimited text) names the
    data unless a DataFrame is handed over. ``types`` is the column dictionary;
    ``dictionary_path`` reads it from a file instead.
    """

    table: str | None = None
    path: str | None = None
    types: dict[str, str] | None = None
    dictionary_path: str | None = None
    numeric_aliases: Sequence[str] = ()
    factor_aliases: Sequence[str] = ()
    separator: str = ","
    missing: Sequence[str] = MISSING_SPELLINGS

    id_name: str | None = None
    target_name: str | None = None

    profile: bool = True
    profile_sampling: float | int | str | None = None
    max_factor_levels: float = 1000
    max_variable_missing: float = 0.9
    max_sample_missing: float = 0.95
    sampling_method: str | None = None
    unbalanced_cutoff: float = 5
    fill: dict[str, object] = field(default_factory=dict)
    calculate_iv: bool = False
    reduce_levels_above: int | None = None
    seed: int = 1

    algorithm: str = "LR"
    hparams: dict | None = None
    cv_k: int | None = None

    def __post_init__(self) -> None:
        if self.algorithm not in ALGORITHMS:
            raise ValueError(f"unknown algorithm {self.algorithm}, known are {', '.join(ALGORITHMS)}")
        if self.sampling_method not in (None, "undersampling"):
            raise ValueError(f"unknown sampling method {self.sampling_method}")
        if self.algorithm == "KM":
            # clusters have no label, so nothing can be weighed against one
            self.target_name, self.calculate_iv = None, False
        elif self.target_name is None:
            raise ValueError("a classifier needs a target column")
        if self.algorithm == "Stacking" and not self.hparams:
            raise ValueError("stacking needs hparams: one grid (or None) per base algorithm")

    def as_dict(self) -> dict:
        return {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self).items()}

    @classmethod
    def from_dict(cls, values: dict) -> "LearnConfig":
        known = {f.name for f in fields(cls)}
        unknown = set(values) - known
        if unknown:
            raise ValueError(f"unknown settings {sorted(unknown)}")
        return cls(**values)
