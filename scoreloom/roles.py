"""The data object handed through the stages: a DataFrame and its column roles."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

NUMERIC = "numeric"
FACTOR = "factor"


@dataclass(frozen=True)
class Dataset:
    """A table with declared column types and the id and target roles."""

    df: DataFrame
    types: dict[str, str]
    id: str | None = None
    target: str | None = None
    removed: tuple[str, ...] = field(default_factory=tuple)

    @property
    def variables(self) -> list[str]:
        return [c for c in self.types if c not in (self.id, self.target)]

    @property
    def numeric(self) -> list[str]:
        return [c for c in self.variables if self.types[c] == NUMERIC]

    @property
    def factors(self) -> list[str]:
        return [c for c in self.variables if self.types[c] == FACTOR]

    def with_df(self, df: DataFrame) -> "Dataset":
        return replace(self, df=df)

    def without(self, names: Iterable[str]) -> "Dataset":
        gone = set(names)
        return replace(
            self,
            df=self.df.drop(*[c for c in self.df.columns if c in gone]),
            types={c: t for c, t in self.types.items() if c not in gone},
            removed=self.removed + tuple(sorted(gone)),
        )
