"""What a metadata job needs to know about a table besides its rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class TableSpec:
    dataset: str
    name: str
    df: DataFrame
    kind: str = "BASE TABLE"
    labels: dict[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    cluster_columns: tuple[str, ...] = ()
    description: str | None = None
    friendly_name: str | None = None
    require_partition_filter: bool = False

    @property
    def is_view(self) -> bool:
        return self.kind == "VIEW"
