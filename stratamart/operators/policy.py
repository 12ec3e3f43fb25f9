"""Row access policies."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the grantee every signed-in principal belongs to.
EVERYONE = "allAuthenticatedUsers"


@dataclass(frozen=True)
class RowPolicy:
    name: str
    grantees: tuple[str, ...]
    predicate: str


def apply_row_policies(df: DataFrame, principal: str, policies: list[RowPolicy]) -> DataFrame:
    """Rows allowed by at least one of the principal's policies.

    A table without policies is open; on a table with policies, a principal
    that none of them names sees nothing.
    """
    if not policies:
        return df
    mine = [F.expr(p.predicate) for p in policies if principal in p.grantees or EVERYONE in p.grantees]
    return df.where(reduce(lambda a, b: a | b, mine) if mine else F.lit(False))
