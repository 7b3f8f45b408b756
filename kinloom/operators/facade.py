"""Merging with history: clusters to golden records, every merge recorded, undone and audited over three tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import survivorship, versioning


class Merges:
    """The operations, versions and links so far; ``None`` where nothing was merged yet. Every method returns new frames
    and keeps them; storing them is the caller's choice."""

    def __init__(self, user: str, ops: DataFrame | None = None, versions: DataFrame | None = None, links: DataFrame | None = None):
        self.user, self.ops, self.versions, self.links = user, ops, versions, links

    def merge(self, df: DataFrame, at: Column, strategy: str = "most_complete") -> DataFrame:
        """Golden records and singletons of a clustered table, its merges recorded."""
        golden, _ = survivorship.merge_all(df, strategy)
        last = self.ops.agg(F.max("operation_id")).first()[0] or 0 if self.ops is not None else 0
        made = versioning.record_merges(df, golden, self.user, at, last)
        old = (self.ops, self.versions, self.links)
        self.ops, self.versions, self.links = (n if o is None else o.unionByName(n) for o, n in zip(old, made, strict=True))
        return golden

    def undo(self, operation_id: int, at: Column, schema: str) -> dict:
        """What came of undoing one merge: success with the restored records, or the error."""
        if self.ops is None:
            return {"success": False, "error": "nothing was merged"}
        made, restored = versioning.undo(self.ops, self.versions, F.col("operation_id") == operation_id, self.user, at, schema)
        if made.isEmpty():
            return {"success": False, "error": f"operation {operation_id} is no merge that could be undone"}
        self.ops = self.ops.unionByName(made)
        return {"success": True, "restored": restored}

    def history(self, **which) -> DataFrame | None:
        return None if self.ops is None else versioning.history(self.ops, self.links, **which)

    def audit_trail(self, **which) -> DataFrame | None:
        return None if self.ops is None else versioning.audit_trail(self.ops, self.links, **which)
