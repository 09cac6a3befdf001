"""Intermediate tables in the shared folder that the cluster names: Parquet
that any executor can read again, so a lost executor costs a re-read."""

from __future__ import annotations

from ..session import fresh_path, release, settled, shuffles_dropped, table_scope
from ..session import materialize as materialise

__all__ = ["fresh_path", "materialise", "release", "settled", "shuffles_dropped", "table_scope"]
