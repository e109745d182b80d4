"""Query catalog over the driver tables.

Each entry runs one operator of the library on whole tables (no id subsets,
no row caps) and has, where SQL can express it, an equivalent DuckDB query
with the same column names. ``QUERIES[name](spark, sf_dir) -> DataFrame``;
``ORACLES[name] -> str``.
"""

from __future__ import annotations

from . import (q_assignment, q_campaign, q_consolidation, q_contacts, q_io,  # noqa: F401
               q_reshape, q_touch)
from .registry import ORACLES, QUERIES, register  # noqa: F401
