"""The queries of this subpackage and, where SQL can express one, its DuckDB
twin. The modules fill both when :mod:`recaudo.llm.queries` imports them."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco
