"""Imports every operator, which registers its query."""

from . import (chat, exact_dedup, html_text, mixing, near_dedup, period_runs, pii, quality, secret_scan, sentencepieces,  # noqa: F401
               token_alignment, toxicity, vp_search)
from .registry import ORACLES, QUERIES  # noqa: F401
