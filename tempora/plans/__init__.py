"""Registered queries and their SQL."""

from . import assembly_queries, card_queries, check_queries, contract_queries, curve_queries, event_queries, feature_queries, hint_queries, refine_queries, record_queries, section_queries, signal_queries, symbolic_queries, text_queries, timeline_queries, track_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
