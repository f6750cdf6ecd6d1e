"""Reusable DataFrame operators the star builder is made of."""

from .dense_keys import dense_key, extend_key, first_seen_key, number_rows
from .lookup import bounded_broadcast, hot_keys, last_wins, lookup_key
from .single_valued import single_valued

__all__ = ["dense_key", "extend_key", "first_seen_key", "number_rows", "bounded_broadcast", "hot_keys",
           "last_wins", "lookup_key", "single_valued"]
