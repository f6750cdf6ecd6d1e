"""Structured Streaming: incremental loads of new extract files."""

from .incremental import (completeness_so_far, key_uniqueness_so_far, load_counts, load_table, process_batch,
                          read_dim_prod, read_fact, read_rejects, read_table, run_incremental)

__all__ = ["completeness_so_far", "key_uniqueness_so_far", "load_counts", "load_table", "process_batch", "read_dim_prod",
           "read_fact", "read_rejects", "read_table", "run_incremental"]
