"""DataFrame -> DataFrame operators. None of them collects data rows; only ``keys.dense_key`` triggers a job."""

from starloom.operators import archive, dedupe, dims, facts, keys, lookup, marts, quality, scd2

__all__ = ["archive", "dedupe", "dims", "facts", "keys", "lookup", "marts", "quality", "scd2"]
