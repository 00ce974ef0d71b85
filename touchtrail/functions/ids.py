"""Surrogate keys: M2."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*natural_key: str) -> Column:
    """A text key per row.

    Without arguments a random UUID, new on every run.  With column names the digest of
    their values: the same row keeps its key over reruns, backfills and task retries.  Each value
    is written behind its length and a missing one as a dash, so no two keys read alike.
    """
    if not natural_key:
        return F.uuid()
    texts = [F.col(c).cast("string") for c in natural_key]
    told = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told), 256)
