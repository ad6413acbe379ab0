"""Batch source entry point (S-01, S-02, F-09 object-mode rule)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..catalog import CatalogError


def read_source(catalog, obj: str | None = None, query=None, *, include_deleted: bool = False,
                since=None, until=None, as_of=None, duration=None, offset=None, schema=None) -> DataFrame:
    """Read one source: a query (``ObjectQuery``) when given — it wins over
    ``obj`` and is read as written, so the time-filter options do not apply —
    else the whole object with the time filters (object mode).  Neither is an
    error."""
    if query is not None:
        q = query.include_deleted(include_deleted) if include_deleted else query
        return q.to_df()
    if obj is None:
        raise CatalogError("Either a query or an object name is needed")
    return catalog.object(obj, since=since, until=until, as_of=as_of, duration=duration, offset=offset,
                          schema=schema, include_deleted=include_deleted)
