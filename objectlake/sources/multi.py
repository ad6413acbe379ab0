"""Multi-object selection rules (S-04, S-05)."""

from __future__ import annotations

from collections.abc import Iterable

from ..catalog import CatalogError


def _names(v: str | Iterable[str] | None) -> list[str]:
    if v is None:
        return []
    if isinstance(v, str):
        return [s.strip() for s in v.split(",") if s.strip()]
    return [s.strip() for s in v if s and s.strip()]


def validate_names(catalog, allow, deny) -> list[str]:
    """S-05: names in the allow or deny list that are not queryable objects."""
    queryable = {n.lower() for n in catalog.names(queryable_only=True)}
    return [f"Object '{n}' is not queryable or does not exist"
            for n in _names(allow) + _names(deny) if n.lower() not in queryable]


def select_objects(catalog, allow=None, deny=None) -> list[str]:
    """S-04: queryable ∧ (allow empty ∨ in allow) ∧ not in deny; empty → error."""
    failures = validate_names(catalog, allow, deny)
    if failures:
        raise CatalogError("; ".join(failures), failures)
    allow_l = {n.lower() for n in _names(allow)}
    deny_l = {n.lower() for n in _names(deny)}
    chosen = [n for n in catalog.names(queryable_only=True)
              if (not allow_l or n.lower() in allow_l) and n.lower() not in deny_l]
    if not chosen:
        raise CatalogError("No objects left to read after applying the allow and deny lists")
    return chosen
