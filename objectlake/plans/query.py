"""``ObjectQuery``: a query over one object compiled to a single DataFrame plan.

The query shape of the reference (object, ordered fields with aliases, parent
paths, one level of child sub-queries, WHERE / GROUP BY / ROLLUP / CUBE /
HAVING / ORDER BY / LIMIT / OFFSET, scopes and data categories) is kept as a
spec; :meth:`ObjectQuery.to_df` turns it into joins, filters and aggregates.

Plan shape, chosen for scale:

* one ``left`` join per distinct reference-path prefix, each parent side
  pruned to the fields used; Spark broadcasts it when its measured size is
  under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time)
  and otherwise shuffles both sides, with AQE splitting skewed keys;
* ``IN (query)`` is a left-semi join; ``NOT IN (query)`` is a left-anti join
  plus one scalar sub-query carrying the SQL null rule, so it stays an equi
  join instead of a nested-loop null-aware join;
* child sub-queries aggregate the child table by its foreign key *before* the
  join (partial aggregation map-side), and a per-parent LIMIT is a
  ``row_number() <= n`` filter that Spark turns into a map-side group limit,
  so a parent holding a third of all children still ships only ``n`` rows
  per map task.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import Catalog, CatalogError
from ..functions.aggregates import AggExpr, GroupingExpr
from ..functions.expr import Expr, FieldRef, SortKey, SubqueryIn, as_expr, as_item, conjuncts, fld
from ..functions.timefilter import modified_filter
from ..naming import column, normalize_name, quote


class QueryError(CatalogError):
    pass


@dataclass
class ChildSpec:
    relationship: str
    select: list = field(default_factory=list)
    where: Expr | None = None
    order_by: list = field(default_factory=list)
    limit: int | None = None
    offset: int | None = None
    flat: bool = False
    alias: str | None = None
    piece_rows: int | None = None


def _sort_keys(items) -> list[SortKey]:
    out = []
    for it in items:
        if isinstance(it, SortKey):
            out.append(it)
        elif isinstance(it, tuple):
            e = as_item(it[0])
            direction = (it[1] if len(it) > 1 else "asc").lower()
            nulls = it[2] if len(it) > 2 else "first"
            out.append(e.desc(nulls) if direction == "desc" else e.asc(nulls))
        else:
            out.append(as_item(it).asc())
    return out


class _Resolver:
    """Maps field paths to columns of the joined rows (before aggregation)."""

    def __init__(self, query: ObjectQuery, df: DataFrame | None = None):
        self.q = query
        self.catalog = query.catalog
        self.df = df
        self.substitutes: dict[str, Column] = {}
        self.params = dict(getattr(query, "_params", {}))

    # path → (tuple of relationship names in catalog case, field name)
    def split(self, path: str) -> tuple[tuple[str, ...], str]:
        parts = path.split(".")
        obj = self.q.obj_name
        # P-04: a leading object name or query alias (exact case) is dropped.
        if len(parts) > 1 and (parts[0] == obj or (self.q.obj_alias and parts[0] == self.q.obj_alias)):
            parts = parts[1:]
        rels: list[str] = []
        cur = obj
        for p in parts[:-1]:
            ref = self.catalog.reference(cur, p)
            rels.append(ref.name)
            cur = ref.target
        return tuple(rels), self.catalog.field_name(cur, parts[-1])

    def target_of(self, rels: tuple[str, ...]) -> str:
        cur = self.q.obj_name
        for r in rels:
            cur = self.catalog.reference(cur, r).target
        return cur

    def internal(self, path: str) -> str:
        rels, f = self.split(path)
        return ".".join(rels + (f,))

    def field(self, path: str) -> Column:
        return column(self.internal(path))

    def lookup(self, expr: Expr) -> Column | None:
        return self.substitutes.get(expr.key)

    def agg(self, expr: AggExpr) -> Column:
        raise QueryError(f"Aggregate {expr.key} is not allowed here")

    def grouping(self, expr: GroupingExpr) -> Column:
        raise QueryError(f"{expr.key} needs GROUP BY ROLLUP or CUBE")

    def data_type(self, c: Column) -> T.DataType:
        return self.df.select(c).schema.fields[0].dataType


class _PostResolver(_Resolver):
    """Resolves expressions over aggregated rows: group keys and aggregates."""

    def __init__(self, query, df, group_keys: dict[str, str], agg_keys: dict[str, str],
                 pre: _Resolver):
        super().__init__(query, df)
        self.group_keys, self.agg_keys, self.pre = group_keys, agg_keys, pre

    def lookup(self, expr: Expr) -> Column | None:
        if expr.key in self.agg_keys:
            return F.col(self.agg_keys[expr.key])
        if expr.key in self.group_keys:
            return F.col(self.group_keys[expr.key])
        if isinstance(expr, FieldRef):
            # a grouped path written with different case or object prefix
            k = self.pre.internal(expr.path)
            for gk, name in self.group_keys.items():
                if gk.startswith("path:") and gk[5:] == k:
                    return F.col(name)
        return None

    def field(self, path: str) -> Column:
        raise QueryError(f"Field '{path}' is neither grouped nor aggregated")

    def agg(self, expr: AggExpr) -> Column:
        return F.col(self.agg_keys[expr.key])


class ObjectQuery:
    """Query spec over one catalog object; every method returns a new spec."""

    def __init__(self, catalog: Catalog, obj: str, alias: str | None = None,
                 strict_aliases: bool = True):
        self.catalog = catalog
        self.obj_name = catalog.get(obj).name
        self.obj_alias = alias
        self.strict_aliases = strict_aliases
        self._select: list[Expr] = []
        self._where: list[Expr] = []
        self._group: list[Expr] = []
        self._group_mode: str | None = None
        self._having: Expr | None = None
        self._order: list[SortKey] = []
        self._limit: int | None = None
        self._offset: int | None = None
        self._include_deleted = False
        self._time: dict = {}
        self._scopes: list[str] = []
        self._categories: list[tuple[str, str, list[str]]] = []
        self._with_filter = False
        self._types_only = False     # compile for the schema: nothing may run
        self._children: list[ChildSpec] = []
        self._params: dict = {}

    def _copy(self) -> ObjectQuery:
        q = copy.copy(self)
        for a in ("_select", "_where", "_group", "_order", "_scopes", "_categories", "_children"):
            setattr(q, a, list(getattr(self, a)))
        q._time = dict(self._time)
        q._params = dict(self._params)
        return q

    def bind(self, **values) -> ObjectQuery:
        """F-15: values for ``param(name)`` placeholders."""
        q = self._copy()
        q._params.update(values)
        return q

    # ------------------------------------------------------------ builders
    def select(self, *items) -> ObjectQuery:
        """P-01: ordered fields; strings are field paths."""
        q = self._copy()
        q._select += [as_item(i) for i in items]
        return q

    def where(self, cond) -> ObjectQuery:
        q = self._copy()
        q._where.append(as_expr(cond))
        return q

    filter = where

    def with_filter(self, cond) -> ObjectQuery:
        """F-19: WITH <field expression> — an extra row filter."""
        q = self.where(cond)
        q._with_filter = True
        return q

    def scope(self, name: str) -> ObjectQuery:
        """F-17: USING SCOPE <name> — a scope registered on the object."""
        q = self._copy()
        q._scopes.append(name)
        return q

    def with_category(self, group: str, selector: str, names: Iterable[str] | str) -> ObjectQuery:
        """F-18: WITH DATA CATEGORY group AT|ABOVE|BELOW|ABOVE_OR_BELOW (names)."""
        sel = selector.upper()
        if sel not in ("AT", "ABOVE", "BELOW", "ABOVE_OR_BELOW"):
            raise QueryError(f"Unknown data category selector '{selector}'")
        q = self._copy()
        q._categories.append((group, sel, [names] if isinstance(names, str) else list(names)))
        return q

    def group_by(self, *items) -> ObjectQuery:
        return self._grouped("group", items)

    def rollup(self, *items) -> ObjectQuery:
        return self._grouped("rollup", items)

    def cube(self, *items) -> ObjectQuery:
        return self._grouped("cube", items)

    def _grouped(self, mode, items) -> ObjectQuery:
        q = self._copy()
        q._group_mode = mode
        q._group = [as_item(i) for i in items]
        return q

    def having(self, cond) -> ObjectQuery:
        """A-15: filter on groups; only after GROUP BY."""
        if self._group_mode is None:
            raise QueryError("HAVING needs GROUP BY")
        q = self._copy()
        q._having = as_expr(cond)
        return q

    def order_by(self, *items) -> ObjectQuery:
        q = self._copy()
        q._order = _sort_keys(items)
        return q

    def limit(self, n: int) -> ObjectQuery:
        if int(n) < 0:
            raise QueryError("LIMIT must be 0 or greater")
        q = self._copy()
        q._limit = int(n)
        return q

    def offset(self, n: int) -> ObjectQuery:
        if int(n) < 0:
            raise QueryError("OFFSET must be 0 or greater")
        q = self._copy()
        q._offset = int(n)
        return q

    def include_deleted(self, flag: bool = True) -> ObjectQuery:
        """S-10: ``False`` (query) hides soft-deleted rows, ``True`` (queryAll) keeps them."""
        q = self._copy()
        q._include_deleted = bool(flag)
        return q

    def modified(self, since=None, until=None, as_of=None, duration=None, offset=None) -> ObjectQuery:
        """F-09 / F-10 on the object's modified-time field."""
        q = self._copy()
        q._time = dict(since=since, until=until, as_of=as_of, duration=duration, offset=offset)
        return q

    def children(self, relationship: str, select: Iterable = (), where=None, order_by: Iterable = (),
                 limit: int | None = None, offset: int | None = None, flat: bool = False,
                 alias: str | None = None, piece_rows: int | None = None) -> ObjectQuery:
        """J-02/J-03: child rows per parent row, one level deep.

        Nested (default): an ``array<struct>`` column named after the
        relationship, empty (not null) when a parent has no children.
        ``flat=True``: one output row per (parent, child) pair, child fields
        prefixed ``<relationship>_``, parents without children kept once.
        ``piece_rows=n``: arrays of at most n children, one output row per piece,
        numbered from 0 in ``<relationship>_piece``; all pieces of a parent but
        the last are full, and a parent without children has one empty piece.
        Use it where a parent may own more children than a task should hold.
        """
        items = [as_item(i) for i in select]
        if not items:
            raise QueryError("A child sub-query needs at least one field")
        for label, v in (("LIMIT", limit), ("OFFSET", offset)):
            if v is not None and int(v) < 0:
                raise QueryError(f"Child {label} must be 0 or greater")
        for it in items:
            if it.is_function or it.has_agg:
                raise QueryError("Functions are not allowed in a child sub-query")
        if piece_rows is not None and (flat or int(piece_rows) < 1):
            raise QueryError("A child sub-query in pieces needs 1 or more rows a piece and can't be flat")
        if (flat or piece_rows) and any(c.flat or c.piece_rows for c in self._children):
            raise QueryError("Only one child sub-query can be flat or in pieces: two would give every pair of their rows")
        q = self._copy()
        q._children.append(ChildSpec(relationship, items, as_expr(where) if where is not None else None,
                                     _sort_keys(order_by), limit, offset, flat, alias, piece_rows))
        return q

    def explain(self, mode: str = "formatted") -> None:
        """Print the physical plan Spark chooses for this query."""
        self.to_df().explain(mode)

    def __repr__(self) -> str:
        parts = [f"ObjectQuery({self.obj_name})", "select " + ", ".join(repr(e) for e in self._select)]
        if self._where:
            parts.append("where " + " AND ".join(e.key for e in self._where))
        if self._group_mode:
            parts.append(f"{self._group_mode} by " + ", ".join(e.key for e in self._group))
        if self._children:
            parts.append("children " + ", ".join(c.relationship for c in self._children))
        return " ".join(parts)

    # -------------------------------------------------------------- checks
    @property
    def is_aggregate(self) -> bool:
        return self._group_mode is not None or any(e.has_agg for e in self._select)

    @property
    def has_functions(self) -> bool:
        return any(e.is_function or e.has_agg for it in self._select for e in it.walk())

    def _out_name(self, item: Expr, i: int) -> str:
        if item.name:
            return item.name
        d = item.default_name()
        if d is not None:
            parts = d.split(".")
            # P-04: an object-qualified name loses the object prefix
            if len(parts) > 1 and (parts[0] == self.obj_name or (self.obj_alias and parts[0] == self.obj_alias)):
                parts = parts[1:]
            return normalize_name(".".join(parts))
        if self.strict_aliases:
            raise QueryError(f"Function {item.key} needs an alias")
        return f"expr{i}"

    def _check_compound(self, r: _Resolver) -> None:
        """V-04: address and location fields cannot be selected."""
        from ..catalog import COMPOUND_TYPES
        for it in self._select:
            for e in it.walk():
                if isinstance(e, FieldRef):
                    rels, f = r.split(e.path)
                    obj = r.target_of(rels)
                    if self.catalog.field_type(obj, f).lower() in COMPOUND_TYPES:
                        raise QueryError(f"Compound field '{e.path}' cannot be selected")

    def _check_aliases(self) -> None:
        if not self.strict_aliases:
            return
        for it in self._select:
            if isinstance(it, FieldRef) and it.name and self._group_mode is None:
                raise QueryError(f"Alias '{it.name}' on a plain field needs GROUP BY")
            if (it.is_function or it.has_agg) and not it.name:
                raise QueryError(f"Function {it.key} needs an alias")
            if (self._group_mode is not None and isinstance(it, FieldRef)
                    and len(_Resolver(self).split(it.path)[0]) > 0 and not it.name):
                raise QueryError(f"Grouped reference field '{it.path}' needs an alias")

    # ------------------------------------------------------------ compile
    def schema(self) -> T.StructType:
        """A-16: result types of the spec (analysis only, nothing runs)."""
        q = self._copy()
        q._types_only = True
        return q.to_df().schema

    def _all_exprs(self) -> list[Expr]:
        out = list(self._select) + list(self._where) + list(self._group)
        if self._having is not None:
            out.append(self._having)
        out += [k.expr for k in self._order]
        return out

    def _base(self, source: DataFrame | None) -> DataFrame:
        obj = self.catalog.get(self.obj_name)
        if source is not None:
            df = source
        else:
            df = self.catalog.table(self.obj_name, include_deleted=self._include_deleted)
        cond = modified_filter(obj, **self._time) if self._time else None
        if cond is not None:
            df = df.filter(cond)
        return df

    def _join_paths(self, df: DataFrame, r: _Resolver, paths: set[str],
                    filter_paths: set[str] = frozenset()) -> DataFrame:
        """One left join per distinct relationship prefix.  Relationships that
        the WHERE clause filters on are joined first: Catalyst turns them into
        inner joins with the filter below them, so the rows shrink before the
        remaining joins."""
        needed: dict[tuple[str, ...], set[str]] = {}
        for p in paths:
            rels, f = r.split(p)
            for k in range(1, len(rels) + 1):
                needed.setdefault(rels[:k], set())
            if rels:
                needed[rels].add(f)
        # the foreign key of each hop must be available on the hop before it
        for prefix in list(needed):
            if len(prefix) > 1:
                owner = r.target_of(prefix[:-1])
                needed[prefix[:-1]].add(self.catalog.reference(owner, prefix[-1]).field)
        filtered_roots = {r.split(p)[0][0] for p in filter_paths if r.split(p)[0]}
        for prefix in sorted(needed, key=lambda pr: (pr[0] not in filtered_roots, len(pr))):
            owner = r.target_of(prefix[:-1])
            ref = self.catalog.reference(owner, prefix[-1])
            target = self.catalog.get(ref.target)
            if not target.id_field:
                raise QueryError(f"Object '{target.name}' has no Id field to join on")
            name = ".".join(prefix)
            fk = ".".join(prefix[:-1] + (ref.field,))
            cols = [F.col(target.id_field).alias(f"{name}.__id")]
            cols += [F.col(f).alias(f"{name}.{f}") for f in sorted(needed[prefix])]
            parent = self.catalog.table(target.name).select(*cols)
            df = df.join(parent, column(fk) == column(f"{name}.__id"), "left")
        return df

    def _apply_where(self, df: DataFrame, r: _Resolver, conds: list[Expr]) -> DataFrame:
        plain = []
        n = 0
        for cond in conds:
            for c in conjuncts(cond):
                if isinstance(c, SubqueryIn):
                    df = _subquery_join(df, c.expr.to_column(r), c.query.to_df(), c.negate, f"__sq{n}",
                                        c.null_safe, getattr(c.query, "broadcast", False))
                    n += 1
                else:
                    plain.append(c)
        for c in plain:
            for e in c.walk():
                if isinstance(e, SubqueryIn):   # under OR or NOT
                    df = _flag_join(df, e, r, f"__sq{n}")
                    n += 1
            df = df.filter(c.to_column(r))
        return df

    def _category_conditions(self) -> list[Expr]:
        out = []
        for group, sel, names in self._categories:
            g = self.catalog.category_group(group)
            if self.obj_name not in g.objects:
                raise QueryError(f"Data category group '{group}' does not apply to '{self.obj_name}'")
            from ..operators.category import category_nodes
            nodes = category_nodes(self.catalog.spark, g.edges, "AT" if self._types_only else sel, names, g.paths)
            out.append(SubqueryIn(fld(g.assignment), _FrameQuery(nodes), negate=False))
        return out

    def to_df(self, source: DataFrame | None = None) -> DataFrame:
        """Compile the spec.  ``source`` replaces the object's table (T-04:
        the same query over a streaming DataFrame of the object's rows)."""
        if not self._select:
            raise QueryError("A query needs at least one field")
        self._check_aliases()
        seen: dict[str, str] = {}
        for i, it in enumerate(self._select):
            n = self._out_name(it, i)
            if n.lower() in seen:
                raise QueryError(f"Duplicate output field '{n}'")
            seen[n.lower()] = n
        scopes = []
        obj = self.catalog.get(self.obj_name)
        for s in self._scopes:
            if s.lower() not in obj.scopes:
                raise QueryError(f"Unknown scope '{s}' on '{self.obj_name}'")
            scopes.append(as_expr(obj.scopes[s.lower()]))
        cats = self._category_conditions()
        conds = list(self._where) + scopes + cats

        df = self._base(source)
        r = _Resolver(self, df)
        self._check_compound(r)
        paths = set()
        for e in self._all_exprs() + scopes + cats:
            paths |= e.paths
            for sub in e.walk():
                if isinstance(sub, SubqueryIn):
                    paths |= sub.expr.paths
        filter_paths = set()
        for e in conds:
            filter_paths |= e.paths
        df = self._join_paths(df, r, paths, filter_paths)
        r.df = df
        df = self._apply_where(df, r, conds)
        r.df = df

        if self.is_aggregate:
            if self._children:
                raise QueryError("Child sub-queries cannot be combined with aggregation")
            return self._aggregate(df, r)

        child_cols: list[Column] = []
        for spec in self._children:
            df, cols = self._attach_children(df, spec, restrict=bool(conds))
            child_cols += cols
        r.df = df
        names = [self._out_name(it, i) for i, it in enumerate(self._select)]
        out_cols = [it.to_column(r).alias(n) for it, n in zip(self._select, names)] + child_cols
        return self._finish(df, out_cols, r)

    def _finish(self, df: DataFrame, out_cols: list[Column], r: _Resolver) -> DataFrame:
        """ORDER BY, then OFFSET / LIMIT.  With a LIMIT the result is a
        bounded top-k.  An OFFSET alone keeps the rows behind its last one
        (:func:`.operators.rowskip.skip_rows`, lazy), instead of pulling every
        row into one partition; beyond ``MOST_SKIPPED`` it numbers the rows with the
        distributed row index (range partitioning + checkpoint)."""
        if self._offset and self._limit is None and not self._types_only:
            from ..operators.packing import global_index
            from ..operators.rowskip import MOST_SKIPPED, skip_rows
            hidden = [k.expr.to_column(r).alias(f"__o{i}") for i, k in enumerate(self._order)]
            staged = df.select(*out_cols, *hidden)
            names = [c for c in staged.columns if not c.startswith("__o")]
            if self._offset <= MOST_SKIPPED:
                kept = skip_rows(staged, [(f"__o{i}", k.descending, k.nulls) for i, k in enumerate(self._order)], self._offset)
                return kept.select(*[F.col(quote(n)) for n in names])
            order = [k.apply(F.col(f"__o{i}")) for i, k in enumerate(self._order)]
            idx = global_index(staged, order, "__pos")
            kept = idx.filter(F.col("__pos") >= self._offset).orderBy("__pos")
            return kept.select(*[F.col(quote(n)) for n in names])
        if self._order:
            df = df.orderBy(*[k.to_column(r) for k in self._order])
        df = df.select(*out_cols)
        if self._offset:
            df = df.offset(self._offset)
        if self._limit is not None:
            df = df.limit(self._limit)
        return df

    # ------------------------------------------------------- aggregation
    def _aggregate(self, df: DataFrame, r: _Resolver) -> DataFrame:
        group_keys: dict[str, str] = {}
        gcols = []
        for i, g in enumerate(self._group):
            name = f"__g{i}"
            gcols.append(g.to_column(r).alias(name))
            group_keys[g.key] = name
            if isinstance(g, FieldRef):
                group_keys["path:" + r.internal(g.path)] = name
        agg_nodes: dict[str, Expr] = {}
        for e in list(self._select) + ([self._having] if self._having is not None else []) + \
                [k.expr for k in self._order]:
            for sub in e.walk():
                if isinstance(sub, (AggExpr, GroupingExpr)) and sub.key not in agg_nodes:
                    agg_nodes[sub.key] = sub
        agg_keys: dict[str, str] = {}
        acols, distinct = [], []
        for j, (k, node) in enumerate(agg_nodes.items()):
            name = f"__a{j}"
            agg_keys[k] = name
            if isinstance(node, GroupingExpr):
                if self._group_mode not in ("rollup", "cube"):
                    raise QueryError("GROUPING needs GROUP BY ROLLUP or CUBE")
                gname = group_keys.get(node.arg.key)
                if gname is None and isinstance(node.arg, FieldRef):
                    gname = group_keys.get("path:" + r.internal(node.arg.path))
                if gname is None:
                    raise QueryError(f"{node.key} must name a grouped field")
                acols.append(F.grouping(gname).cast("int").alias(name))
            elif self._group_mode in ("rollup", "cube") and node.fname == "COUNT_DISTINCT":
                distinct.append((name, node.arg.to_column(r)))
            else:
                acols.append(node.agg_column(r).alias(name))
        if self._group_mode is None:
            out = df.agg(*acols)
        else:
            base = df.select("*", *gcols)
            gnames = [f"__g{i}" for i in range(len(gcols))]
            grouped = {"group": base.groupBy, "rollup": base.rollup, "cube": base.cube}[self._group_mode](*gnames)
            if distinct:
                out = _subtotal_distinct(base, self._group_mode, gnames, acols, distinct)
            elif acols:
                out = grouped.agg(*acols)
            elif self._group_mode == "group":
                out = base.select(*gnames).distinct()
            else:
                out = grouped.agg(F.count(F.lit(1)).alias("__n")).drop("__n")
        post = _PostResolver(self, out, group_keys, agg_keys, r)
        if self._having is not None:
            out = out.filter(self._having.to_column(post))
        names = [self._out_name(it, i) for i, it in enumerate(self._select)]
        out_cols = [it.to_column(post).alias(n) for it, n in zip(self._select, names)]
        return self._finish(out, out_cols, post)

    # ---------------------------------------------------------- children
    def _attach_children(self, df: DataFrame, spec: ChildSpec,
                         restrict: bool = False) -> tuple[DataFrame, list[Column]]:
        rel = self.catalog.child(self.obj_name, spec.relationship)
        parent = self.catalog.get(self.obj_name)
        if not parent.id_field:
            raise QueryError(f"Object '{parent.name}' has no Id field")
        label = spec.alias or rel.name
        cq = ObjectQuery(self.catalog, rel.child, strict_aliases=False)
        cq._include_deleted = self._include_deleted
        names = [normalize_name(it.name or it.default_name() or f"expr{i}")
                 for i, it in enumerate(spec.select)]
        tag = f"__c{len(df.columns)}_"
        inner = [f"{tag}{i}" for i in range(len(names))]
        fk, rank = f"{tag}fk", f"{tag}rank"
        cq._select = [it.alias(n) for it, n in zip(spec.select, inner)] + [fld(rel.field).alias(fk)]
        own = f"{tag}own"
        child = self.catalog.get(rel.child)
        if spec.piece_rows and child.id_field:
            cq._select.append(fld(child.id_field).alias(own))
        if spec.where is not None:
            cq._where.append(spec.where)
        if restrict and not spec.flat:
            # filtered parents: keep only their children before ranking and
            # aggregating (a semi-join on the surviving parent keys)
            keys = df.select(column(parent.id_field).alias("__pk"))
            cq._where.append(SubqueryIn(fld(rel.field), _FrameQuery(keys), negate=False))
        if spec.order_by or spec.limit is not None or spec.offset:
            # rank inside each parent; the rank filter becomes a map-side
            # group limit, so hot parents ship at most limit+offset rows per task
            cq._select.append(_RankExpr(rel.field, spec.order_by).alias(rank))
            kids = cq.to_df()
            lo = spec.offset or 0
            cond = F.col(rank) > lo
            if spec.limit is not None:
                cond = cond & (F.col(rank) <= lo + spec.limit)
            kids = kids.filter(cond)
        else:
            kids = cq.to_df()
            rank = None
        pid = column(parent.id_field)
        if spec.flat:
            # children ⋈ parents (inner: AQE may split a hot parent's children on
            # either side) plus the parents without children (anti-join on the
            # distinct child keys, pre-aggregated map-side) — never a left join
            # with the hot side on the unsplittable right
            if rank is not None:
                kids = kids.drop(rank)
            out = _with_lonely(df, kids, kids, pid, fk)
            cols = [F.col(c).alias(normalize_name(f"{label}_{n}")) for c, n in zip(inner, names)]
            return out, cols
        st = T.StructType([T.StructField(n, kids.schema[c].dataType, True) for c, n in zip(inner, names)])
        arr = f"{tag}arr"
        empty = F.array().cast(T.ArrayType(st, True))
        if spec.piece_rows:
            kids = kids.filter(F.col(fk).isNotNull())
            if rank is None:
                order = [own] if child.id_field else inner
                numbered = _number_children(kids, fk, order, f"{tag}no")
            else:
                numbered = kids.withColumn(f"{tag}no", (F.col(rank) - 1 - lo).cast("long"))
            no, piece = F.col(f"{tag}no"), f"{tag}piece"
            rows = F.array_sort(F.collect_list(F.struct(no, *[F.col(c) for c in inner])))
            pieces = numbered.groupBy(fk, F.expr(f"{tag}no div {int(spec.piece_rows)}").alias(piece)).agg(rows.alias(arr))
            pieces = pieces.select(fk, piece, F.transform(arr, lambda x: F.struct(
                *[x[c].alias(n) for c, n in zip(inner, names)])).alias(arr))
            out = _with_lonely(df, pieces, kids, pid, fk)
            return out, [F.coalesce(F.col(arr), empty).alias(normalize_name(label)),
                         F.coalesce(F.col(piece), F.lit(0).cast("long")).alias(normalize_name(f"{label}_piece"))]
        if rank is None:
            collected = F.collect_list(F.struct(*[F.col(c) for c in inner]))
        else:
            # (rank, fields) structs sort by rank: the child ORDER BY
            collected = F.array_sort(F.collect_list(F.struct(F.col(rank), *[F.col(c) for c in inner])))
        arrays = kids.groupBy(fk).agg(collected.alias(arr))
        arrays = arrays.select(F.col(fk), F.transform(arr, lambda x: F.struct(
            *[x[c].alias(n) for c, n in zip(inner, names)])).alias(arr))
        out = df.join(arrays, pid == F.col(fk), "left")
        return out, [F.coalesce(F.col(arr), empty).alias(normalize_name(label))]

    # ------------------------------------------------------------ misc
    def over(self, stream_df: DataFrame) -> DataFrame:
        """T-04: apply this query's fields and filters to a (streaming)
        DataFrame of the object's rows; sort and limit are not allowed."""
        if self._order or self._limit is not None or self._offset or self.is_aggregate or self._children:
            raise QueryError("A stream query takes fields and filters only")
        return self.to_df(source=stream_df)


def _subtotal_distinct(base: DataFrame, mode: str, keys: list[str], aggregates: list[Column],
                       distinct: list[tuple[str, Column]]) -> DataFrame:
    """ROLLUP or CUBE of ``base`` with COUNT_DISTINCT columns (name, value).  Each
    value is made distinct inside the finest groups before the grouping sets
    multiply its rows; the other aggregates are taken over all rows, and the
    parts meet by grouping set and keys (a row per group in each)."""
    def subtotals(rows: DataFrame) -> GroupedData:
        return rows.rollup(*keys) if mode == "rollup" else rows.cube(*keys)
    out = subtotals(base).agg(F.grouping_id().alias("__set"), *aggregates)
    for name, value in distinct:
        values = base.select(*keys, value.alias("__v")).distinct()
        counts = subtotals(values).agg(F.grouping_id().alias(f"{name}_set"), F.count_distinct("__v").alias(name))
        counts = counts.select(*[F.col(k).alias(f"{name}{k}") for k in keys], f"{name}_set", name)
        same = [F.col(k).eqNullSafe(F.col(f"{name}{k}")) for k in keys] + [F.col("__set") == F.col(f"{name}_set")]
        on = same[0]
        for c in same[1:]:
            on = on & c
        out = out.join(counts, on).drop(*[f"{name}{k}" for k in keys], f"{name}_set")
    return out.drop("__set")


def _with_lonely(df: DataFrame, rows: DataFrame, kids: DataFrame, pid: Column, fk: str) -> DataFrame:
    """``rows`` of children joined to their parents ``df``, and the parents
    without any of ``kids``."""
    keys = kids.select(F.col(fk).alias(f"{fk}_key")).distinct()
    lonely = df.join(keys, pid == F.col(f"{fk}_key"), "left_anti")
    return rows.join(df, F.col(fk) == pid, "inner").unionByName(lonely, allowMissingColumns=True)


#: parts that a parent's children are numbered in
CHILD_PARTS = 4096


def _number_children(kids: DataFrame, fk: str, order: list[str], name: str) -> DataFrame:
    """``kids`` numbered from 0 without a gap inside each parent: each of a
    parent's parts (by a hash of ``order``) is numbered by itself, and begins
    after the counts of the parts before it, so no task sorts a whole parent."""
    part = f"{name}_part"
    parted = kids.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(CHILD_PARTS)))
    counts = parted.groupBy(fk, part).agg(F.count(F.lit(1)).alias(f"{name}_n"))
    before = Window.partitionBy(fk).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(F.col(fk).alias(f"{name}_fk"), F.col(part).alias(f"{part}_no"),
                           F.coalesce(F.sum(f"{name}_n").over(before), F.lit(0)).alias(f"{name}_begin"))
    local = F.row_number().over(Window.partitionBy(fk, part).orderBy(*order)) - 1
    joined = parted.withColumn(f"{name}_local", local).join(
        begins, (F.col(fk) == F.col(f"{name}_fk")) & (F.col(part) == F.col(f"{part}_no")))
    return joined.select(*kids.columns, (F.col(f"{name}_begin") + F.col(f"{name}_local")).alias(name))


class _RankExpr(Expr):
    """row_number() within a parent for ordered / limited child rows."""

    def __init__(self, fk_path: str, order: list[SortKey]):
        self.fk_path, self.order = fk_path, order
        fk = fld(fk_path)
        super().__init__(f"ROW_NUMBER({fk_path})", self._rank, (fk,) + tuple(k.expr for k in order))

    def _rank(self, r) -> Column:
        keys = [k.to_column(r) for k in self.order] or [F.lit(1)]
        return F.row_number().over(Window.partitionBy(r.field(self.fk_path)).orderBy(*keys))


class _FrameQuery:
    """Adapter so a plain DataFrame can be the right side of ``IN``;
    ``broadcast`` marks a side whose size was checked."""

    obj_name = "<frame>"

    def __init__(self, df: DataFrame, broadcast: bool = False):
        self.df = df
        self.broadcast = broadcast

    def to_df(self) -> DataFrame:
        return self.df


def _flag_join(df: DataFrame, e: SubqueryIn, r, tag: str) -> DataFrame:
    """A sub-query test inside OR or NOT: a left join to the distinct values
    gives a match flag, from which the test follows by the SQL rule for nulls
    (or, null-safe, by the flag alone); ``e`` then reads as that column."""
    x = e.expr.to_column(r)
    sub = e.query.to_df()
    v = sub.select(F.col(quote(sub.columns[0])).alias(tag)).distinct()
    flags = v.filter(F.col(tag).isNotNull()).withColumn(f"{tag}_hit", F.lit(True))
    hit = F.coalesce(F.col(f"{tag}_hit"), F.lit(False))
    if e.negate and e.null_safe:
        e.planned = ~hit
    else:
        state = v.agg(F.when(F.count(F.lit(1)) == 0, F.lit(0))
                      .when(F.count_if(F.col(tag).isNull()) > 0, F.lit(2)).otherwise(F.lit(1))).scalar()
        unknown = F.lit(None).cast("boolean")
        # state 0: empty, 2: with a null
        found = F.when(hit, F.lit(True)).when(x.isNull(), F.when(state == 0, F.lit(False)).otherwise(unknown)) \
            .when(state == 2, unknown).otherwise(F.lit(False))
        e.planned = ~found if e.negate else found
    return df.join(flags, x == F.col(tag), "left")


def _subquery_join(df: DataFrame, x: Column, sub: DataFrame, negate: bool, tag: str,
                   null_safe: bool = False, broadcast: bool = False) -> DataFrame:
    """``x IN (sub)`` as a left-semi join; ``x NOT IN (sub)`` as a left-anti
    join plus the SQL rule for nulls (computed once as a scalar sub-query):
    an empty ``sub`` keeps every row, a null in ``sub`` keeps none, and a null
    ``x`` is kept only when ``sub`` is empty."""
    # distinct first: a value repeated by a third of the sub-query rows is cut
    # to one row per map task before the shuffle (partial aggregation)
    v = sub.select(F.col(quote(sub.columns[0])).alias(tag)).distinct()
    if broadcast:
        v = F.broadcast(v)
    if not negate:
        return df.join(v, x == F.col(tag), "left_semi")
    if null_safe:
        return df.join(v.filter(F.col(tag).isNotNull()), x == F.col(tag), "left_anti")
    state = v.agg(F.when(F.count(F.lit(1)) == 0, F.lit(0))
                  .when(F.count_if(F.col(tag).isNull()) > 0, F.lit(2))
                  .otherwise(F.lit(1))).scalar()
    kept = df.join(v.filter(F.col(tag).isNotNull()), x == F.col(tag), "left_anti")
    # one reference to the scalar: state 0 keeps all, state 1 keeps non-null x
    code = state + F.when(x.isNull(), F.lit(10)).otherwise(F.lit(0))
    return kept.filter(code.isin(0, 1, 10))
