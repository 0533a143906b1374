"""Semantic metrics and metric views as DataFrame aggregations.

* :class:`Metric` - simple (agg over an expression, optional filter), ratio
  (two metrics, each with an optional filter), derived (arithmetic over other
  metrics, possibly from other models), cumulative (sum, count or distinct count
  over trailing days or all time), semi_additive (each entity's last state, carried
  forward), conversion (share of base events that an event of the same entity follows
  within some days) and offset (another metric, some periods earlier).
* :func:`query_metrics` - evaluates many metrics in one request: metrics of
  the same model share **one scan and one aggregation** (filters become
  conditional aggregates), results of different models are aggregated
  separately and then joined on the requested dimensions, so no fact is
  ever multiplied by a join.
* :class:`MetricView` - YAML dimensions x measures over one source DataFrame.

Dimensions of another model are reached through declared N:1 entity links
only (fact -> dimension on the dimension's primary key), so a join can never
multiply fact rows and a 1:N path can never inflate a sum. Facts are aggregated
by the link's foreign key first and joined then, so a customer that holds a third
of the rows is combined map-side; only what cannot be aggregated twice (distinct
counts, conditions that mix both sides) joins row by row, with the fact on the
streamed side so that AQE can split a hot key.

A request's ``where`` is applied to every model from which all its columns can be
reached, directly or through a link; it is an error if there is none. If it reaches
only some of the models that one ratio or derived metric combines, the request must
name the others in ``unfiltered``: otherwise numerator and denominator would be
cut unevenly without a sign in the result. Of a conversion metric it picks the base
events.

Cumulative and semi-additive metrics have a value for every period between the first
and the last day of their model's rows, also where a period has none; the value is
that at the period's end. An offset metric needs a grain; it stands beside the periods
that the request's other metrics have (alone: beside those of its own input), NULL where
the earlier period has no value.

Precondition: a model's ``primary_key`` is unique (the ``unique`` test of the model
checks it). Distinct counts of the key are plain counts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import avg_exact, ratio
from ledgerloom.operators import timed_metrics as timed

TIMED = ("cumulative", "semi_additive", "conversion")
_STEP_DAYS, _STEP_MONTHS = {"day": 1, "week": 7}, {"month": 1, "quarter": 3, "year": 12}
GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Metric:
    name: str
    model: str
    # simple | ratio | derived | cumulative | semi_additive | conversion | offset
    type: str = "simple"
    agg: str | None = None                # sum | average | count | count_distinct | min | max
    expr: str | None = None
    filter: str | None = None
    numerator: "Metric | str | None" = None
    denominator: "Metric | str | None" = None
    inputs: tuple[str, ...] = ()
    derived: str | None = None            # python arithmetic over input names, e.g. "a / b"
    hidden: bool = False
    label: str = ""
    meta: Mapping[str, object] = field(default_factory=dict)
    window_days: int | None = None        # cumulative: None is all time; conversion: at most so late
    entity: str | None = None             # semi_additive, conversion: whose states or events
    order: tuple[str, ...] = ()           # semi_additive: which state of one day is the last
    conversion: str | None = None         # condition on the converting events; None: any later event
    periods: int = 1                      # offset: so many periods of the request's grain earlier

    def __post_init__(self):
        if self.type in ("semi_additive", "conversion") and not self.entity:
            raise ValueError(f"metric {self.name}: a {self.type} metric needs an entity")
        if self.type == "conversion" and self.window_days is None:
            raise ValueError(f"metric {self.name}: a conversion metric needs window_days")


@dataclass(frozen=True)
class SemanticModel:
    name: str
    primary_key: str
    time_dimension: str | None = None
    links: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # dimension name -> SQL expression override (e.g. cast(is_active as string))
    dimension_exprs: Mapping[str, str] = field(default_factory=dict)


class MetricRegistry:
    def __init__(self, models: Sequence[SemanticModel], metrics: Sequence[Metric]):
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}

    def __getitem__(self, name: str) -> Metric:
        return self.metrics[name]

    def visible(self) -> list[str]:
        return [m.name for m in self.metrics.values() if not m.hidden]


_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_AGGREGATE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max,
              "count_distinct": F.countDistinct}


@dataclass(frozen=True)
class _Part:
    """One aggregate column of a metric: its rows' condition and value, as SQL."""

    alias: str
    agg: str
    expr: str
    filter: str | None


def _names(sql: str | None, known: set[str]) -> set[str]:
    """Those of ``known`` columns that occur in a SQL expression (outside literals)."""
    words = re.findall(r"[A-Za-z_][A-Za-z0-9_]*", re.sub(r"'[^']*'", " ", sql or ""))
    return known & set(words)


def _simple_parts(m: Metric, alias: str, primary_key: str | None = None
                  ) -> tuple[list[_Part], Column]:
    """(aggregate columns, final expression over them) for a simple metric.

    ``count_distinct`` of the model's primary key, plain or in a ``case``, is a plain
    ``count``: each distinct aggregate would otherwise make Spark expand every
    input row once per distinct expression and shuffle the keys.
    """
    if m.agg == "average":
        s, n = f"{alias}__s", f"{alias}__n"
        return ([_Part(s, "sum", m.expr, m.filter), _Part(n, "count", m.expr, m.filter)],
                avg_exact(F.col(s), F.col(n)))
    agg = m.agg
    if agg not in _AGGREGATE:
        raise ValueError(f"unsupported agg {agg!r}")
    if agg == "count_distinct" and primary_key is not None and \
            re.fullmatch(_key_pattern(primary_key), m.expr.strip(), re.I | re.S):
        agg = "count"
    return [_Part(alias, agg, m.expr, m.filter)], F.col(alias)


def _key_pattern(key: str) -> str:
    return rf"(?:{key}|case\s+when\s(?:(?!\bend\b).)*\sthen\s+{key}\s+end)"


def _resolve(ref: Metric | str, reg: MetricRegistry) -> Metric:
    return reg[ref] if isinstance(ref, str) else ref


def _time_col(model: SemanticModel, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    if model.time_dimension is None:
        raise ValueError(f"model {model.name} has no time dimension")
    col = F.col(model.time_dimension).cast("date")
    return col if grain == "day" else F.trunc(col, grain)


def _linked_columns(ds, reg: MetricRegistry, model_name: str) -> dict[str, str]:
    """Column -> linked model, for columns reached through an N:1 link."""
    own, out = set(ds[model_name].columns), {}
    for target in reg.models[model_name].links:
        for c in ds[target].columns:
            if c not in own:
                out.setdefault(c, target)
    return out


def _model_result(ds, reg: MetricRegistry, model_name: str, parts: Sequence[_Part],
                  by: Sequence[str], grain: str | None, where: str | None
                  ) -> tuple[DataFrame, list[str]]:
    """One row per combination of the dimensions with every part's aggregate.

    Dimensions owned by the model are used directly; others come from a linked
    model through its N:1 key. ``metric_time`` is the model's time dimension
    truncated to ``grain``.
    """
    sm = reg.models[model_name]
    df = ds[model_name]
    own, linked = set(df.columns), _linked_columns(ds, reg, model_name)
    dims: list[str] = []
    for d in by:
        if d in sm.dimension_exprs:
            df = df.withColumn(d, F.expr(sm.dimension_exprs[d]))
        elif d not in own and d not in linked:
            raise ValueError(f"dimension {d!r} is not reachable from {model_name} "
                             "through an N:1 link")
        dims.append(d)
    if grain:
        df = df.withColumn("metric_time", _time_col(sm, grain))
        dims.append("metric_time")

    foreign = lambda sql: _names(sql, set(linked))
    mixed = lambda sql: foreign(sql) and _names(sql, own)
    if where and not foreign(where):
        df, where = df.filter(F.expr(where)), None
    needed = {d for d in by if d in linked and d not in sm.dimension_exprs} | foreign(where)
    for p in parts:
        needed |= foreign(p.filter) | foreign(p.expr)

    def value(p: _Part, conditional: bool = True) -> Column:
        v = F.expr(p.expr)
        return F.when(F.expr(p.filter), v) if p.filter and conditional else v

    def grouped(rows: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
        return rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)

    if not needed:
        return grouped(df, dims, [_AGGREGATE[p.agg](value(p)).alias(p.alias) for p in parts]), dims

    targets: dict[str, set[str]] = {}
    for c in needed:
        targets.setdefault(linked[c], set()).add(c)

    def attach(rows: DataFrame) -> DataFrame:
        for target, columns in targets.items():
            fk, pk = sm.links[target]
            rows = rows.join(ds[target].select(F.col(pk).alias(fk), *sorted(columns)), fk, "left")
        return rows.filter(F.expr(where)) if where else rows

    if mixed(where) or any(p.agg == "count_distinct" or mixed(p.filter) or foreign(p.expr)
                           for p in parts):
        return grouped(attach(df), dims,
                       [_AGGREGATE[p.agg](value(p)).alias(p.alias) for p in parts]), dims

    # by foreign key first; conditions on linked columns pick whole keys afterwards
    keys = [d for d in dims if d not in needed]
    keys += [fk for fk in dict.fromkeys(sm.links[t][0] for t in targets) if fk not in keys]
    partial = df.groupBy(*keys).agg(*[
        _AGGREGATE[p.agg](value(p, not foreign(p.filter))).alias(p.alias) for p in parts])
    combined = []
    for p in parts:
        v = F.when(F.expr(p.filter), F.col(p.alias)) if foreign(p.filter) else F.col(p.alias)
        c = _COMBINE[p.agg](v)
        combined.append((F.coalesce(c, F.lit(0)) if p.agg == "count" else c).alias(p.alias))
    return grouped(attach(partial), dims, combined), dims


def _rows_with(ds, reg: MetricRegistry, model_name: str, by: Sequence[str], where: str | None
               ) -> DataFrame:
    """The model's rows with the dimensions ``by`` as columns, those of linked models joined."""
    sm, df = reg.models[model_name], ds[model_name]
    own, linked = set(df.columns), _linked_columns(ds, reg, model_name)
    needed: dict[str, set[str]] = {}
    for c in (set(by) - own - set(sm.dimension_exprs)) | _names(where, set(linked)):
        if c not in linked:
            raise ValueError(f"dimension {c!r} is not reachable from {model_name} "
                             "through an N:1 link")
        needed.setdefault(linked[c], set()).add(c)
    for target, columns in needed.items():
        fk, pk = sm.links[target]
        df = df.join(ds[target].select(F.col(pk).alias(fk), *sorted(columns)), fk, "left")
    if where:
        df = df.filter(F.expr(where))
    return df.withColumns({d: F.expr(sm.dimension_exprs[d]) for d in by if d in sm.dimension_exprs})


def _timed_result(ds, reg: MetricRegistry, m: Metric, alias: str, by: Sequence[str],
                  grain: str | None, where: str | None) -> DataFrame:
    """(by, metric_time, alias) of a cumulative, semi-additive or conversion metric."""
    sm = reg.models[m.model]
    if grain is not None or m.type != "conversion":
        _time_col(sm, grain or "day")                       # raises without a time dimension
    time = sm.time_dimension
    rows = _rows_with(ds, reg, m.model, by, where)
    if m.type == "conversion":
        base = rows.filter(F.expr(m.filter)) if m.filter else rows
        keep = list(dict.fromkeys([*by, m.entity, time, sm.primary_key]))
        later = ds[m.model].filter(F.expr(m.conversion)) if m.conversion else None
        found = timed.conversions(base.select(*keep), later, m.entity, time, sm.primary_key, m.window_days)
        if grain:
            found = found.withColumn("metric_time", _time_col(sm, grain))
        dims = [*by, *(["metric_time"] if grain else [])]
        share = ratio(F.sum(F.col("converted").cast("long")), F.count(F.lit(1))).alias(alias)
        return found.groupBy(*dims).agg(share) if dims else found.agg(share)

    picked = rows.filter(F.expr(m.filter)) if m.filter else rows
    value = F.expr(m.expr)
    if m.type == "cumulative":
        changes = timed.trailing_changes(picked, by, time, m.agg, value, m.window_days)
    else:
        if m.agg != "sum":
            raise ValueError(f"metric {m.name}: a semi_additive metric sums over its entities")
        changes = timed.balance_changes(rows, by, m.entity, time,
                                        F.when(F.expr(m.filter), value) if m.filter else value,
                                        m.order, grain or "day")
    bounds = ds[m.model].agg(F.min(F.col(time).cast("date")).alias("first"),
                             F.max(F.col(time).cast("date")).alias("last"))
    return timed.spread(changes, by, bounds, grain, alias)


def query_metrics(ds, reg: MetricRegistry, metrics: Sequence[str], by: Sequence[str] = (),
                  grain: str | None = None, where: str | None = None,
                  unfiltered: Sequence[str] = ()) -> DataFrame:
    """Evaluate ``metrics`` grouped by ``by`` (+ ``metric_time`` at ``grain``).

    ``unfiltered``: models that ``where`` need not reach, though a ratio or derived
    metric combines them with one that it does.
    """
    # 1) flatten to simple components per model
    needed: dict[str, list[tuple[str, Metric]]] = {}
    finals: dict[str, object] = {}
    alone: dict[str, Metric] = {}               # metrics over time, each a table of its own
    combined: dict[str, set[str]] = {}          # models by requested metric
    earlier: dict[str, tuple[Metric, int]] = {}     # offsets: metric and periods

    def need(alias: str, m: Metric) -> None:
        lst = needed.setdefault(m.model, [])
        if alias not in [a for a, _ in lst]:
            lst.append((alias, m))

    def plan(name_or_metric: Metric | str, alias: str):
        m = _resolve(name_or_metric, reg)
        if m.type == "simple" or m.type in TIMED:
            combined.setdefault(asking, set()).add(m.model)
            if m.type == "simple":
                need(alias, m)
            else:
                alone[alias] = m
            return ("col", alias)
        if m.type == "offset":
            base = _resolve(m.inputs[0], reg)
            if grain is None:
                raise ValueError(f"metric {m.name}: an offset needs a grain")
            combined.setdefault(asking, set()).add(base.model)
            earlier[alias] = (base, m.periods)
            return ("col", alias)
        if m.type == "ratio":
            num, den = _resolve(m.numerator, reg), _resolve(m.denominator, reg)
            return ("ratio", plan(num, f"{alias}__num"), plan(den, f"{alias}__den"))
        if m.type == "derived":
            return ("derived", m.derived,
                    {i: plan(i, f"{alias}__{i}") for i in m.inputs})
        raise ValueError(f"unknown metric type {m.type!r}")

    for name in metrics:
        asking = name
        finals[name] = plan(name, name)

    # 2) one aggregation per model; the condition goes where its columns are
    used = dict.fromkeys([*needed, *(m.model for m in alone.values()),
                          *(m.model for m, _ in earlier.values())])
    reach = {m: set(ds[m].columns) | set(_linked_columns(ds, reg, m)) for m in used}
    known = set().union(*reach.values(), *(set(ds[m].columns) for m in reg.models)) if where else set()
    asked = _names(where, known)
    owners = [m for m in used if asked and asked <= reach[m]]
    if where and not owners:
        raise ValueError(f"where={where!r}: its columns {sorted(asked)} cannot be reached from "
                         f"{sorted(used)}")
    for name, models in combined.items() if where else ():
        left = models - set(owners) - set(unfiltered)
        if left and left != models:
            raise ValueError(f"where={where!r} reaches {sorted(models & set(owners))} but not "
                             f"{sorted(left)}, which {name} combines; name these in unfiltered")
    frames: list[tuple[DataFrame, list[str]]] = []
    exprs: dict[str, Column] = {}
    for model_name, comps in needed.items():
        parts: list[_Part] = []
        pk = reg.models[model_name].primary_key
        for alias, m in comps:
            cols, final = _simple_parts(m, alias, pk)
            parts.extend(cols)
            exprs[alias] = final
        agg, dims = _model_result(ds, reg, model_name, parts, by, grain,
                                  where if model_name in owners else None)
        keep = [F.col(d) for d in dims] + [exprs[a].alias(a) for a, _ in comps]
        frames.append((agg.select(*keep), dims))
    dims = [*by, *(["metric_time"] if grain else [])]
    for alias, m in alone.items():
        frames.append((_timed_result(ds, reg, m, alias, by, grain,
                                     where if m.model in owners else None), dims))

    shifted = []
    for alias, (m, periods) in earlier.items():
        table = query_metrics(ds, MetricRegistry(list(reg.models.values()),
                                                 [*reg.metrics.values(), replace(m, name=alias)]),
                              [alias], by, grain, where, unfiltered)
        if not frames:              # nothing else in the request: the input's own periods
            frames.append((table.select(*dims), dims))
        step = F.make_dt_interval(days=F.lit(periods * _STEP_DAYS[grain])) if grain in _STEP_DAYS else \
            F.make_ym_interval(months=F.lit(periods * _STEP_MONTHS[grain]))
        shifted.append(table.withColumn("metric_time", (F.col("metric_time") + step).cast("date")))

    # 3) combine models on the dimension values (null-safe full join)
    out, dims = frames[0]
    for other, _ in frames[1:]:
        if dims:
            cond = None
            o2 = other
            for d in dims:
                o2 = o2.withColumnRenamed(d, f"__r_{d}")
            for d in dims:
                c = out[d].eqNullSafe(o2[f"__r_{d}"])
                cond = c if cond is None else cond & c
            joined = out.join(o2, cond, "full")
            for d in dims:
                joined = joined.withColumn(d, F.coalesce(F.col(d), F.col(f"__r_{d}"))) \
                    .drop(f"__r_{d}")
            out = joined
        else:
            out = out.crossJoin(F.broadcast(other))   # two one-row results

    for other in shifted:
        other = other.select(*[F.col(d).alias(f"__r_{d}") if d in dims else F.col(d) for d in other.columns])
        cond = F.lit(True)
        for d in dims:
            cond = cond & F.col(d).eqNullSafe(F.col(f"__r_{d}"))
        out = out.join(other, cond, "left").drop(*[f"__r_{d}" for d in dims])

    def render(node) -> Column:
        kind = node[0]
        if kind == "col":
            return F.col(node[1])
        if kind == "ratio":
            num, den = render(node[1]), render(node[2])
            return num.cast("double") / F.when(den != 0, den.cast("double"))
        if kind == "derived":
            env = {k: render(v).cast("double") for k, v in node[2].items()}
            return _eval_derived(node[1], env)
        raise AssertionError(kind)

    return out.select(*[F.col(d) for d in dims],
                      *[render(finals[name]).alias(name) for name in metrics])


def _eval_derived(expr: str, env: Mapping[str, Column]) -> Column:
    """``a / b``-style arithmetic over metric columns; division is NULL-safe."""
    import ast
    import operator

    ops = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul}

    def walk(n):
        if isinstance(n, ast.Expression):
            return walk(n.body)
        if isinstance(n, ast.Name):
            return env[n.id]
        if isinstance(n, ast.Constant):
            return F.lit(float(n.value))
        if isinstance(n, ast.BinOp):
            a, b = walk(n.left), walk(n.right)
            if isinstance(n.op, ast.Div):
                return a / F.when(b != 0, b)
            return ops[type(n.op)](a, b)
        raise ValueError(f"unsupported derived expression: {expr!r}")

    return walk(ast.parse(expr, mode="eval"))


# ------------------------------------------------------------- metric views ---

@dataclass(frozen=True)
class ViewField:
    name: str
    expr: str
    display_name: str = ""
    meta: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class MetricView:
    source: str
    dimensions: tuple[ViewField, ...]
    measures: tuple[ViewField, ...]
    comment: str = ""
    primary_key: str | None = None      # unique in the source: its distinct counts are counts

    @staticmethod
    def from_yaml(text: str, primary_key: str | None = None) -> "MetricView":
        import yaml

        doc = yaml.safe_load(text)

        def fields(items):
            out = []
            for it in items or []:
                meta = {k: v for k, v in it.items() if k not in ("name", "expr", "display_name")}
                out.append(ViewField(it["name"], str(it["expr"]).strip(),
                                     it.get("display_name", ""), meta))
            return tuple(out)

        return MetricView(str(doc["source"]), fields(doc.get("dimensions")),
                          fields(doc.get("measures")), str(doc.get("comment", "")), primary_key)

    def _dimension_name(self, word: re.Match) -> str:
        known = {d.name for d in self.dimensions}
        return f"__{word[0]}" if word[0] in known else word[0]

    def _measure(self, expr: str) -> Column:
        if self.primary_key:
            expr = re.sub(rf"count\s*\(\s*distinct\s+({_key_pattern(self.primary_key)})\s*\)",
                          r"count(\1)", expr, flags=re.I | re.S)
        return F.expr(expr)

    def query(self, df: DataFrame, dimensions: Sequence[str] = (),
              measures: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
        """Measures by dimensions; ``where`` is a condition on the view's dimensions."""
        if where:
            df = df.withColumns({f"__{d.name}": F.expr(d.expr) for d in self.dimensions}).filter(
                re.sub(r"'[^']*'|[A-Za-z_][A-Za-z0-9_]*", self._dimension_name, where)).drop(
                *[f"__{d.name}" for d in self.dimensions])
        dims = {d.name: d for d in self.dimensions}
        meas = {m.name: m for m in self.measures}
        chosen = list(measures) if measures is not None else list(meas)
        keys = [F.expr(dims[d].expr).alias(d) for d in dimensions]
        aggs = [self._measure(meas[m].expr).alias(m) for m in chosen]
        return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
