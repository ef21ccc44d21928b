"""Exact, linearly interpolated quantiles (``PERCENTILE_CONT``) that never
hold a whole group in one task.

``method="exact"`` (default) selects by buckets, in the JVM only:

1. Every value has a bucket that is a monotone function of it (steps of its
   logarithm), so nothing has to be sketched first.  One scan gives rows, least
   and greatest value for each (group, bucket), with any plain aggregates the
   report needs besides: at most groups x buckets rows, written once.
2. Running counts over that small table give the buckets that hold the ranks
   ``floor((n-1)p)`` and ``ceil((n-1)p)`` of each group.
3. If such a bucket has more rows than a task should rank, the buckets wanted
   are cut into equal steps of their own range and counted again, over their
   rows only, until none is too large or holds more than one value.
4. Only rows of the wanted (group, bucket) pairs are ranked: a join with the
   pairs drops all others before the shuffle, repeated values collapse on the
   map side, and a window over the pair gives running counts.

Groups may overlap (``groups``): rows are counted by disjoint *atoms* only,
and the counts of atoms are added up into the groups they belong to.

Buckets depend on values alone, so a recomputation after a lost executor
gives the same answer.

``method="approx"`` uses ``percentile_approx`` (bounded sketch per group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import write_through

#: Buckets for each doubling of a value, pieces that a bucket is cut into, how
#: often (all steps of a double are then told apart), and the rows of one
#: (group, bucket) that a task may rank without a further cut.
STEPS, PIECES, CUTS = 64, 1024, 4
RANKED_ROWS = 1 << 20


def quantiles(df: DataFrame, value: str | Column, probs: Sequence[float],
              names: Sequence[str] | None = None, by: Sequence[str] = (),
              method: str = "exact", accuracy: int = 100000, steps: int | None = None,
              extra: Sequence[tuple[str, str, str | None]] = (),
              groups: DataFrame | None = None, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """One row per group of ``by`` with one column per probability.

    ``extra`` adds plain per-group aggregates ``(name, kind, column)`` with
    kind ``count`` (column ``None`` counts rows), ``sum``, ``avg``, ``min`` or
    ``max``, over all rows of the group (NULL values of ``value`` included).
    The exact method computes them in its first scan.

    ``groups`` makes groups of atoms: a small frame with the columns ``by``
    and further ones, which become the keys of the result.  An atom may be in
    several groups or none.
    """
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 1000)):04d}" for p in probs]
    v = F.col(value) if isinstance(value, str) else value
    extra = list(extra)
    cols = list(dict.fromkeys(c for _, _, c in extra if c))
    data = df.select(*[F.col(b) for b in by], v.cast("double").alias("_v"),
                     *[F.col(c).alias(f"_x{i}") for i, c in enumerate(cols)])
    extra = [(n, k, f"_x{cols.index(c)}" if c else None) for n, k, c in extra]
    if method == "exact":
        return _exact(data, probs, names, by, extra, groups, steps or STEPS, ranked_rows)
    if method != "approx":
        raise ValueError(f"unknown quantile method {method!r}")
    if groups is not None:
        data = _join_null_safe(data, groups, by).drop(*by)
        by = [c for c in groups.columns if c not in by]
    arr = F.percentile_approx("_v", list(probs), accuracy)
    out = data.groupBy(*by).agg(arr.alias("_q"), *[_plain(n, k, c) for n, k, c in extra])
    return out.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], *[n for n, _, _ in extra])


def multi_quantiles(df: DataFrame, specs: Sequence[tuple[str, float, str]],
                    by: Sequence[str] = (), method: str = "exact",
                    extra: Sequence[tuple[str, str, str | None]] = (),
                    groups: DataFrame | None = None) -> DataFrame:
    """Several (column, probability, output name) quantiles in ONE pass:
    the columns are unpivoted into (metric, value) rows and the metric joins
    the grouping key.  ``extra`` and ``groups`` as in :func:`quantiles`;
    columns of ``extra`` that are no quantile columns ride on the rows of the
    first metric."""
    by = list(by)
    cols = list(dict.fromkeys(c for c, _, _ in specs))
    probs = sorted(set(p for _, p, _ in specs))
    extra = list(extra)
    names = [f"_p{i}" for i in range(len(probs))]
    if len(cols) == 1:
        q = quantiles(df, cols[0], probs, names, by=by, method=method, extra=extra, groups=groups)
        keys = by if groups is None else [c for c in groups.columns if c not in by]
        return q.select(*keys, *[F.col(f"_p{probs.index(p)}").alias(out) for _, p, out in specs],
                        *[n for n, _, _ in extra])
    riders = list(dict.fromkeys(c for _, _, c in extra if c and c not in cols))
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_x"),
                 *[(F.col(r) if i == 0 else F.lit(None).cast(df.schema[r].dataType)).alias(f"_r{k}") for k, r in enumerate(riders)])
        for i, c in enumerate(cols)]))
    long = df.select(*by, pairs.alias("_mx")).select(*by, "_mx.*")
    # Per metric: each kind once over _x, riders once; rows of a group = rows of metric 0.
    inner = {}
    for n, k, c in extra:
        inner[n] = (f"_k{k}", k, "_x") if c in cols else (f"_k{k}_{riders.index(c)}", k, f"_r{riders.index(c)}") if c else ("_rows", k, None)
    if groups is not None:
        metrics = F.explode(F.array(*[F.lit(i) for i in range(len(cols))]))
        groups = groups.select(*by, metrics.alias("_m"), *[c for c in groups.columns if c not in by], F.col("_m").alias("_gm"))
    q = quantiles(long, "_x", probs, names, by=by + ["_m"], method=method, extra=list(dict.fromkeys(inner.values())), groups=groups)
    metric = "_m" if groups is None else "_gm"
    keys = by if groups is None else [c for c in groups.columns if c not in (*by, "_m", "_gm")]
    outs = [F.max(F.when(F.col(metric) == cols.index(c), F.col(f"_p{probs.index(p)}"))).alias(out)
            for c, p, out in specs]
    outs += [F.max(F.when(F.col(metric) == (cols.index(c) if c in cols else 0), F.col(inner[n][0]))).alias(n) for n, k, c in extra]
    return q.groupBy(*keys).agg(*outs)


def _pos(p: float) -> str:
    """SQL for the fractional rank (n-1)p (DOUBLE, as PERCENTILE_CONT)."""
    return f"(CAST(_n - 1 AS DOUBLE) * CAST('{float(p)!r}' AS DOUBLE))"


def _pick(ranked: DataFrame, probs: Sequence[float], names: Sequence[str],
          by: list[str]) -> DataFrame:
    """From rows (by, _v, _c, _start, _n) pick the values at ranks
    floor((n-1)p) and ceil((n-1)p) and interpolate (PERCENTILE_CONT).

    Expressions are SQL strings: one call each to build, however many
    probabilities there are."""
    aggs = [F.max("_n").alias("_n")]
    for i, p in enumerate(probs):
        for side, fn in (("lo", "floor"), ("hi", "ceil")):
            r = f"{fn}({_pos(p)})"
            aggs.append(F.expr(
                f"max(CASE WHEN _start <= {r} AND {r} < _start + _c THEN _v END) AS _{side}{i}"))
    picked = ranked.groupBy(*by).agg(*aggs)
    outs = [F.expr(f"CASE WHEN floor({_pos(p)}) = ceil({_pos(p)}) THEN _lo{i} "
                   f"ELSE _lo{i} + (_hi{i} - _lo{i}) * ({_pos(p)} - floor({_pos(p)})) END "
                   f"AS `{n}`")
            for i, (p, n) in enumerate(zip(probs, names))]
    return picked.select(*by, *outs)


def _plain(name: str, kind: str, col: str | None) -> Column:
    c = F.lit(1) if col is None else F.col(col)
    return {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[kind](c).alias(name)


def _partials(extra) -> tuple[list[Column], list[Column]]:
    """Partial aggregates of each (group, bucket), and what adds them up."""
    part, roll = [], []
    for i, (name, kind, col) in enumerate(extra):
        c = F.lit(1) if col is None else F.col(col)
        if kind == "count":
            part.append(F.count(c).alias(f"_e{i}"))
            roll.append(F.coalesce(F.sum(f"_e{i}"), F.lit(0)).cast("long").alias(name))
        elif kind in ("min", "max", "sum"):
            part.append(getattr(F, kind)(c).alias(f"_e{i}"))
            roll.append(getattr(F, kind)(f"_e{i}").alias(name))
        elif kind == "avg":
            part += [F.sum(c.cast("double")).alias(f"_e{i}"), F.count(c).alias(f"_e{i}n")]
            roll.append(F.try_divide(F.sum(f"_e{i}"), F.sum(f"_e{i}n")).alias(name))
        else:
            raise ValueError(f"unknown aggregate kind {kind!r}")
    return part, roll


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; the left side's keys stay."""
    on = list(on)
    names = {c: f"_jk{i}" for i, c in enumerate(on)}
    right = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(names[c]))
    return left.join(right, cond, how).drop(*names.values())


def first_bucket(steps: int) -> Column:
    """The bucket of ``_v``, rising with it: ``steps`` for each doubling of
    1 + |v|, then infinity, then NaN (which sorts last)."""
    top = 1025 * steps
    size = F.expr(f"CAST(floor(log2(1 + abs(_v)) * {steps}) AS BIGINT)")
    return (F.when(F.isnan("_v"), top + 2)
            .when(F.abs("_v") == float("inf"), F.signum("_v").cast("long") * (top + 1))
            .otherwise(F.signum("_v").cast("long") * size))


def cut_bucket() -> Column:
    """The piece of ``_b`` (with the range ``_mn`` to ``_mx``) that holds ``_v``."""
    share = (F.col("_v") - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * PIECES
    return F.col("_b") * PIECES + F.when(F.col("_mx") > F.col("_mn"), F.least(F.floor(share), F.lit(PIECES - 1))).otherwise(0)


def _wanted(counts: DataFrame, probs) -> DataFrame:
    """Of buckets with their rows ``_bc``, offset ``_off`` and group's size
    ``_n``: those that hold a wanted rank."""
    holds = " OR ".join(f"(_off <= {fn}({_pos(p)}) AND {fn}({_pos(p)}) < _off + _bc)"
                        for p in probs for fn in ("floor", "ceil"))
    return counts.where(F.expr(holds))


def _exact(data: DataFrame, probs, names, by: list[str], extra, groups: DataFrame | None,
           steps: int, ranked_rows: int) -> DataFrame:
    keys = by if groups is None else [c for c in groups.columns if c not in by]
    part, roll = _partials(extra)
    whole = [F.count("_v").alias("_bc"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")]
    added = [F.sum("_bc").alias("_bc"), F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx")]

    def grouped(counts: DataFrame, aggs) -> DataFrame:
        """Counts of atoms as counts of groups."""
        if groups is None:
            return counts
        return _join_null_safe(counts, groups, by).groupBy(*keys, "_b").agg(*aggs)

    bucketed = data.withColumn("_b", F.when(F.col("_v").isNotNull(), first_bucket(steps)))
    seen = Observation()
    atoms = write_through(bucketed.groupBy(*by, "_b").agg(*whole, *part).observe(seen, F.max("_bc").alias("most")), "quantile-counts")
    summary = (atoms if groups is None else _join_null_safe(atoms, groups, by)).groupBy(*keys).agg(*roll) if extra else None

    group, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = grouped(atoms.where("_b is not null"), added)
    counts = counts.select(*keys, "_b", "_bc", "_mn", "_mx", F.coalesce(F.sum("_bc").over(before), F.lit(0)).alias("_off"), F.sum("_bc").over(group).alias("_n"))
    wanted = _wanted(counts, probs)
    rows = bucketed.where("_v is not null").select(*by, "_v", "_b")

    def of_wanted(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """The rows of wanted (atom, bucket) pairs."""
        pairs = wanted.select(*keys, "_b") if groups is None else _join_null_safe(groups, wanted.select(*keys, "_b"), keys).select(*by, "_b").distinct()
        return _join_null_safe(rows, pairs, [*by, "_b"])

    # What the write has seen tells cheaply whether any bucket can be large; a group holds at most all atoms.
    most = (seen.get["most"] or 0) * (1 if groups is None else groups.select(*by).distinct().count())
    for _ in range(CUTS if most > ranked_rows else 0):
        large = wanted.where("_mn < _mx").agg(F.max("_bc")).first()[0] or 0
        if large <= ranked_rows:
            break
        # The range of a bucket over all groups, so that its pieces mean the same in each.
        ranges = wanted.groupBy("_b").agg(F.min("_mn").alias("_mn"), F.max("_mx").alias("_mx"))
        rows = _join_null_safe(of_wanted(rows, wanted), ranges, ["_b"]).withColumn("_up", F.col("_b")).withColumn("_b", cut_bucket())
        pieces = write_through(rows.groupBy(*by, "_up", "_b").agg(*whole), "quantile-counts")
        inner = grouped(pieces, [F.first("_up").alias("_up"), *added])
        inside = Window.partitionBy(*keys, "_up").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        parents = wanted.select(*keys, F.col("_b").alias("_up"), "_off", "_n")
        inner = _join_null_safe(inner.withColumn("_in", F.coalesce(F.sum("_bc").over(inside), F.lit(0))), parents, [*keys, "_up"])
        wanted = _wanted(inner.select(*keys, "_b", "_bc", "_mn", "_mx", (F.col("_off") + F.col("_in")).alias("_off"), "_n"), probs)
        rows = rows.select(*by, "_v", "_b")

    counted = of_wanted(rows, wanted).groupBy(*by, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))
    if groups is not None:
        counted = _join_null_safe(counted, groups, by).groupBy(*keys, "_b", "_v").agg(F.sum("_c").alias("_c"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = counted.withColumn("_before", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    ranked = _join_null_safe(local, wanted.select(*keys, "_b", "_off", "_n"), [*keys, "_b"])
    picked = _pick(ranked.select(*keys, "_v", "_c", (F.col("_off") + F.col("_before")).alias("_start"), "_n"), probs, names, keys)
    if not extra:
        return picked
    return attach(summary, picked, keys).select(*keys, *names, *[n for n, _, _ in extra])


def attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Null-safe join of two per-group results (both one row per group).

    Without keys ``right`` is a global aggregate (exactly one row): it is
    attached as one scalar subquery returning a struct, so no join is
    planned at all."""
    by = list(by)
    if not by:
        sub = right.select(F.struct(*[F.col(c) for c in right.columns]).alias("_s")).scalar()
        return left.select("*", sub.alias("_s")).select(
            *[F.col(c) for c in left.columns], *[F.col(f"_s.{c}").alias(c) for c in right.columns])
    rk = {b: f"_rk{i}" for i, b in enumerate(by)}
    r = right.select(*[F.col(c).alias(rk.get(c, c)) for c in right.columns])
    cond = None
    for b in by:
        c = F.col(b).eqNullSafe(F.col(rk[b]))
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*rk.values())
