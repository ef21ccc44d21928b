"""Data-quality rules as data.

A ``Rule`` holds a condition over named columns.  Every report below
evaluates the whole rule list in one scan (``count_if`` per rule) instead of
one query per rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C


@dataclass(frozen=True)
class Rule:
    rule_id: int
    name: str
    condition: Callable[[], Column]
    action: str          # "remove" or "keep"
    reason: str


def default_rules(duration: str = S.DURATION, distance: str = S.DISTANCE,
                  passengers: str = S.PASSENGERS) -> list[Rule]:
    d, x, p = (lambda: F.col(duration)), (lambda: F.col(distance)), (lambda: F.col(passengers))
    return [
        Rule(1, "duration < 1 min", lambda: d() < S.MIN_DURATION, "remove",
             "meter artefacts / cancelled trips"),
        Rule(2, "distance < 0.1 mi", lambda: x() < S.MIN_DISTANCE, "remove",
             "no real travel"),
        Rule(3, "duration > 120 min AND distance < 2 mi",
             lambda: (d() > S.LONG_DURATION) & (x() < S.STUCK_DISTANCE), "remove",
             "meter left running"),
        Rule(4, "distance > 50 mi", lambda: x() > S.LONG_HAUL_MILES, "keep",
             "legitimate long haul, flagged"),
        Rule(5, "duration 1-2 min with distance >= 0.1 mi",
             lambda: (d() >= S.MIN_DURATION) & (d() < S.SHORT_DURATION) & (x() >= S.MIN_DISTANCE),
             "keep", "short but real trips"),
        Rule(6, "passenger_count > 6", lambda: p() > S.MAX_PASSENGERS, "remove",
             "exceeds the legal maximum"),
    ]


def keep_condition(rules: Sequence[Rule]) -> Column:
    """AND of NOT(remove-rule); a NULL in any rule makes the row not kept."""
    cond = None
    for r in rules:
        if r.action != "remove":
            continue
        c = ~r.condition()
        cond = c if cond is None else cond & c
    return cond if cond is not None else F.lit(True)


def removal_condition(rules: Sequence[Rule]) -> Column:
    """OR of the remove rules; a NULL can make it unknown (not counted)."""
    cond = None
    for r in rules:
        if r.action != "remove":
            continue
        c = r.condition()
        cond = c if cond is None else cond | c
    return cond if cond is not None else F.lit(False)


def clean_trips(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Keep rows that pass every removal rule (NULL drops the row)."""
    return df.where(keep_condition(rules or default_rules()))


def _stack(counts: DataFrame, n: int, row_exprs: Sequence[str], schema: str) -> DataFrame:
    return counts.selectExpr(f"stack({n}, {', '.join(row_exprs)}) AS ({schema})")


def rule_impact(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Count and percent of rows matched by each rule (removal and kept
    populations alike), all rules in one scan."""
    rules = rules or default_rules()
    counts = df.agg(F.count(F.lit(1)).alias("total"),
                    *[F.count_if(r.condition()).alias(f"r{r.rule_id}") for r in rules])
    spark = df.sparkSession
    meta = spark.createDataFrame([(r.rule_id, r.name, r.action) for r in rules],
                                 "rule_id INT, rule STRING, action STRING")
    long = _stack(counts, len(rules),
                  [f"{r.rule_id}, r{r.rule_id}, total" for r in rules],
                  "rule_id, rows_matched, total")
    out = F.broadcast(meta).join(long, "rule_id")
    return out.select("rule_id", "rule", "action", "rows_matched",
                      C.pct(F.col("rows_matched"), F.col("total")).alias("pct"))


def removal_union(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows removed by any rule, the remaining count, percent retained."""
    rules = rules or default_rules()
    agg = df.agg(F.count(F.lit(1)).alias("original_rows"),
                 F.count_if(removal_condition(rules)).alias("removed_rows"))
    kept = F.col("original_rows") - F.col("removed_rows")
    return agg.select("original_rows", "removed_rows", kept.alias("final_rows"),
                      C.pct(F.col("removed_rows"), F.col("original_rows")).alias("removed_pct"),
                      C.pct(kept, F.col("original_rows")).alias("retained_pct"))


def cleaning_reconcile(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Original, removed, predicted kept, actually kept and the NULL gap
    (rows neither counted removed nor kept)."""
    rules = rules or default_rules()
    agg = df.agg(F.count(F.lit(1)).alias("original_rows"),
                 F.count_if(removal_condition(rules)).alias("removed_rows"),
                 F.count_if(keep_condition(rules)).alias("kept_rows"))
    o, r, k = F.col("original_rows"), F.col("removed_rows"), F.col("kept_rows")
    return agg.select(o, r, (o - r).alias("predicted_kept"), k, (o - r - k).alias("null_gap"))


def rule_overlap(df: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """For every two rules (and each with itself): rows that match both, share
    of the rows of the first, and rows that match these and no other rule.

    Rows are counted once by the set of rules they match (a bit mask); the
    pairs add up the counts of at most 2^rules masks.  An unknown condition
    (NULL) is no match."""
    rules = rules or default_rules()
    bits = [F.when(r.condition(), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules)]
    masks = df.groupBy(sum(bits[1:], bits[0]).alias("mask")).agg(F.count(F.lit(1)).alias("cnt"))
    pairs = [(a.rule_id, b.rule_id, 1 << i | 1 << k, 1 << i) for i, a in enumerate(rules) for k, b in enumerate(rules) if i <= k]
    aggs = [expr for n, (_, _, both, one) in enumerate(pairs) for expr in (
        F.sum(F.when(F.col("mask").bitwiseAND(both) == both, F.col("cnt"))).alias(f"j{n}"),
        F.sum(F.when(F.col("mask") == both, F.col("cnt"))).alias(f"o{n}"),
        F.sum(F.when(F.col("mask").bitwiseAND(one) == one, F.col("cnt"))).alias(f"t{n}"))]
    long = _stack(masks.agg(*aggs), len(pairs), [f"{a}, {b}, coalesce(j{n}, 0L), coalesce(o{n}, 0L), t{n}" for n, (a, b, _, _) in enumerate(pairs)],
                  "rule_a, rule_b, both, no_other, total")
    return long.select("rule_a", "rule_b", "both", "no_other", C.pct(F.col("both"), F.col("total")).alias("pct_of_a"))


def cap_at_quantile(df: DataFrame, column: str = S.DISTANCE, prob: float = 0.999, method: str = "exact") -> DataFrame:
    """Rows whose ``column`` is at most its exact quantile; NULL and NaN rows
    go.  The threshold is a scalar subquery, so the filter reaches the scan."""
    from ..functions.quantiles import quantiles

    return df.where(F.col(column) <= quantiles(df, column, [prob], ["cap"], method=method).scalar())


def documented_rules(df: DataFrame, duration: str = S.DURATION, distance: str = S.DISTANCE,
                     passengers: str = S.PASSENGERS, ratecode: str = S.RATECODE,
                     vendor: str = S.VENDOR, max_minutes: float = 180.0,
                     max_miles: float = 200.0) -> DataFrame:
    """The stricter filter described in prose: positive duration up to 3 h,
    positive distance (at most 200 mi for standard-rate trips), 1-6
    passengers, known rate codes and vendors."""
    d, x = F.col(duration), F.col(distance)
    cond = ((d > 0) & (d <= max_minutes) & (x > 0)
            & ~((F.col(ratecode) == 1) & (x > max_miles))
            & F.col(passengers).between(S.PASSENGER_RANGE[0], S.PASSENGER_RANGE[1])
            & F.col(ratecode).isin(*S.VALID_RATECODE_IDS)
            & F.col(vendor).isin(*S.VALID_VENDOR_IDS))
    return df.where(cond)


def unusual_checks(duration: str = S.DURATION, distance: str = S.DISTANCE,
                   passengers: str = S.PASSENGERS) -> list[tuple[int, str, Column]]:
    d, x, p = F.col(duration), F.col(distance), F.col(passengers)
    conds = [d < 1, d > 120, x < 0.1, x > 50, p == 0, p > 6, (d > 1) & (x == 0)]
    return [(i + 1, label, c) for i, (label, c) in enumerate(zip(S.UNUSUAL_CHECK_LABELS, conds))]


def _flag_report(df: DataFrame, checks, extra: dict[int, str] | None = None,
                 extra_name: str = "verdict") -> DataFrame:
    spark = df.sparkSession
    counts = df.agg(F.count(F.lit(1)).alias("total"),
                    *[F.count_if(c).alias(f"k{i}") for i, _, c in checks])
    long = _stack(counts, len(checks), [f"{i}, k{i}, total" for i, _, _ in checks],
                  "check_id, rows_matched, total")
    if extra:
        meta = spark.createDataFrame([(i, label, extra[i]) for i, label, _ in checks],
                                     f"check_id INT, label STRING, {extra_name} STRING")
    else:
        meta = spark.createDataFrame([(i, label) for i, label, _ in checks],
                                     "check_id INT, label STRING")
    out = F.broadcast(meta).join(long, "check_id")
    return out.withColumn("pct", C.pct(F.col("rows_matched"), F.col("total"))).drop("total")


def unusual_values(df: DataFrame, **cols) -> DataFrame:
    """Seven named checks in one scan: count, percent, flagged (count > 0)."""
    out = _flag_report(df, unusual_checks(**cols))
    return out.select("check_id", "label", "rows_matched", "pct",
                      (F.col("rows_matched") > 0).alias("flagged"))


def unusual_values_found(df: DataFrame, **cols) -> DataFrame:
    """The checks of ``unusual_values`` that any row meets, the rarest first."""
    return unusual_values(df, **cols).where("flagged").orderBy("rows_matched", "check_id")


def outlier_conditions(duration: str = S.DURATION, distance: str = S.DISTANCE,
                       passengers: str = S.PASSENGERS) -> list[tuple[int, str, Column]]:
    d, x, p = F.col(duration), F.col(distance), F.col(passengers)
    conds = {1: d < 1, 2: (d >= 1) & (d < 2), 3: d > 120, 4: x < 0.1, 5: x > 50, 6: p > 6}
    return [(gid, label, conds[gid]) for gid, label, _ in S.OUTLIER_GROUPS]


def outlier_summary(df: DataFrame, **cols) -> DataFrame:
    """Six outlier groups: count, percent and verdict, one scan."""
    verdicts = {gid: v for gid, _, v in S.OUTLIER_GROUPS}
    out = _flag_report(df, outlier_conditions(**cols), verdicts)
    return out.select(F.col("check_id").alias("group_id"), "label", "rows_matched", "pct",
                      "verdict")


# ---------------------------------------------------------------------------
# Request validation (all violations per row, not only the first).
# ---------------------------------------------------------------------------
def request_checks() -> list[tuple[str, Column]]:
    def outside(c, lo, hi):
        return F.col(c).isNull() | ~F.col(c).between(lo, hi)

    return [
        # Like the reference's `< 0` test, NaN is not rejected (NaN < 0 is false).
        ("trip_distance must be >= 0", F.col(S.DISTANCE).isNull() | (F.col(S.DISTANCE) < 0)),
        ("passenger_count must be 1-6", outside(S.PASSENGERS, *S.PASSENGER_RANGE)),
        ("pickup_hour must be 0-23", outside(S.HOUR, *S.HOUR_RANGE)),
        ("pickup_day_of_week must be 0-6", outside(S.DOW, *S.DOW_RANGE)),
        ("pickup_month must be 1-12", outside(S.MONTH, *S.MONTH_RANGE)),
        ("PULocationID must be 1-265", outside(S.PU_ZONE, *S.ZONE_RANGE)),
        ("DOLocationID must be 1-265", outside(S.DO_ZONE, *S.ZONE_RANGE)),
        ("RatecodeID must be one of 1, 2, 3, 4, 5, 6, 99",
         F.col(S.RATECODE).isNull() | ~F.col(S.RATECODE).isin(*S.VALID_RATECODE_IDS)),
        ("VendorID must be 1 or 2",
         F.col(S.VENDOR).isNull() | ~F.col(S.VENDOR).isin(*S.VALID_VENDOR_IDS)),
    ]


def validate_requests(requests: DataFrame) -> DataFrame:
    """Adds ``violations`` (array of messages), ``is_valid``, the derived
    flags, and the weekday converted from Monday = 0 to the table's
    Sunday = 0 (``dow_sunday0``).  Missing RatecodeID / VendorID default to 1.
    """
    req = requests.withColumns({
        S.RATECODE: F.coalesce(F.col(S.RATECODE), F.lit(1)),
        S.VENDOR: F.coalesce(F.col(S.VENDOR), F.lit(1)),
    })
    msgs = F.array(*[F.when(bad, F.lit(msg)) for msg, bad in request_checks()])
    violations = F.filter(msgs, lambda m: m.isNotNull())
    return req.withColumns({
        "violations": violations,
        "is_valid": F.size(violations) == 0,
        S.WEEKEND: C.weekend_flag(S.DOW, S.WEEKEND_DAYS_MONDAY0),
        S.LONG_HAUL: C.long_haul_flag(S.DISTANCE),
        "dow_sunday0": F.pmod(F.col(S.DOW) + 1, F.lit(7)).cast("int"),
    })


def split_requests(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) views of validated requests - two filters over
    the same lazy plan, no extra pass until each is used."""
    return (validated.where(F.col("is_valid")), validated.where(~F.col("is_valid")))
