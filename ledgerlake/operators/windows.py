"""Evaluate window rules: per-(card, tumbling bucket) aggregates -> row flags.

Strategies (same flags, different physical plans, every one a lazy plan that
runs no job and writes nothing while it is built):

``join`` (also ``auto``, the default at every size)
    One aggregate per (card, shortest bucket) of the incoming rows -- partial
    aggregation combines a hot card map-side, so the shuffle carries one row
    per group and task. Longer durations are rolled up from these groups with
    window functions over at most duration / shortest of them. Only groups
    where a rule fires are left-joined back, once, on (card, shortest bucket).
    Adaptive execution broadcasts them if their real bytes allow; else the
    firing groups have a shuffle of their own (see :func:`shuffle_side`), so
    that it can split a hot (card, bucket) on the row side.
``broadcast``
    As ``join`` without that extra shuffle of the firing groups; whether they
    are broadcast is left to Spark's threshold.
``window``
    Window aggregates over ``partitionBy(card, bucket)``: one shuffle per
    bucket duration, no join, but a hot (card, bucket) group is one task.

Durations that are not multiples of the shortest, or rules that cannot be
rolled up, get one aggregate and one join per duration, all from the incoming
rows.
"""

from __future__ import annotations

import re
from collections import OrderedDict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import bucket_start, duration_micros

_SIZE = re.compile(r"^\s*(-?\d+)\s*([kmgt]?)(i?b)?\s*$", re.I)


def _bytes(value: str | None, default: int) -> int:
    if value is None:
        return default
    m = _SIZE.match(str(value))
    if not m:
        return default
    n = int(m.group(1))
    return n * {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}[m.group(2).lower()]


def broadcast_threshold(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (-1: broadcasting off)."""
    return _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"), 10 << 20)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (no job runs), or None if unknown."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate available
        return None
    default = _bytes(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(1 << 62)), 1 << 62)
    return None if size >= default else size


def shuffle_side(small: DataFrame, unless_broadcast: bool = False) -> DataFrame:
    """Give an aggregated join side its own shuffle for the join.

    Without it the join reuses the aggregate's exchange (the aggregate is
    already hash-partitioned on the join keys), and AQE's skew-join rule,
    which needs both join inputs to be plain shuffle stages, cannot split a
    hot key's partition on the row side. The ``rebalance`` shuffle moves
    only the (small) aggregated rows and AQE coalesces its partitions.

    ``unless_broadcast``: leave the side alone when Catalyst's estimate of it
    fits the broadcast threshold, since Catalyst will broadcast it anyway
    (used where no count has decided the join).
    """
    if unless_broadcast:
        size, limit = estimated_bytes(small), broadcast_threshold(small)
        if size is not None and 0 < limit and size <= limit:
            return small
    return small.hint("rebalance")


def _group_by_duration(rules) -> "OrderedDict[int, list]":
    groups: OrderedDict[int, list] = OrderedDict()
    for r in rules:
        groups.setdefault(duration_micros(r.duration), []).append(r)
    return groups


def _named_aggs(rules, grouped: bool = False) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for r in rules:
        aggs = r.group_form()[0] if grouped else r.aggregates
        for name, agg in aggs().items():
            out[f"_wa_{r.flag}_{name}"] = agg
    return out


def _predicate(rule, grouped: bool = False):
    return rule.group_form()[1] if grouped else rule.predicate


def firing_groups(
    df: DataFrame,
    group: list,
    bucket: Column,
    card_col: str = "card_hash",
    time_col: str = "event_time",
) -> DataFrame:
    """The (card, bucket) groups of one duration where at least one rule fires.

    Columns ``_wk_card``, ``_wk_bkt`` and one ``_wf_<flag>`` per rule. A hash
    aggregate with partial (map-side) combine: a card holding a third of all
    rows becomes one row per map task before the shuffle.
    """
    keyed_ok = F.col(card_col).isNotNull() & F.col(time_col).isNotNull()
    aggs = _named_aggs(group, grouped=True)
    fired = {
        f"_wf_{r.flag}": F.coalesce(_predicate(r, True)(lambda n, r=r: F.col(f"_wa_{r.flag}_{n}")), F.lit(False))
        for r in group
    }
    return (
        df.filter(keyed_ok)
        .groupBy(F.col(card_col).alias("_wk_card"), bucket.alias("_wk_bkt"))
        .agg(*[a.alias(n) for n, a in aggs.items()])
        .select("_wk_card", "_wk_bkt", *[c.alias(n) for n, c in fired.items()])
        .filter(" OR ".join(f"`{n}`" for n in fired))
    )


_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


def rolled_up(rules) -> str | None:
    """The shortest duration, if the aggregates of every rule can be merged from its buckets."""
    if any(r.rollup is None for r in rules):
        return None
    finest = min(rules, key=lambda r: duration_micros(r.duration))
    base = duration_micros(finest.duration)
    return None if any(duration_micros(r.duration) % base for r in rules) else finest.duration


def firing_buckets(
    df: DataFrame, rules, base: str, card_col: str = "card_hash", time_col: str = "event_time"
) -> DataFrame:
    """(card, ``base`` bucket) groups inside a firing window of any rule: ``_wk_card``, ``_wk_bkt``, ``_wf_<flag>``."""
    keyed_ok = F.col(card_col).isNotNull() & F.col(time_col).isNotNull()
    aggs = _named_aggs(rules)
    groups = (
        df.filter(keyed_ok)
        .groupBy(F.col(card_col).alias("_wk_card"), bucket_start(time_col, base).alias("_wk_bkt"))
        .agg(*[a.alias(n) for n, a in aggs.items()])
    )
    return firing_of_buckets(groups, rules, base)


def firing_of_buckets(groups: DataFrame, rules, base: str) -> DataFrame:
    """:func:`firing_buckets` from aggregates (``_wk_card``, ``_wk_bkt``, ``_wa_...``) that are there already."""
    fired = {}
    for micros, group in _group_by_duration(rules).items():
        if micros == duration_micros(base):
            at = F.col
        else:
            whole = Window.partitionBy("_wk_card", bucket_start(F.col("_wk_bkt"), group[0].duration))
            how = {f"_wa_{r.flag}_{n}": m for r in group for n, m in r.rollup}
            at = lambda c, how=how, whole=whole: _MERGE[how[c]](c).over(whole)
        for r in group:
            fired[f"_wf_{r.flag}"] = F.coalesce(
                r.predicate(lambda n, r=r, at=at: at(f"_wa_{r.flag}_{n}")), F.lit(False)
            )
    return groups.select("_wk_card", "_wk_bkt", *[c.alias(n) for n, c in fired.items()]).filter(
        " OR ".join(f"`{n}`" for n in fired)
    )


def flag_windows(
    df: DataFrame,
    rules,
    strategy: str = "auto",
    card_col: str = "card_hash",
    time_col: str = "event_time",
) -> DataFrame:
    """Add one boolean column per rule."""
    if strategy not in ("auto", "join", "window", "broadcast"):
        raise ValueError(f"unknown window strategy {strategy!r}")
    if strategy == "window":
        keyed_ok = F.col(card_col).isNotNull() & F.col(time_col).isNotNull()
        for group in _group_by_duration(rules).values():
            df = df.withColumn("_wb", bucket_start(time_col, group[0].duration))
            w = Window.partitionBy(card_col, "_wb")
            over = {n: a.over(w) for n, a in _named_aggs(group).items()}
            df = df.withColumns(
                {
                    r.flag: keyed_ok & F.coalesce(r.predicate(lambda n, r=r: over[f"_wa_{r.flag}_{n}"]), F.lit(False))
                    for r in group
                }
            ).drop("_wb")
        return df

    base = rolled_up(rules)
    if base is not None:
        sides = [(base, rules, firing_buckets(df, rules, base, card_col, time_col))]
    else:
        sides = [
            (g[0].duration, g, firing_groups(df, g, bucket_start(time_col, g[0].duration), card_col, time_col))
            for g in _group_by_duration(rules).values()
        ]
    out = df
    for duration, group, side in sides:
        out = _flagged(out, side, group, duration, strategy, card_col, time_col)
    return out


def _flagged(df, side, rules, duration: str, strategy: str, card_col: str, time_col: str) -> DataFrame:
    """Left join the firing groups of one duration: a boolean column per rule."""
    if strategy != "broadcast":
        side = shuffle_side(side, unless_broadcast=True)
    df = df.withColumn("_wb", bucket_start(time_col, duration))
    joined = df.join(side, (F.col(card_col) == F.col("_wk_card")) & (F.col("_wb") == F.col("_wk_bkt")), "left")
    return joined.withColumns({r.flag: F.coalesce(F.col(f"_wf_{r.flag}"), F.lit(False)) for r in rules}).drop(
        "_wk_card", "_wk_bkt", "_wb", *[f"_wf_{r.flag}" for r in rules]
    )


def flag_by_buckets(
    df: DataFrame, groups: DataFrame, rules, card_col: str = "card_hash", time_col: str = "event_time"
) -> DataFrame:
    """As :func:`flag_windows`, from aggregates per (card, shortest bucket) that were kept elsewhere."""
    base = rolled_up(rules)
    return _flagged(df, firing_of_buckets(groups, rules, base), rules, base, "auto", card_col, time_col)


def window_groups(
    df: DataFrame,
    rule,
    card_col: str = "card_hash",
    time_col: str = "event_time",
) -> DataFrame:
    """The firing (card, window) groups of one window rule with its aggregates.

    Columns: card_hash, window_start, window_end, then the rule's aggregates.
    """
    from ledgerlake.functions import bucket_end

    agg_fn, predicate = rule.group_form()
    aggs = agg_fn()
    start = bucket_start(time_col, rule.duration)
    grouped = (
        df.filter(F.col(card_col).isNotNull() & F.col(time_col).isNotNull())
        .groupBy(F.col(card_col).alias("card_hash"), start.alias("window_start"))
        .agg(*[a.alias(n) for n, a in aggs.items()])
    )
    return grouped.filter(F.coalesce(predicate(F.col), F.lit(False))).select(
        "card_hash",
        "window_start",
        bucket_end(F.col("window_start"), rule.duration).alias("window_end"),
        *aggs.keys(),
    )
