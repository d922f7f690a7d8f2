"""Fraud rules and the detector that composes them.

A rule adds one boolean column named ``flag`` and contributes ``reason`` to
``fraud_reasons``. Row rules are a single expression. Window rules are
defined by mergeable aggregates (count / sum / min / max) over a tumbling
event-time bucket per card plus a predicate on them; how the aggregates meet
the rows is chosen in :mod:`ledgerlake.operators.windows`.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import config as C
from ledgerlake.functions import any_true, country_of, reasons_of


class Rule:
    flag: str
    reason: str
    windowed: bool = False

    def apply(self, df: DataFrame) -> DataFrame:
        """Apply this rule alone (same result as inside a detector)."""
        return FraudDetector([self], keep_country=True, composites=False).apply(df)


@dataclass(frozen=True)
class RowRule(Rule):
    flag: str
    reason: str
    condition: Callable[[], Column]

    def expr(self) -> Column:
        return self.condition()


def high_amount_rule(threshold: float = C.HIGH_AMOUNT_THRESHOLD) -> RowRule:
    """amount strictly above the threshold (null amount -> null)."""
    return RowRule("is_high_amount", C.REASON_HIGH_AMOUNT, lambda: F.col("amount") > F.lit(threshold))


@dataclass(frozen=True)
class LookupRule(Rule):
    """``column`` is one of the values of a table (see ``operators.lookup``)."""

    flag: str
    reason: str
    column: str
    values: DataFrame = field(compare=False, hash=False)
    lookup: bool = True


def blacklisted_merchant_rule(merchants=C.BLACKLISTED_MERCHANTS) -> Rule:
    """merchant_id in the blacklist (null merchant -> null).

    A list becomes an ``isin``; a DataFrame (first column = merchant ids,
    for blacklists too large to inline) becomes a lookup join.
    """
    if isinstance(merchants, DataFrame):
        return LookupRule("is_blacklisted", C.REASON_BLACKLISTED, "merchant_id", merchants)
    values = sorted(set(merchants))
    return RowRule("is_blacklisted", C.REASON_BLACKLISTED, lambda: F.col("merchant_id").isin(values))


def bank_declined_rule() -> RowRule:
    """auth_result exactly ``DECLINED`` (case-sensitive, before cleaning)."""
    return RowRule("is_bank_declined", C.REASON_DECLINED, lambda: F.col("auth_result") == F.lit(C.DECLINED))


@dataclass(frozen=True)
class WindowRule(Rule):
    """Flag every row of a (card, tumbling bucket) group whose aggregates match.

    ``aggregates`` maps a name to an aggregate expression that Spark can
    combine map-side; ``predicate`` gets a lookup from those names to
    columns. Rows with a null card or event time are never flagged.

    ``grouped_aggregates`` / ``grouped_predicate`` optionally give an
    equivalent form for ``groupBy`` plans only (e.g. a distinct count,
    which Spark plans as hash aggregates but allows neither over windows
    nor in streaming state).

    ``rollup`` names, per aggregate, how partial values of sub-buckets merge
    (``"sum"``, ``"min"`` or ``"max"``): with it, the aggregates of a bucket
    are exactly the merge of those of the finer epoch-aligned buckets inside
    it, which lets one stateful query serve several durations.
    """

    flag: str
    reason: str
    duration: str
    aggregates: Callable[[], dict[str, Column]]
    predicate: Callable[[Callable[[str], Column]], Column]
    grouped_aggregates: Callable[[], dict[str, Column]] | None = None
    grouped_predicate: Callable[[Callable[[str], Column]], Column] | None = None
    rollup: tuple[tuple[str, str], ...] | None = None
    windowed: bool = True

    def group_form(self):
        """(aggregates, predicate) to use under ``groupBy``."""
        if self.grouped_aggregates is None:
            return self.aggregates, self.predicate
        return self.grouped_aggregates, self.grouped_predicate


def _declined_indicator() -> Column:
    return F.when(F.col("auth_result") == F.lit(C.DECLINED), F.lit(1)).otherwise(F.lit(0))


def high_velocity_rule(max_txn: int = C.VELOCITY_MAX_TXN, duration: str = C.VELOCITY_WINDOW) -> WindowRule:
    """More than ``max_txn`` payments of one card in one bucket."""
    return WindowRule(
        "is_high_velocity",
        C.REASON_VELOCITY,
        duration,
        lambda: {"velocity_count": F.count(F.lit(1))},
        lambda a: a("velocity_count") > F.lit(max_txn),
        rollup=(("velocity_count", "sum"),),
    )


def cross_border_rule(duration: str = C.CROSS_BORDER_WINDOW) -> WindowRule:
    """More than one distinct country for one card in one bucket.

    Two distinct non-null values exist exactly when the smallest differs from
    the largest, which also merges over sub-buckets. Their 64-bit hashes stand
    for the countries: extremes of longs are hash aggregates, those of strings
    would sort every row. The report of single windows counts the countries.
    """
    country = F.when(F.col("country").isNotNull(), F.xxhash64("country"))
    return WindowRule(
        "is_cross_border",
        C.REASON_CROSS_BORDER,
        duration,
        lambda: {"country_min": F.min(country), "country_max": F.max(country)},
        lambda a: a("country_min") != a("country_max"),
        lambda: {"country_count": F.count_distinct("country")},
        lambda a: a("country_count") > F.lit(1),
        rollup=(("country_min", "min"), ("country_max", "max")),
    )


def high_decline_rate_rule(limit: float = C.DECLINE_RATE_LIMIT, duration: str = C.DECLINE_RATE_WINDOW) -> WindowRule:
    """Share of ``DECLINED`` payments of one card in one bucket above ``limit``."""
    return WindowRule(
        "is_high_decline_rate",
        C.REASON_DECLINE_RATE,
        duration,
        lambda: {"total_txn": F.count(F.lit(1)), "declined_txn": F.sum(_declined_indicator())},
        lambda a: (a("declined_txn") / a("total_txn")) > F.lit(limit),
        rollup=(("total_txn", "sum"), ("declined_txn", "sum")),
    )


def rules_from_config(cfg: C.PipelineConfig = C.DEFAULT_CONFIG) -> list[Rule]:
    """The configured rules, in ``cfg.rule_names`` order."""
    factories = {
        "high_amount": lambda: high_amount_rule(cfg.amount_threshold),
        "blacklisted": lambda: blacklisted_merchant_rule(cfg.blacklisted_merchants),
        "bank_declined": bank_declined_rule,
        "high_velocity": lambda: high_velocity_rule(cfg.velocity_max_txn, cfg.velocity_window),
        "cross_border": lambda: cross_border_rule(cfg.cross_border_window),
        "high_decline_rate": lambda: high_decline_rate_rule(cfg.decline_rate_limit, cfg.decline_rate_window),
    }
    unknown = [n for n in cfg.rule_names if n not in factories]
    if unknown:
        raise ValueError(f"unknown rules: {unknown}")
    return [factories[n]() for n in cfg.rule_names]


class FraudDetector:
    """Apply an ordered rule list; add ``fraud_reasons`` and ``is_fraud``.

    ``is_fraud`` is the SQL three-valued OR of all flags (a null flag is
    masked only by a true one). Flags and ``country`` are kept, as the
    deployed Bronze stage keeps them.
    """

    def __init__(
        self,
        rules: list[Rule],
        strategy: str = "auto",
        keep_flags: bool = True,
        keep_country: bool = True,
        composites: bool = True,
        card_col: str = "card_hash",
        time_col: str = "event_time",
        windows_from_state: bool = False,
    ):
        flags = [r.flag for r in rules]
        if len(set(flags)) != len(flags):
            raise ValueError(f"duplicate rule flags: {flags}")
        self.rules = list(rules)
        self.strategy = strategy
        self.keep_flags = keep_flags
        self.keep_country = keep_country
        self.composites = composites
        self.card_col = card_col
        self.time_col = time_col
        self.windows_from_state = windows_from_state

    @classmethod
    def from_config(cls, cfg: C.PipelineConfig = C.DEFAULT_CONFIG, **kw) -> "FraudDetector":
        stateful = cfg.window_scope == "stateful"
        return cls(rules_from_config(cfg), strategy=cfg.window_strategy, windows_from_state=stateful, **kw)

    def apply(self, df: DataFrame) -> DataFrame:
        from ledgerlake.operators.windows import flag_windows

        if "country" not in df.columns:
            df = df.withColumn("country", country_of("location"))
        row_rules = [r for r in self.rules if isinstance(r, RowRule)]
        if row_rules:
            df = df.withColumns({r.flag: r.expr() for r in row_rules})
        for r in self.rules:
            if isinstance(r, LookupRule):
                from ledgerlake.operators.lookup import flag_membership

                df = flag_membership(df, r.column, r.values, r.flag)
        win_rules = [r for r in self.rules if r.windowed]
        if win_rules and self.windows_from_state:
            missing = [r.flag for r in win_rules if r.flag not in df.columns]
            if missing:
                raise ValueError(f"window scope 'stateful' needs the window flags decided before: {missing}")
        elif win_rules:
            df = flag_windows(df, win_rules, self.strategy, self.card_col, self.time_col)
        if self.composites:
            df = self.with_verdict(df)
        drop = []
        if not self.keep_flags:
            drop += [r.flag for r in self.rules]
        if not self.keep_country:
            drop.append("country")
        return df.drop(*drop) if drop else df

    def with_verdict(self, df: DataFrame) -> DataFrame:
        """``fraud_reasons`` and ``is_fraud`` from the flags."""
        reasons = [(F.col(r.flag), r.reason) for r in self.rules]
        return df.withColumns(
            {
                "fraud_reasons": reasons_of(reasons, C.REASON_SEPARATOR),
                "is_fraud": any_true([F.col(r.flag) for r in self.rules]),
            }
        )
