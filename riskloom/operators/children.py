"""One row per applicant out of the transaction-level child tables.

A profile is data: derived columns, measures and ratios over the measures. Subset
measures (active, approved, refused) are conditional aggregates of the same pass,
so each child table is scanned and shuffled once. All measures are algebraic:
partial aggregation on the map side keeps a hot applicant to one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import (
    clip,
    code_map,
    flag,
    guarded_ratio,
    negative_part,
    positive_part,
    zero_to_null,
)

KEY = "SK_ID_CURR"
# Derived columns in levels: a level may use the columns of the levels before it.
Derived = Sequence[Mapping[str, Callable[[], Column]]]


@dataclass(frozen=True)
class Measure:
    """``fn`` of ``column``, over the rows flagged by ``subset`` if one is named."""

    name: str
    fn: str
    column: str
    subset: str | None = None


@dataclass(frozen=True)
class Profile:
    measures: Sequence[Measure]
    derived: Derived = ()
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def measure_column(m: Measure) -> Column:
    fn = {"mean": "avg"}.get(m.fn, m.fn)
    if m.subset is None:
        body = f"{fn}(`{m.column}`)"
        return F.expr(f"coalesce({body}, 0)" if fn == "sum" else body).alias(m.name)
    body = f"{fn}(`{m.column}`) FILTER (WHERE `{m.subset}` = 1)"
    if fn == "sum":
        body = f"coalesce({body}, 0)"
    if fn in ("sum", "count"):
        # An applicant without a row in the subset has no measure at all, not a zero.
        body = f"CASE WHEN count_if(`{m.subset}` = 1) > 0 THEN {body} END"
    return F.expr(body).alias(m.name)


def profile_children(df: DataFrame, profile: Profile, key: str = KEY) -> DataFrame:
    """Aggregate a child table to one row per non-null key."""
    rows = df.where(F.col(key).isNotNull())
    for level in profile.derived:
        rows = rows.withColumns({name: build() for name, build in level.items()})
    out = rows.groupBy(key).agg(*[measure_column(m) for m in profile.measures])
    return add_ratios(out, profile.ratios)


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Guarded ratios of two measures; a missing count in the numerator counts as zero."""
    texts = [
        f"CASE WHEN `{b}` = 0 THEN 0D ELSE"
        f" try_divide(CAST(coalesce(`{a}`, 0) AS DOUBLE), CAST(`{b}` AS DOUBLE)) END AS `{name}`"
        for name, (a, b) in ratios.items()
    ]
    return df.selectExpr("*", *texts)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _one(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(1.0))


# Names and definitions of the measures below are the output contract.

BUREAU = Profile(
    derived=[
        {
            "_active": lambda: flag(F.col("CREDIT_ACTIVE") == "Active"),
            "_overdue": lambda: flag(F.col("CREDIT_DAY_OVERDUE") > 0),
            "_use": lambda: guarded_ratio(_zero("AMT_CREDIT_SUM_DEBT"), _one("AMT_CREDIT_SUM")),
        },
    ],
    measures=[
        Measure("BUREAU_LOAN_COUNT", "count", "SK_ID_BUREAU"),
        Measure("BUREAU_ACTIVE_COUNT", "sum", "_active"),
        Measure("BUREAU_OVERDUE_COUNT", "sum", "_overdue"),
        Measure("BUREAU_PROLONG_COUNT", "sum", "CNT_CREDIT_PROLONG"),
        Measure("BUREAU_CREDIT_SUM_MEAN", "mean", "AMT_CREDIT_SUM"),
        Measure("BUREAU_CREDIT_SUM_MAX", "max", "AMT_CREDIT_SUM"),
        Measure("BUREAU_CREDIT_SUM_TOTAL", "sum", "AMT_CREDIT_SUM"),
        Measure("BUREAU_DEBT_MEAN", "mean", "AMT_CREDIT_SUM_DEBT"),
        Measure("BUREAU_DEBT_TOTAL", "sum", "AMT_CREDIT_SUM_DEBT"),
        Measure("BUREAU_DEBT_MAX", "max", "AMT_CREDIT_SUM_DEBT"),
        Measure("BUREAU_OVERDUE_AMT_MEAN", "mean", "AMT_CREDIT_SUM_OVERDUE"),
        Measure("BUREAU_OVERDUE_AMT_MAX", "max", "AMT_CREDIT_SUM_OVERDUE"),
        Measure("BUREAU_DAY_OVERDUE_MAX", "max", "CREDIT_DAY_OVERDUE"),
        Measure("BUREAU_DAY_OVERDUE_MEAN", "mean", "CREDIT_DAY_OVERDUE"),
        Measure("BUREAU_UTILIZATION_MEAN", "mean", "_use"),
        Measure("BUREAU_UTILIZATION_MAX", "max", "_use"),
        Measure("BUREAU_DAYS_CREDIT_MEAN", "mean", "DAYS_CREDIT"),
        Measure("BUREAU_DAYS_CREDIT_MAX", "max", "DAYS_CREDIT"),
        Measure("BUREAU_DAYS_CREDIT_MIN", "min", "DAYS_CREDIT"),
        Measure("BUREAU_ACTIVE_DEBT_TOTAL", "sum", "AMT_CREDIT_SUM_DEBT", "_active"),
        Measure("BUREAU_ACTIVE_DEBT_MEAN", "mean", "AMT_CREDIT_SUM_DEBT", "_active"),
        Measure("BUREAU_ACTIVE_CREDIT_MEAN", "mean", "AMT_CREDIT_SUM", "_active"),
        Measure("BUREAU_ACTIVE_OVERDUE_MAX", "max", "CREDIT_DAY_OVERDUE", "_active"),
        Measure("BUREAU_ACTIVE_UTIL_MEAN", "mean", "_use", "_active"),
    ],
    ratios={
        "BUREAU_ACTIVE_RATIO": ("BUREAU_ACTIVE_COUNT", "BUREAU_LOAN_COUNT"),
        "BUREAU_OVERDUE_RATIO": ("BUREAU_OVERDUE_COUNT", "BUREAU_LOAN_COUNT"),
        "BUREAU_DEBT_CREDIT_RATIO": ("BUREAU_DEBT_TOTAL", "BUREAU_CREDIT_SUM_TOTAL"),
    },
)

MONTH_STATUS_CODES = {"C": 0, "X": 0, "0": 0, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5}

BUREAU_BALANCE_LOAN = Profile(
    derived=[
        {
            "_status": lambda: code_map(F.col("STATUS"), MONTH_STATUS_CODES),
        },
        {
            "_late": lambda: flag(F.col("_status") > 0),
            "_bad": lambda: flag(F.col("_status") >= 2),
        },
    ],
    measures=[
        Measure("BB_MONTHS_COUNT", "count", "MONTHS_BALANCE"),
        Measure("BB_STATUS_MEAN", "mean", "_status"),
        Measure("BB_STATUS_MAX", "max", "_status"),
        Measure("BB_DPD_COUNT", "sum", "_late"),
        Measure("BB_BAD_COUNT", "sum", "_bad"),
    ],
    ratios={
        "BB_DPD_RATE": ("BB_DPD_COUNT", "BB_MONTHS_COUNT"),
        "BB_BAD_RATE": ("BB_BAD_COUNT", "BB_MONTHS_COUNT"),
    },
)

BUREAU_BALANCE = Profile(
    measures=[
        Measure("BB_NUM_BUREAU_CREDITS", "count", "SK_ID_BUREAU"),
        Measure("BB_STATUS_MEAN_OF_MEANS", "mean", "BB_STATUS_MEAN"),
        Measure("BB_STATUS_MAX_EVER", "max", "BB_STATUS_MAX"),
        Measure("BB_TOTAL_DPD_MONTHS", "sum", "BB_DPD_COUNT"),
        Measure("BB_TOTAL_BAD_MONTHS", "sum", "BB_BAD_COUNT"),
        Measure("BB_DPD_RATE_MEAN", "mean", "BB_DPD_RATE"),
        Measure("BB_BAD_RATE_MEAN", "mean", "BB_BAD_RATE"),
        Measure("BB_DPD_RATE_MAX", "max", "BB_DPD_RATE"),
    ],
)

PREVIOUS = Profile(
    derived=[
        {
            "_ratio": lambda: guarded_ratio(F.col("AMT_APPLICATION"), _one("AMT_CREDIT")),
            "_down": lambda: guarded_ratio(_zero("AMT_DOWN_PAYMENT"), _one("AMT_GOODS_PRICE")),
            "_recent": lambda: flag(F.col("DAYS_DECISION") >= -365),
            "_approved": lambda: flag(F.col("NAME_CONTRACT_STATUS") == "Approved"),
            "_refused": lambda: flag(F.col("NAME_CONTRACT_STATUS") == "Refused"),
        },
    ],
    measures=[
        Measure("PREV_APP_COUNT", "count", "SK_ID_PREV"),
        Measure("PREV_AMT_CREDIT_MEAN", "mean", "AMT_CREDIT"),
        Measure("PREV_AMT_CREDIT_MAX", "max", "AMT_CREDIT"),
        Measure("PREV_AMT_ANNUITY_MEAN", "mean", "AMT_ANNUITY"),
        Measure("PREV_AMT_APPLICATION_MEAN", "mean", "AMT_APPLICATION"),
        Measure("PREV_APP_CREDIT_RATIO_MEAN", "mean", "_ratio"),
        Measure("PREV_DOWN_PAYMENT_MEAN", "mean", "_down"),
        Measure("PREV_DAYS_DECISION_MAX", "max", "DAYS_DECISION"),
        Measure("PREV_DAYS_DECISION_MEAN", "mean", "DAYS_DECISION"),
        Measure("PREV_RECENT_COUNT", "sum", "_recent"),
        Measure("PREV_CNT_PAYMENT_MEAN", "mean", "CNT_PAYMENT"),
        Measure("PREV_APPROVED_COUNT", "count", "SK_ID_PREV", "_approved"),
        Measure("PREV_APPROVED_CREDIT_MEAN", "mean", "AMT_CREDIT", "_approved"),
        Measure("PREV_APPROVED_ANNUITY_MEAN", "mean", "AMT_ANNUITY", "_approved"),
        Measure("PREV_APPROVED_RATIO_MEAN", "mean", "_ratio", "_approved"),
        Measure("PREV_REFUSED_COUNT", "count", "SK_ID_PREV", "_refused"),
        Measure("PREV_REFUSED_CREDIT_MEAN", "mean", "AMT_CREDIT", "_refused"),
        Measure("PREV_REFUSED_DAYS_MEAN", "mean", "DAYS_DECISION", "_refused"),
    ],
    ratios={
        "PREV_APPROVAL_RATE": ("PREV_APPROVED_COUNT", "PREV_APP_COUNT"),
        "PREV_REFUSAL_RATE": ("PREV_REFUSED_COUNT", "PREV_APP_COUNT"),
    },
)


def _delay() -> Column:
    return F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")


INSTALLMENTS = Profile(
    derived=[
        {
            "_late_days": lambda: positive_part(_delay()),
            "_early_days": lambda: negative_part(_delay()),
            "_paid": lambda: guarded_ratio(_zero("AMT_PAYMENT"), _one("AMT_INSTALMENT")),
            "_gap": lambda: F.col("AMT_INSTALMENT") - _zero("AMT_PAYMENT"),
        },
        {
            "_late": lambda: flag(F.col("_late_days") > 0),
            "_very_late": lambda: flag(F.col("_late_days") > 30),
            "_underpaid": lambda: flag(F.col("_paid") < 0.95),
        },
    ],
    measures=[
        Measure("INS_PAYMENT_COUNT", "count", "NUM_INSTALMENT_NUMBER"),
        Measure("INS_DAYS_LATE_MEAN", "mean", "_late_days"),
        Measure("INS_DAYS_LATE_MAX", "max", "_late_days"),
        Measure("INS_DAYS_LATE_SUM", "sum", "_late_days"),
        Measure("INS_DAYS_EARLY_MEAN", "mean", "_early_days"),
        Measure("INS_LATE_COUNT", "sum", "_late"),
        Measure("INS_VERY_LATE_COUNT", "sum", "_very_late"),
        Measure("INS_UNDERPAID_COUNT", "sum", "_underpaid"),
        Measure("INS_PAYMENT_RATIO_MEAN", "mean", "_paid"),
        Measure("INS_PAYMENT_RATIO_MIN", "min", "_paid"),
        Measure("INS_PAYMENT_DIFF_MEAN", "mean", "_gap"),
        Measure("INS_PAYMENT_DIFF_MAX", "max", "_gap"),
        Measure("INS_DAYS_ENTRY_MAX", "max", "DAYS_ENTRY_PAYMENT"),
    ],
    ratios={
        "INS_LATE_RATE": ("INS_LATE_COUNT", "INS_PAYMENT_COUNT"),
        "INS_VERY_LATE_RATE": ("INS_VERY_LATE_COUNT", "INS_PAYMENT_COUNT"),
        "INS_UNDERPAID_RATE": ("INS_UNDERPAID_COUNT", "INS_PAYMENT_COUNT"),
    },
)

POS_CASH = Profile(
    derived=[
        {
            "_late": lambda: flag(F.col("SK_DPD") > 0),
            "_late_def": lambda: flag(F.col("SK_DPD_DEF") > 0),
            "_completed": lambda: flag(F.col("NAME_CONTRACT_STATUS") == "Completed"),
            "_active": lambda: flag(F.col("NAME_CONTRACT_STATUS") == "Active"),
        },
    ],
    measures=[
        Measure("POS_MONTHS_COUNT", "count", "MONTHS_BALANCE"),
        Measure("POS_SK_DPD_MEAN", "mean", "SK_DPD"),
        Measure("POS_SK_DPD_MAX", "max", "SK_DPD"),
        Measure("POS_SK_DPD_SUM", "sum", "SK_DPD"),
        Measure("POS_SK_DPD_DEF_MEAN", "mean", "SK_DPD_DEF"),
        Measure("POS_SK_DPD_DEF_MAX", "max", "SK_DPD_DEF"),
        Measure("POS_DPD_MONTH_COUNT", "sum", "_late"),
        Measure("POS_DPD_DEF_COUNT", "sum", "_late_def"),
        Measure("POS_COMPLETED_COUNT", "sum", "_completed"),
        Measure("POS_ACTIVE_COUNT", "sum", "_active"),
        Measure("POS_CNT_INSTALMENT_MEAN", "mean", "CNT_INSTALMENT"),
        Measure("POS_CNT_INSTALMENT_FUTURE_MEAN", "mean", "CNT_INSTALMENT_FUTURE"),
    ],
    ratios={
        "POS_DPD_RATE": ("POS_DPD_MONTH_COUNT", "POS_MONTHS_COUNT"),
        "POS_COMPLETED_RATE": ("POS_COMPLETED_COUNT", "POS_MONTHS_COUNT"),
    },
)

CREDIT_CARD = Profile(
    derived=[
        {
            "_use": lambda: clip(
                guarded_ratio(_zero("AMT_BALANCE"), _one("AMT_CREDIT_LIMIT_ACTUAL")), 0.0, 1.0
            ),
            "_min_paid": lambda: guarded_ratio(
                _zero("AMT_PAYMENT_CURRENT"), _one("AMT_INST_MIN_REGULARITY")
            ),
            # The current total is added to its own parts; the published feature is defined so.
            "_drawn": lambda: _zero("AMT_DRAWINGS_ATM_CURRENT")
            + _zero("AMT_DRAWINGS_CURRENT")
            + _zero("AMT_DRAWINGS_OTHER_CURRENT")
            + _zero("AMT_DRAWINGS_POS_CURRENT"),
            "_late": lambda: flag(F.col("SK_DPD") > 0),
        },
        {
            "_cash": lambda: guarded_ratio(
                _zero("AMT_DRAWINGS_ATM_CURRENT"), zero_to_null(F.col("_drawn"))
            ),
            "_maxed": lambda: flag(F.col("_use") > 0.95),
        },
    ],
    measures=[
        Measure("CC_MONTHS_COUNT", "count", "MONTHS_BALANCE"),
        Measure("CC_UTILIZATION_MEAN", "mean", "_use"),
        Measure("CC_UTILIZATION_MAX", "max", "_use"),
        Measure("CC_UTILIZATION_MIN", "min", "_use"),
        Measure("CC_AMT_BALANCE_MEAN", "mean", "AMT_BALANCE"),
        Measure("CC_AMT_BALANCE_MAX", "max", "AMT_BALANCE"),
        Measure("CC_PAYMENT_MEAN", "mean", "AMT_PAYMENT_CURRENT"),
        Measure("CC_MIN_PAYMENT_RATIO_MEAN", "mean", "_min_paid"),
        Measure("CC_DRAWING_TOTAL_MEAN", "mean", "_drawn"),
        Measure("CC_CASH_DRAW_RATIO_MEAN", "mean", "_cash"),
        Measure("CC_DPD_MEAN", "mean", "SK_DPD"),
        Measure("CC_DPD_MAX", "max", "SK_DPD"),
        Measure("CC_DPD_MONTH_COUNT", "sum", "_late"),
        Measure("CC_MAXED_COUNT", "sum", "_maxed"),
        Measure("CC_LIMIT_MEAN", "mean", "AMT_CREDIT_LIMIT_ACTUAL"),
        Measure("CC_LIMIT_MAX", "max", "AMT_CREDIT_LIMIT_ACTUAL"),
    ],
    ratios={
        "CC_DPD_RATE": ("CC_DPD_MONTH_COUNT", "CC_MONTHS_COUNT"),
        "CC_MAXED_RATE": ("CC_MAXED_COUNT", "CC_MONTHS_COUNT"),
    },
)


def bureau_profile(bureau: DataFrame) -> DataFrame:
    return profile_children(bureau, BUREAU)


def bureau_balance_loans(months: DataFrame) -> DataFrame:
    return profile_children(months, BUREAU_BALANCE_LOAN, "SK_ID_BUREAU")


def bureau_balance_profile(months: DataFrame, bridge: DataFrame) -> DataFrame:
    """Months to loans, then loans to applicants; loans without an applicant drop out."""
    owners = bridge.select("SK_ID_CURR", "SK_ID_BUREAU")
    loans = bureau_balance_loans(months).join(owners, "SK_ID_BUREAU", "left")
    return profile_children(loans, BUREAU_BALANCE)


def previous_profile(previous: DataFrame) -> DataFrame:
    return profile_children(previous, PREVIOUS)


def installments_profile(installments: DataFrame) -> DataFrame:
    return profile_children(installments, INSTALLMENTS)


def pos_cash_profile(pos: DataFrame) -> DataFrame:
    return profile_children(pos, POS_CASH)


def credit_card_profile(cards: DataFrame) -> DataFrame:
    return profile_children(cards, CREDIT_CARD)
