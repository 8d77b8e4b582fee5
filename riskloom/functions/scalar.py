"""General scalar operators (F1-F17) as Spark column expressions.

Everything here returns a ``Column``; nothing runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

EPS = 1e-5


def col(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def bin_right_closed(c, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """right-closed bins ``(a, b]``; ``include_lowest`` also closes the first bin on the left.

    Values outside every bin (and nulls) give null.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    x = col(c)
    expr = None
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        left = (x >= F.lit(lo)) if (i == 0 and include_lowest) else (x > F.lit(lo))
        cond = left & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def row_sum_nulls_zero(cols: Sequence) -> Column:
    """sum across columns with nulls counted as 0 (an all-null row gives 0)."""
    acc = None
    for c in cols:
        term = F.coalesce(col(c), F.lit(0))
        acc = term if acc is None else acc + term
    return acc if acc is not None else F.lit(0)


def safe_ratio(a, b) -> Column:
    """``a / (b + 1e-5)``; a zero denominator gives null instead of an error."""
    return F.try_divide(col(a), col(b) + F.lit(EPS))


def clip_zero(x) -> Column:
    """negative → 0, null stays null (``greatest(x, 0)`` would turn null into 0)."""
    x = col(x)
    return F.when(x < F.lit(0), F.lit(0.0)).otherwise(x)


def flag_of(pred: Column) -> Column:
    """F6 term: a predicate as 0/1 where a null comparison counts as 0."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def sigmoid(x) -> Column:
    """F7."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def cdc_age_code(age) -> Column:
    """F8: ``clip(1 + (age - 18) // 5, 1, 13)`` with floor division."""
    code = F.floor((col(age) - F.lit(18)) / F.lit(5)) + F.lit(1)
    return F.least(F.greatest(code, F.lit(1)), F.lit(13)).cast("int")


def lower_concat(complaint, notes) -> Column:
    """lower(complaint) + ' ' + lower(notes)."""
    return F.concat(F.lower(F.coalesce(col(complaint), F.lit(""))), F.lit(" "),
                    F.lower(F.coalesce(col(notes), F.lit(""))))


def keyword_flag(text, keywords: Sequence[str], also: Column | None = None) -> Column:
    """any keyword is a substring of ``text`` (no negation handling), OR an extra flag."""
    t = col(text)
    out = None
    for kw in keywords:
        hit = F.coalesce(t.contains(kw), F.lit(False))
        out = hit if out is None else (out | hit)
    if also is not None:
        out = out | F.coalesce(also, F.lit(False))
    return out


def answer_yes(q) -> Column:
    """answer == "Yes"; "No", "Unsure" and missing → False."""
    return F.coalesce(col(q) == F.lit("Yes"), F.lit(False))


def round_tenth(x) -> Column:
    """Round a double to one decimal, half-to-even on its exact binary value (Python's ``round(x, 1)``).

    ``x*10`` is formed as ``x*8 + x*2`` (both exact) with an error-free two-sum, so a value that
    only looks like a tie after the multiplication is resolved by the sign of the rounding error.
    """
    x = col(x)
    a, b = x * F.lit(8.0), x * F.lit(2.0)
    s = a + b
    bv = s - a
    err = (a - (s - bv)) + (b - bv)
    fl = F.floor(s).cast("double")
    tie = (s - fl) == F.lit(0.5)
    r = (F.when(tie & (err > F.lit(0.0)), fl + F.lit(1.0))
         .when(tie & (err < F.lit(0.0)), fl)
         .otherwise(F.rint(s)))
    return r / F.lit(10.0)


def round_tenth_of(x, factor: float = 0.3) -> Column:
    """``round(x * factor, 1)`` with Python's rounding of the double product."""
    return round_tenth(col(x) * F.lit(factor))


def risk_tier(p) -> Column:
    """<0.35 Low, <0.65 Moderate, else High; a null score has no tier."""
    p = col(p)
    return (F.when(p.isNull(), F.lit(None).cast("string"))
            .when(p < F.lit(config.LOW_CUT), F.lit(config.LOW))
            .when(p < F.lit(config.HIGH_CUT), F.lit(config.MODERATE))
            .otherwise(F.lit(config.HIGH)))


# --- fixed values: triage levels and recommendations shown with the top differential.
TRIAGE_EMERGENCY = "Emergency Triage: Seek Immediate Emergency Care"
TRIAGE_DOCTOR = "Medical Guidance: Doctor Consultation Recommended (within 24h)"
TRIAGE_SELF = "Self Care: Home Rest & Symptom Monitoring"
REC_ER = "Go to the nearest emergency room or call emergency medical services immediately."
REC_GP = "Book an appointment with a General Physician. Request a CBC blood panel and lab tests."
REC_HOME = ("Rest, stay hydrated, monitor your temperature, and consult a doctor if symptoms persist "
            "past 3 days.")


def triage_level(pct, tier) -> Column:
    """>65% and a CRITICAL tier → emergency; >50% → doctor; else self care."""
    pct, tier = col(pct), col(tier)
    crit = F.coalesce(tier.contains("CRITICAL"), F.lit(False))
    return (F.when((pct > F.lit(65)) & crit, F.lit(TRIAGE_EMERGENCY))
            .when(pct > F.lit(50), F.lit(TRIAGE_DOCTOR))
            .otherwise(F.lit(TRIAGE_SELF)))


def recommendation(pct) -> Column:
    """F16: >65% emergency room; >40% physician; else home care."""
    pct = col(pct)
    return (F.when(pct > F.lit(65), F.lit(REC_ER))
            .when(pct > F.lit(40), F.lit(REC_GP))
            .otherwise(F.lit(REC_HOME)))


def percentage(p) -> Column:
    """probability × 100."""
    return col(p) * F.lit(100.0)


def progress(pct) -> Column:
    """``min(1, pct / 100)``."""
    return F.least(F.lit(1.0), col(pct) / F.lit(100.0))
