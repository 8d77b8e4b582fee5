"""Logistic risk rules (L1-L10) as deterministic scoring expressions.

``rule_risk = sigmoid(logit)``. A comparison on a null input counts as false;
a null linear term makes the score null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import col, flag_of, sigmoid


def _lt(x, v):
    return flag_of(x < F.lit(v))


def _gt(x, v):
    return flag_of(x > F.lit(v))


def _k(x):
    return F.lit(float(x))


# --- fixed values: rule coefficients (logit terms, in the reference's order).
def _fever(c):
    return _k(-3.0) + _k(1.2) * _gt(c("BodyTemp"), 38.3) + _k(0.8) * c("Chills") + _k(0.6) * c("BodyAches") \
        + _k(0.5) * c("Headache")


def _malaria(c):
    return _k(-2.5) + _k(1.1) * _gt(c("TempSpike"), 38.8) + _k(1.0) * c("ShiveringParoxysm") \
        + _k(0.9) * _lt(c("PlateletCount"), 100) + _k(0.8) * c("Jaundice")


def _typhoid(c):
    return _k(-3.2) + _k(1.3) * c("StepladderFever") + _k(0.1) * c("FeverDuration") \
        + _k(0.7) * c("AbdominalPain") + _k(0.8) * c("RelativeBradycardia")


def _dengue(c):
    return _k(-3.0) + _k(1.0) * c("RetroOrbitalPain") + _k(0.8) * c("SevereJointPain") \
        + _k(1.2) * _lt(c("PlateletCount"), 100) + _k(0.6) * c("PetechiaeRash")


def _cold(c):
    return _k(-2.0) + _k(0.8) * c("Rhinorrhea") + _k(0.7) * c("SoreThroat") + _k(0.7) * c("Sneezing") \
        + _k(0.6) * c("NasalCongestion")


def _gastro(c):
    return _k(-2.5) + _k(0.3) * c("VomitingEpisodes") + _k(0.2) * c("DiarrheaEpisodes") \
        + _k(0.7) * c("AbdominalCramps") + _k(0.8) * c("DehydrationScore")


def _anemia(c):
    return _k(-1.5) - _k(0.6) * (c("Hemoglobin") - F.lit(12)) - _k(0.03) * (c("Ferritin") - F.lit(30)) \
        + _k(0.6) * c("Pallor")


def _thyroid(c):
    return _k(-2.0) + _k(0.2) * _gt(c("TSH"), 4.5) + _k(0.3) * _lt(c("TSH"), 0.4) \
        + _k(0.5) * flag_of(c("WeightChange") != F.lit(0))


def _asthma(c):
    return _k(-3.0) + _k(1.2) * c("Wheezing") - _k(0.05) * (c("PeakExpiratoryFlow") - F.lit(80)) \
        + _k(0.7) * c("NocturnalCough")


def _hypertensive_crisis(c):
    return _k(-5.0) + _k(0.08) * (c("SystolicBP") - F.lit(140)) + _k(0.09) * (c("DiastolicBP") - F.lit(90)) \
        + _k(1.5) * c("TargetOrganDamage") + _k(0.8) * c("SevereHeadache")


LOGITS = {
    "fever": _fever, "malaria": _malaria, "typhoid": _typhoid, "dengue": _dengue, "cold": _cold,
    "gastro": _gastro, "anemia": _anemia, "thyroid": _thyroid, "asthma": _asthma,
    "hypertensive_crisis": _hypertensive_crisis,
}

# Columns each rule reads (for schema checks before scoring).
RULE_INPUTS = {
    "fever": ["BodyTemp", "Chills", "BodyAches", "Headache"],
    "malaria": ["TempSpike", "ShiveringParoxysm", "PlateletCount", "Jaundice"],
    "typhoid": ["StepladderFever", "FeverDuration", "AbdominalPain", "RelativeBradycardia"],
    "dengue": ["RetroOrbitalPain", "SevereJointPain", "PlateletCount", "PetechiaeRash"],
    "cold": ["Rhinorrhea", "SoreThroat", "Sneezing", "NasalCongestion"],
    "gastro": ["VomitingEpisodes", "DiarrheaEpisodes", "AbdominalCramps", "DehydrationScore"],
    "anemia": ["Hemoglobin", "Ferritin", "Pallor"],
    "thyroid": ["TSH", "WeightChange"],
    "asthma": ["Wheezing", "PeakExpiratoryFlow", "NocturnalCough"],
    "hypertensive_crisis": ["SystolicBP", "DiastolicBP", "TargetOrganDamage", "SevereHeadache"],
}


def rule_logit(disease: str, cols: dict | None = None) -> Column:
    """Logit of the disease's rule. ``cols`` maps panel column names to expressions
    (e.g. an intake projection), so the rule can be evaluated without materialising the panel."""
    if disease not in LOGITS:
        raise ValueError(f"no risk rule for {disease!r}; use a trained model")
    resolve = (lambda n: cols[n]) if cols is not None else col
    return LOGITS[disease](resolve)


def rule_risk(disease: str, cols: dict | None = None) -> Column:
    """Probability in [0, 1] from the disease's logistic rule."""
    return sigmoid(rule_logit(disease, cols))
