"""Helpers for writing the DuckDB oracle SQL."""

from __future__ import annotations

from ..sources import panels


def panel_cte(disease: str, name: str = "panel") -> str:
    return f"{name} AS (\n{panels.panel_sql(disease, 'duckdb')}\n)"


# --- oracle text of the ten risk rules ({Column} placeholders; comparisons on null count as false).
RULE_SQL = {
    "fever": ("-3.0e0 + 1.2e0 * CAST(COALESCE({BodyTemp} > 38.3e0, FALSE) AS INT) + 0.8e0 * {Chills}"
              " + 0.6e0 * {BodyAches} + 0.5e0 * {Headache}"),
    "malaria": ("-2.5e0 + 1.1e0 * CAST(COALESCE({TempSpike} > 38.8e0, FALSE) AS INT) + 1.0e0 * {ShiveringParoxysm}"
                " + 0.9e0 * CAST(COALESCE({PlateletCount} < 100, FALSE) AS INT) + 0.8e0 * {Jaundice}"),
    "typhoid": ("-3.2e0 + 1.3e0 * {StepladderFever} + 0.1e0 * {FeverDuration} + 0.7e0 * {AbdominalPain}"
                " + 0.8e0 * {RelativeBradycardia}"),
    "dengue": ("-3.0e0 + 1.0e0 * {RetroOrbitalPain} + 0.8e0 * {SevereJointPain}"
               " + 1.2e0 * CAST(COALESCE({PlateletCount} < 100, FALSE) AS INT) + 0.6e0 * {PetechiaeRash}"),
    "cold": "-2.0e0 + 0.8e0 * {Rhinorrhea} + 0.7e0 * {SoreThroat} + 0.7e0 * {Sneezing} + 0.6e0 * {NasalCongestion}",
    "gastro": ("-2.5e0 + 0.3e0 * {VomitingEpisodes} + 0.2e0 * {DiarrheaEpisodes} + 0.7e0 * {AbdominalCramps}"
               " + 0.8e0 * {DehydrationScore}"),
    "anemia": "-1.5e0 - 0.6e0 * ({Hemoglobin} - 12) - 0.03e0 * ({Ferritin} - 30) + 0.6e0 * {Pallor}",
    "thyroid": ("-2.0e0 + 0.2e0 * CAST(COALESCE({TSH} > 4.5e0, FALSE) AS INT)"
                " + 0.3e0 * CAST(COALESCE({TSH} < 0.4e0, FALSE) AS INT)"
                " + 0.5e0 * CAST(COALESCE({WeightChange} <> 0, FALSE) AS INT)"),
    "asthma": "-3.0e0 + 1.2e0 * {Wheezing} - 0.05e0 * ({PeakExpiratoryFlow} - 80) + 0.7e0 * {NocturnalCough}",
    "hypertensive_crisis": ("-5.0e0 + 0.08e0 * ({SystolicBP} - 140) + 0.09e0 * ({DiastolicBP} - 90)"
                            " + 1.5e0 * {TargetOrganDamage} + 0.8e0 * {SevereHeadache}"),
}


class _Ident(dict):
    def __missing__(self, key):
        return key


def rule_prob_sql(disease: str, cols: dict | None = None) -> str:
    logit = RULE_SQL[disease].format_map(cols if cols is not None else _Ident())
    return f"(1.0e0 / (1.0e0 + exp(-({logit}))))"


def lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"{v!r}e0" if "e" not in repr(v) else repr(v)
    return "'" + str(v).replace("'", "''") + "'"


FLAG_SQL = {
    "full_text": "(lower(COALESCE(chief_complaint, '')) || ' ' || lower(COALESCE(notes, '')))",
}


def _kw(kws, extra=None):
    parts = [f"COALESCE(contains(full_text, {lit(k)}), FALSE)" for k in kws]
    if extra:
        parts.append(extra)
    return "(" + " OR ".join(parts) + ")"


INTERVIEW_FLAGS_SQL = {
    "has_fever": _kw(["fever"], "COALESCE(q1 = 'Yes', FALSE)"),
    "has_chills": _kw(["chills"], "COALESCE(q1 = 'Yes', FALSE)"),
    "has_joint_eye": _kw(["joint"], "COALESCE(q2 = 'Yes', FALSE)"),
    "has_gastro": _kw(["nausea", "vomit"], "COALESCE(q3 = 'Yes', FALSE)"),
    "has_resp": _kw(["breath", "cough"], "COALESCE(q4 = 'Yes', FALSE)"),
    "has_neuro": _kw(["dizziness", "memory"], "COALESCE(q5 = 'Yes', FALSE)"),
    "has_chest": _kw(["chest pain"], "COALESCE(rf_heart = 1, FALSE)"),
    "has_yellow": _kw(["yellow"]),
    "has_lump": _kw(["lump"]),
    "rf_hbp_f": "COALESCE(rf_hbp = 1, FALSE)",
    "rf_hchol_f": "COALESCE(rf_hchol = 1, FALSE)",
    "rf_diab_f": "COALESCE(rf_diab = 1, FALSE)",
    "rf_smoker_f": "COALESCE(rf_smoker = 1, FALSE)",
    "rf_heart_f": "COALESCE(rf_heart = 1, FALSE)",
    "sex_val": "CASE WHEN sex = 'Male' THEN 1 ELSE 0 END",
    "cdc_age": "CAST(LEAST(GREATEST(floor((age - 18) / 5) + 1, 1), 13) AS INT)",
}


def interview_cte(name: str = "intake") -> str:
    """Intake A with its interview flags (two CTE levels)."""
    flags = ",\n  ".join(f"{v} AS {k}" for k, v in INTERVIEW_FLAGS_SQL.items())
    return (f"intake_raw AS (\n{_intake_sql('a')}\n),\n"
            f"intake_text AS (SELECT *, {FLAG_SQL['full_text']} AS full_text FROM intake_raw),\n"
            f"{name} AS (SELECT *,\n  {flags}\nFROM intake_text)")


def vitals_cte(name: str = "intake") -> str:
    return f"{name} AS (\n{_intake_sql('b')}\n)"


def _intake_sql(kind):
    return panels.intake_sql(kind)


def cell_sql(cell) -> str:
    kind = cell[0]
    if kind == "k":
        return lit(cell[1])
    if kind == "if":
        return f"(CASE WHEN {cell[1]} THEN {lit(cell[2])} ELSE {lit(cell[3])} END)"
    if kind == "and":
        return f"(CASE WHEN {cell[1]} AND {cell[2]} THEN {lit(cell[3])} ELSE {lit(cell[4])} END)"
    if kind == "col":
        return cell[1]
    if kind == "cmp":
        return f"CAST(COALESCE({cell[1]} {cell[2]} {lit(cell[3])}, FALSE) AS INT)"
    if kind == "both":
        a, b = cell[1], cell[2]
        return (f"CAST(COALESCE({a[1]} {a[2]} {lit(a[3])} AND {b[1]} {b[2]} {lit(b[3])}, FALSE) AS INT)")
    if kind == "cmpv":
        _, c, op, v, a, b = cell
        return f"(CASE WHEN COALESCE({c} {op} {lit(v)}, FALSE) THEN {lit(a)} ELSE {lit(b)} END)"
    if kind == "ifcol":
        _, c, a, b = cell
        return f"(CASE WHEN COALESCE({c} = 1, FALSE) THEN {lit(a)} ELSE {lit(b)} END)"
    if kind == "round":
        return round_tenth_sql(f"({cell[1]} * {lit(cell[2])})")
    if kind == "gender":
        return f"(CASE WHEN {cell[1]} = 1 THEN 'Male' ELSE 'Female' END)"
    if kind == "cdc":
        return f"CAST(LEAST(GREATEST(floor(({cell[1]} - 18) / 5) + 1, 1), 13) AS INT)"
    raise ValueError(kind)


def projection_sql(kind: str, disease: str) -> dict:
    from ..functions import intake as _in
    spec = (_in.INTAKE_A if kind == "a" else _in.INTAKE_B)[disease]
    return {name: cell_sql(cell) for name, cell in spec}


def round_tenth_sql(x: str) -> str:
    """Same exact half-even tenth rounding as ``scalar.round_tenth`` (two-sum of x*8 + x*2)."""
    a, b = f"({x} * 8.0e0)", f"({x} * 2.0e0)"
    s = f"({a} + {b})"
    bv = f"({s} - {a})"
    err = f"(({a} - ({s} - {bv})) + ({b} - {bv}))"
    fl = f"CAST(floor({s}) AS DOUBLE)"
    tie = f"({s} - {fl} = 0.5e0)"
    return (f"((CASE WHEN {tie} AND {err} > 0.0e0 THEN {fl} + 1.0e0 WHEN {tie} AND {err} < 0.0e0 THEN {fl}"
            f" ELSE round_even({s}, 0) END) / 10.0e0)")


def qid(name: str) -> str:
    return f'"{name}"' if " " in name else name
