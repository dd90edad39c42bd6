"""Scores, gates, caps and decisions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Caps of soft flags, codes that are notes only, thresholds and weights.
SOFT_CAPS = {"observation_needs_repair": 0.82, "parameter_inputs_invalid": 0.75}
NOTES_ONLY = ("image_trajectory_mismatch", "task_needs_review")
ACCEPT, PROVISIONAL, COVERAGE = 0.90, 0.78, 0.85
COVERAGE_WEIGHTS = {
    "timestamped_transcript": 0.15,
    "selected_images": 0.15,
    "tool_mapping": 0.10,
    "parameter_contract_audit": 0.20,
    "strict_observation_audit": 0.10,
    "vlm_semantic_judge": 0.30,
}
READINESS = ("ready", "context_resolvable", "repairable", "invalid")


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def weighted(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted mean in the given order; negative weights count as 0, all of them 0 as equal."""
    positive = {k: max(0.0, w) for k, w in weights.items()}
    if not sum(positive.values()):
        positive = dict.fromkeys(weights, 1.0)
    total = sum(positive.values())
    out = F.lit(0.0)
    for name, score in scores.items():
        out = out + clamp(score) * F.lit(positive[name] / total)
    return clamp(out)


def first_by_code(gates: Column) -> Column:
    """An array of struct(code, evidence) with blank codes and later repeats of a code left out."""
    return F.aggregate(
        F.filter(gates, lambda g: F.trim(g["code"]) != ""),
        F.filter(gates, lambda g: F.lit(False)),
        lambda seen, g: F.when(F.exists(seen, lambda s: s["code"] == g["code"]), seen).otherwise(F.concat(seen, F.array(g))),
    )


def gate_codes(gates: Column, kind: str) -> Column:
    """Codes of ``blocking`` or ``soft`` gates, in order."""
    codes = F.filter(F.transform(gates, lambda g: g["code"]), lambda c: ~c.isin(*NOTES_ONLY))
    soft = tuple(SOFT_CAPS)
    return F.filter(codes, lambda c: c.isin(*soft) if kind == "soft" else ~c.isin(*soft))


def capped(base: Column, blocking: Column, soft: Column, parameters_invalid: Column, hard_cap: float) -> Column:
    """The least of the base score and every cap that applies."""
    quality = F.when(F.size(blocking) > 0, F.least(base, F.lit(hard_cap))).otherwise(base)
    for code, cap in SOFT_CAPS.items():
        applies = F.array_contains(soft, code)
        if code == "parameter_inputs_invalid":
            applies = applies | parameters_invalid
        quality = F.when(applies, F.least(quality, F.lit(cap))).otherwise(quality)
    return clamp(quality)


def decision(quality: Column, blocking: Column, soft: Column, coverage: Column, worst: Column) -> Column:
    return (
        F.when(F.size(blocking) > 0, "reject")
        .when((F.size(soft) > 0) | (coverage < COVERAGE), "needs_review")
        .when(worst.isin("repairable", "invalid"), "parameter_repair")
        .when(quality >= ACCEPT, "accept")
        .when(quality >= PROVISIONAL, "provisional_pass")
        .otherwise("needs_review")
    )


def priority(decided: Column, quality: Column, high_below: float, medium_below: float) -> Column:
    return F.when((decided == "reject") | (quality < high_below), "high").when(quality < medium_below, "medium").otherwise("low")


def coverage(present: dict[str, Column]) -> Column:
    out = F.lit(0.0)
    for name, weight in COVERAGE_WEIGHTS.items():
        out = out + F.when(present[name], weight).otherwise(0.0)
    return clamp(out)


def verdict(image: Column, text: Column) -> tuple[Column, Column]:
    """Two kinds of evidence (match, weak or partial, none): whether a place is matched, and the confidence."""
    both, either = (image == "match") & (text == "match"), (image == "match") | (text == "match")
    some = (image == "weak") | (text == "partial")
    matched = F.when(either, "matched").otherwise("no_match")
    return matched, F.when(both, 0.85).when(either, 0.70).when(some, 0.30).otherwise(0.20)


def admission(score: Column, decided: Column, parsed: Column, least: float = 0.85, allow_missing: bool = False) -> Column:
    """Why a trajectory is skipped; null if it is admitted."""
    missing = F.lit(False) if allow_missing else score.isNull()
    return (
        F.when(~parsed, "parse_failed")
        .when(missing, "missing_score")
        .when(F.coalesce(decided == "reject", F.lit(False)), "rejected")
        .when(score < least, "score_below_minimum")
    )
