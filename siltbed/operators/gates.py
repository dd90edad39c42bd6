"""Gates of a trajectory before it is scored: what its form, transcript and frames rule out, and a score of its form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What each fault takes off the score, in the order in which faults are listed.
EMPTY_TRANSCRIPT, LEAKED_FRAME, NO_STEPS, LAST_NOT_FINAL, NO_FINAL = 0.4, 0.5, 0.5, 0.35, 0.5
FINAL_OBSERVED, FINAL_TOOL, NO_LOCATION, REASONING_ACTS = 0.25, 0.3, 0.4, 0.2


def form_gates(trajectories: DataFrame, steps: DataFrame, transcript: DataFrame, frames: DataFrame, key: str) -> DataFrame:
    """(key, gates, score): codes of what is wrong, each once and in the order of the rules, and 1 less what they cost.

    steps: key, n, event_type, tool, location, acts, observed (booleans); transcript: key, text; frames: key, selected,
    leaks. Every fault of a final step costs, others once. A trajectory without steps is judged by its transcript and
    frames and by that alone. All that is sent over the network is one row for each key and task.
    """
    final = F.col("event_type") == "final"
    bad_tool = final & ~F.coalesce(F.col("acts") & (F.col("tool") == "final_answer"), F.lit(False))

    def times(when: Column) -> Column:
        return F.sum(F.coalesce(when, F.lit(False)).cast("long"))

    seen = steps.groupBy(key).agg(
        F.count(F.lit(1)).alias("steps"), F.max_by("event_type", "n").alias("last"), times(final).alias("finals"), times(final & F.col("observed")).alias("observed"),
        times(bad_tool).alias("bad_tool"), times(final & ~bad_tool & (F.trim(F.coalesce("location", F.lit(""))) == "")).alias("no_location"),
        F.max(F.coalesce((F.col("event_type") == "reasoning") & (F.col("acts") | F.col("observed")), F.lit(False))).alias("reasoning"),
    )
    said = transcript.groupBy(key).agg(F.max(F.coalesce(F.trim("text") != "", F.lit(False))).alias("said"))
    leaked = frames.groupBy(key).agg(F.max(F.coalesce(F.col("selected") & F.col("leaks"), F.lit(False))).alias("leaked"))
    rows = trajectories.select(key).distinct().join(seen, key, "left").join(said, key, "left").join(leaked, key, "left")
    rows = rows.fillna(0, ["steps", "finals", "observed", "bad_tool", "no_location"]).fillna(False, ["said", "leaked", "reasoning"])
    some = F.col("steps") > 0
    rules = [
        ("empty_transcript", ~F.col("said"), EMPTY_TRANSCRIPT, None), ("answer_leakage_selected", F.col("leaked"), LEAKED_FRAME, None), ("missing_final", ~some, NO_STEPS, None),
        ("last_not_final", some & ~F.coalesce(F.col("last") == "final", F.lit(False)), LAST_NOT_FINAL, None), ("missing_final", some & (F.col("finals") == 0), NO_FINAL, None),
        ("final_has_observation", F.col("observed") > 0, FINAL_OBSERVED, "observed"), ("final_bad_tool", F.col("bad_tool") > 0, FINAL_TOOL, "bad_tool"),
        ("empty_location", F.col("no_location") > 0, NO_LOCATION, "no_location"), ("reasoning_has_action", F.col("reasoning"), REASONING_ACTS, None),
    ]
    cost = F.lit(0.0)
    for _, when, off, n in rules:
        cost = cost + F.when(when, F.lit(off) * (F.col(n) if n else F.lit(1))).otherwise(0.0)
    gates = F.array_compact(F.array(*[F.when(when, F.lit(code)) for code, when, _, _ in rules]))
    return rows.select(key, gates.alias("gates"), F.greatest(F.lit(0.0), F.lit(1.0) - cost).alias("score"))


# Verdicts of an audit that rule an observation out, and those that let it pass.
FABRICATED, SUPPORTED = ("unsupported", "fabricated", "reject", "hallucinated"), ("supported", "pass", "accepted")


def audit_routing(audits: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """(key, hard, soft, evidence): whether an audit found invented observations, and whether others need repair.

    audits: key, accepted; items: key, n, verdict, reason. Audits without items say nothing and give no row. The evidence
    is the first three reasons, by ``n``, of what is ruled out, else of what needs repair.
    """
    verdict = F.lower(F.trim(F.coalesce("verdict", F.lit(""))))
    rows = items.withColumn("kind", F.when(verdict.isin(*FABRICATED), "hard").when(~verdict.isin(*SUPPORTED), "soft"))

    def first(kind: str) -> Column:
        reasons = F.collect_list(F.when((F.col("kind") == kind) & (F.col("place") <= 3), F.struct("n", F.coalesce("reason", F.lit("")).alias("reason"))))
        return F.array_join(F.transform(F.array_sort(reasons), lambda r: r["reason"]), "; ")

    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(key, "kind").orderBy("n")))
    found = rows.groupBy(key).agg(
        F.max(F.coalesce(F.col("kind") == "hard", F.lit(False))).alias("hard"), F.max(F.coalesce(F.col("kind") == "soft", F.lit(False))).alias("repair"), first("hard").alias("h"), first("soft").alias("s")
    )
    out = found.join(audits.select(key, "accepted"), key)
    soft = F.col("repair") | ~F.coalesce("accepted", F.lit(True))
    return out.select(key, "hard", soft.alias("soft"), F.when(F.col("hard"), F.col("h")).when(F.col("repair"), F.col("s")).alias("evidence"))
