"""Operation contracts: calls against a catalog of fields, in joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.fusion import READINESS


def norm_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), "[- ]", "_"), "_+", "_")


def alias_table(fields: DataFrame) -> DataFrame:
    """tool, operation, field, alias for every name a field goes by (fields: tool, operation, field, aliases, ...)."""
    names = F.explode(F.array_distinct(F.concat(F.array("field"), F.coalesce("aliases", F.array().cast("array<string>")))))
    return fields.select("tool", "operation", "field", names.alias("name")).withColumn("alias", norm_name(F.col("name"))).drop("name").distinct()


def type_matches(value: Column, kind: Column, expected: Column) -> Column:
    """value: text of a JSON value, kind: its JSON kind (string, number, integer, boolean, object, array)."""
    text = (kind == "string") & (F.trim(value) != "")
    number = kind.isin("number", "integer")
    return (
        F.when((kind == "string") & F.startswith(F.trim(value), F.lit("$")), True)
        .when(expected == "string", text)
        .when(expected == "number", number)
        .when(expected == "integer", kind == "integer")
        .when(expected.isin("boolean", "object", "array"), kind == expected)
        .when(expected == "string_or_array", text | (kind == "array"))
        .when(expected == "string_or_object", text | (kind == "object"))
        .when(expected == "number_or_string", number | text)
        .when(expected.isin("region", "location"), text | kind.isin("object", "array"))
        .otherwise(True)
    )


def audited(inputs: DataFrame, calls: DataFrame, fields: DataFrame) -> DataFrame:
    """A row for each call: call_id, issues (sorted code:field), readiness, valid.

    calls: call_id, tool, operation, context (array of names at hand). inputs: call_id, name, value, kind.
    fields: tool, operation, field, type, required, aliases, minimum, maximum, context_sources. The catalog is small
    and joined first; calls and inputs meet on call_id only.
    """
    known = fields.select("tool").distinct().withColumn("known_tool", F.lit(True))
    operations = fields.select("tool", "operation").distinct().withColumn("known_operation", F.lit(True))
    calls = calls.join(known, "tool", "left").join(operations, ["tool", "operation"], "left")
    named = inputs.join(calls.select("call_id", "tool", "operation"), "call_id").withColumn("alias", norm_name(F.col("name")))
    found = named.join(alias_table(fields), ["tool", "operation", "alias"], "left")
    values = found.where("field IS NOT NULL").groupBy("call_id", "field").agg(
        F.min(F.struct("value", "kind")).alias("least"),
        F.max(F.struct("value", "kind")).alias("most"),
        F.max(F.col("name") != F.col("field")).alias("renamed"),
    )
    expected = calls.where("known_operation").select("call_id", "tool", "operation", "context").join(fields, ["tool", "operation"])
    checked = expected.join(values, ["call_id", "field"], "left")
    value, kind = F.col("least.value"), F.col("least.kind")
    at_hand = F.arrays_overlap("context_sources", "context")
    number = F.when(kind.isin("number", "integer"), F.expr("try_cast(least.value AS DOUBLE)"))

    def issue(code: str, when: Column, field: Column) -> Column:
        return F.when(F.coalesce(when, F.lit(False)), F.concat(F.lit(f"{code}:"), field))

    missing = value.isNull() & F.col("required")
    per_field = F.array_compact(
        F.array(
            issue("input_alias_conflict", F.col("least") != F.col("most"), F.col("field")),
            issue("input_alias_normalized", F.col("renamed"), F.col("field")),
            issue("input_from_context", missing & at_hand, F.col("field")),
            issue("required_input_missing", missing & ~F.coalesce(at_hand, F.lit(False)), F.col("field")),
            issue("input_type_mismatch", value.isNotNull() & ~type_matches(value, kind, F.col("type")), F.col("field")),
            issue("input_below_minimum", number < F.col("minimum"), F.col("field")),
            issue("input_above_maximum", number > F.col("maximum"), F.col("field")),
        )
    )
    issues = checked.select("call_id", F.explode(per_field).alias("issue"))
    extras = found.where("field IS NULL").join(calls.where("known_operation").select("call_id"), "call_id", "left_semi")
    issues = issues.unionByName(extras.select("call_id", F.concat(F.lit("undeclared_input:"), "name").alias("issue")))
    unknown = F.when(F.col("known_tool").isNull(), "unknown_canonical_tool:").when(F.col("known_operation").isNull(), "unknown_operation:operation")
    issues = issues.unionByName(calls.select("call_id", unknown.alias("issue")).where("issue IS NOT NULL"))
    listed = issues.groupBy("call_id").agg(F.sort_array(F.collect_set("issue")).alias("issues"))
    out = calls.select("call_id").join(listed, "call_id", "left")
    return out.select("call_id", F.coalesce("issues", F.array().cast("array<string>")).alias("issues")).withColumn(
        "readiness", readiness(F.col("issues"))
    ).withColumn("valid", F.col("readiness").isin(*READINESS[:2]))


def readiness(issues: Column) -> Column:
    """invalid before repairable before context_resolvable; numbers out of range stay ready."""

    def some(*codes: str) -> Column:
        return F.exists(issues, lambda x: F.split(x, ":")[0].isin(*codes))

    return (
        F.when(some("unknown_canonical_tool", "unknown_operation", "input_alias_conflict", "input_type_mismatch"), "invalid")
        .when(some("required_input_missing"), "repairable")
        .when(some("input_from_context"), "context_resolvable")
        .otherwise("ready")
    )
