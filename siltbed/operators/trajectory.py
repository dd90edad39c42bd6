"""Trajectories: messages, references between steps, tool pools, skill banks and shards."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.functions import text as tx
from siltbed.stages import staged

REFERENCE = r"\$step_(\d+)_tool_result((?:\.[A-Za-z0-9_]+|\[\d+\])*)"


def messages(steps: DataFrame, key: str, order: str, role: str, content: str) -> DataFrame:
    """key and its ordered messages (array of struct role, content)."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), F.col(role).alias("role"), F.col(content).alias("content"))))
    return steps.groupBy(key).agg(F.transform(rows, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def references(steps: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """key, step, target, path and status (ok, forward, missing) of every reference in a step's text."""
    found = steps.select(key, F.col(order).alias("step"), F.explode(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))).alias("reference"))
    found = found.select(
        key, "step", F.regexp_extract("reference", REFERENCE, 1).cast("long").alias("target"), F.regexp_extract("reference", REFERENCE, 2).alias("path")
    ).distinct()
    there = steps.select(key, F.col(order).alias("target"), F.lit(True).alias("there"))
    status = F.when(F.col("target") >= F.col("step"), "forward").when(F.col("there"), "ok").otherwise("missing")
    return found.join(there, [key, "target"], "left").select(key, "step", "target", "path", status.alias("status"))


def running_last(df: DataFrame, key: list[str], order: list, value: str, name: str) -> DataFrame:
    """The last known value of earlier rows."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def tool_pool(tools: Column, temporary_prefix: str, review: Column) -> Column:
    """temporary if a call is to a temporary tool or review is asked for, else canonical."""
    temporary = F.exists(tools, lambda t: F.startswith(t, F.lit(temporary_prefix)))
    return F.when(temporary | F.coalesce(review, F.lit(False)), "temporary").otherwise("canonical")


def migrated(calls: DataFrame, table: DataFrame, tool: str) -> DataFrame:
    """calls with new_tool from the table (old_tool, new_tool); ``unresolved`` and a reason where it has none."""
    out = calls.join(table, F.col(tool) == F.col("old_tool"), "left").drop("old_tool")
    return out.withColumn("reason", F.when(F.col("new_tool").isNull(), "no mapping")).withColumn("new_tool", F.coalesce("new_tool", F.lit("unresolved")))


def unknown_tool_decision(action, confidence, target_known, operation_known, parent_known, excluded, candidates) -> Column:
    """What becomes of a call to an unknown tool; the first rule that fits."""
    strong = F.coalesce(excluded & (confidence >= 0.90), F.lit(False))
    return (
        F.when((action == "reasoning") & (confidence >= 0.85), "reasoning")
        .when((action == "map") & target_known, "mapped")
        .when(action == "map", "ambiguous_unmapped")
        .when((action == "new_operation") & operation_known, "mapped")
        .when((action == "new_operation") & ~parent_known, "ambiguous_unmapped")
        .when(action == "new_operation", F.when(strong, "candidate_new_operation").otherwise("temporary_operation"))
        .when((action == "new_executor") & strong & (candidates >= 2), "candidate_new_executor")
        .otherwise("ambiguous_unmapped")
    )


def skill_support(patches: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sentences (text, applicability, kind, tool, operation, support, status) and refused patches, from additions.

    A sentence of kind tool must name an operation of the catalog. Two trajectories make an example a skill.
    """
    known = catalog.select("tool", "operation").distinct()
    tools = patches.where("kind = 'tool'")
    refused = tools.join(known, ["tool", "operation"], "left_anti").select(*patches.columns)
    good = tools.join(known, ["tool", "operation"], "left_semi").select(*patches.columns).unionByName(patches.where("kind != 'tool'"))
    keys = ["text", "applicability", "kind", "tool", "operation"]
    support = good.groupBy(*keys, "trajectory_id").count().groupBy(*keys).agg(F.count(F.lit(1)).alias("support"))
    return support.withColumn("status", F.when(F.col("support") >= 2, "skill").otherwise("example")), refused


def numbered(df: DataFrame, order: list, prefix: str, first: int = 1) -> DataFrame:
    """Running ids such as sent-0001 in a global order: ranks inside ranges, offset by the ranges before.

    The order is cut into ranges by Spark's range partitioning; only the ranges' counts meet in one task.
    """
    ranged = df.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = staged(ranged.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(*order))), "numbered")
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("place") + (first - 1)
    return ranged.join(offsets, "range").withColumn("id", F.format_string(f"{prefix}%04d", place)).drop("range", "place", "offset")


TOKEN = r"\.[A-Za-z0-9_]+|\[\d+\]"


def resolved(steps: DataFrame, results: DataFrame, key: str, order: str, text: str, result: str) -> DataFrame:
    """(key, step, target, path, status, value): what each reference of a step's text stands for.

    results: key, order, result (JSON text) of the steps that ran. A reference to its own or a later step, to a step
    without a result, to a field or place that is not there (a JSON null counts as such), or to anything with a credential
    in its path, keys or values, has a status that says so and no value. Values are JSON texts, strings without quotes.
    """
    found = references(steps, key, order, text).select(key, "step", "target", "path")
    held = results.select(key, F.col(order).alias("target"), F.col(result).alias("held"))
    rows = found.join(held, [key, "target"], "left")
    rows = rows.withColumn("own value", F.when(F.col("path") == "", F.col("held")).otherwise(F.expr("get_json_object(held, concat('$', path))")))
    tokens = F.regexp_extract_all("path", F.lit(TOKEN), F.lit(0))
    rows = rows.withColumn("tokens", tokens)
    missing = F.expr("filter(sequence(1, greatest(size(tokens), 1)), i -> get_json_object(held, concat('$', array_join(slice(tokens, 1, i), ''))) IS NULL)")
    at = F.get(F.col("tokens"), F.get(missing, F.lit(0)) - 1)
    secret = F.rlike("path", F.lit(tx.SECRET_KEY)) | F.rlike("own value", F.lit(rf'"[^"]*{tx.SECRET_KEY}[^"]*"\s*:')) | F.rlike("own value", F.lit(tx.SECRET_VALUE))
    status = (
        F.when(F.col("target") >= F.col("step"), "forward_reference").when(F.col("held").isNull(), "unresolved_reference")
        .when(F.coalesce(secret, F.lit(False)), "credential_reference_forbidden").when(F.col("own value").isNotNull(), "ok")
        .when(F.startswith(at, F.lit("[")), "reference_index_out_of_range").otherwise("reference_path_missing")
    )
    rows = rows.withColumn("status", status)
    return rows.select(key, "step", "target", "path", "status", F.when(F.col("status") == "ok", F.col("own value")).alias("value"))


SENTENCE = ["kind", "text", "applicability", "level", "tool", "operation"]


def patched(bank: DataFrame, patches: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A bank after patches in order: (sentences, review).

    bank: id, SENTENCE columns, trajectories (array). patches: n, trajectory_id, op, SENTENCE columns, target_id.

    * add: a trajectory more for the first sentence with the same words, condition, kind and level (or tool and operation),
      else a new sentence; one of kind tool must name an operation of the catalog.
    * duplicate: a trajectory more for the target.
    * narrow: the target gets the condition; if other trajectories hold it and its condition differs, a copy does instead.

    sentences: id, SENTENCE, trajectories, support, status (two trajectories make an example a skill); new ones are numbered
    on in the order of the patches that made them. review: n, trajectory_id, reason, target_id of patches that do not
    apply: their target is not in the bank given, their condition is blank or their operation is not in the catalog.
    All patches that bear on each other bear on the same words: those of a text are folded in order, streamed over sorted
    partitions with that text's sentences in memory.
    """
    known = catalog.select("tool", "operation").distinct().withColumn("known", F.lit(True))
    targets = bank.select(F.col("id").alias("target_id"), F.col("text").alias("target_text"))
    clean = F.array_join(F.filter(F.split(F.coalesce("applicability", F.lit("")), r"\s+"), lambda w: w != ""), " ")
    rows = patches.join(known, ["tool", "operation"], "left").join(targets, "target_id", "left")
    add, narrow = F.col("op") == "add", ~F.col("op").isin("add", "duplicate")
    reason = (
        F.when(add & (F.col("kind") == "tool") & F.col("known").isNull(), "operation not in the catalog")
        .when(~add & F.col("target_text").isNull(), "target not in the bank").when(narrow & (clean == ""), "no condition")
    )
    rows = staged(rows.withColumn("reason", reason).withColumn("clean", clean), "patches")
    review = rows.where("reason IS NOT NULL").select("n", "trajectory_id", "reason", "target_id")
    applied = rows.where("reason IS NULL").select(
        F.when(add, F.col("text")).otherwise(F.col("target_text")).alias("key"), F.col("n").cast("long").alias("n"), "op", F.col("target_id").alias("id"),
        *[(F.when(narrow, F.col("clean")).otherwise(F.col(c)) if c == "applicability" else F.col(c)).alias(c) for c in SENTENCE], F.array("trajectory_id").alias("trajectories"),
    )
    held = bank.select(F.col("text").alias("key"), F.lit(-1).cast("long").alias("n"), F.lit("held").alias("op"), "id", *SENTENCE, "trajectories")
    schema = "made long, id string, " + ", ".join(f"{c} string" for c in SENTENCE) + ", trajectories array<string>"
    names = ["made", "id", *SENTENCE, "trajectories"]

    def same(a: dict, b: dict) -> bool:
        level = a["level"] == b["level"] if a["kind"] == "planning" else a["kind"] == "tool" and (a["tool"], a["operation"]) == (b["tool"], b["operation"])
        return a["kind"] == b["kind"] and a["applicability"] == b["applicability"] and level

    def support(sentence: dict, own: list) -> None:
        sentence["trajectories"] += [t for t in own if t not in sentence["trajectories"]]

    def apply(state: list[dict], p: dict) -> None:
        if p["op"] == "held":
            state.append({**p, "made": None})
        elif p["op"] == "add":
            old = next((s for s in state if same(s, p)), None)
            if old is None:
                state.append({**p, "id": None, "made": p["n"]})
            else:
                support(old, p["trajectories"])
        else:
            target = next(s for s in state if s["id"] == p["id"])
            others = [t for t in target["trajectories"] if t not in p["trajectories"]]
            if p["op"] != "duplicate" and others and target["applicability"] != p["applicability"]:
                state.append({**target, "id": None, "made": p["n"], "applicability": p["applicability"], "trajectories": p["trajectories"]})
                return
            if p["op"] != "duplicate":
                target["applicability"] = p["applicability"]
            support(target, p["trajectories"])

    kinds = [pa.int64(), *[pa.string()] * 7, pa.list_(pa.string())]

    def batch_of(state: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([s[c] for s in state], k) for c, k in zip(names, kinds, strict=True)], names=names)

    def fold(batches):
        state, key = [], object()
        for batch in batches:
            for p in batch.to_pylist():
                if p["key"] != key:
                    if state:
                        yield batch_of(state)
                    state, key = [], p["key"]
                apply(state, p)
        if state:
            yield batch_of(state)

    dealt = held.unionByName(applied).repartition("key").sortWithinPartitions("key", "n", "id")
    found = staged(dealt.mapInArrow(fold, schema), "sentences")
    highest = bank.agg(F.max(F.expr("try_cast(regexp_extract(id, '^sent-([0-9]+)$', 1) AS INT)"))).first()[0] or 0
    new = numbered(found.where("id IS NULL").drop("id"), ["made"], "sent-", highest + 1)
    out = found.where("id IS NOT NULL").unionByName(new).withColumn("support", F.size("trajectories"))
    return out.drop("made").withColumn("status", F.when(F.col("support") >= 2, "skill").otherwise("example")), review
