"""Checks of trajectories: gates, audits, references between steps, forbidden keys and banks of sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions import text as tx
from siltbed.operators import contract, gates, search
from siltbed.operators import trajectory as tr
from siltbed.sources import fixtures as fx


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Turns with the length of their text; the last of a conversation is marked."""
    rows = fx.table(spark, sf, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    last = rows.groupBy("conv_id").agg(F.max("turn").alias("last"))
    return rows.join(last, "conv_id").withColumn("size", F.char_length("text"))


def form_gates(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as trajectories: the last turn is the final step unless its length says otherwise."""
    rows = _turns(spark, sf)
    ends = (F.col("turn") == F.col("last")) & (F.col("size") % 4 != 0)
    kind = F.when(ends, "final").when(F.col("role") == "user", "reasoning").otherwise("tool_call")
    steps = rows.withColumn("event_type", kind).select(
        "conv_id", F.col("turn").alias("n"), "event_type", F.when(F.col("size") % 3 != 0, "final_answer").otherwise("other").alias("tool"),
        F.regexp_extract("text", "^([A-Z][a-z]+)", 1).alias("location"), ((F.col("event_type") != "reasoning") | (F.col("size") % 17 == 0)).alias("acts"),
        ((F.col("event_type") == "tool_call") | (F.col("size") % 5 == 0)).alias("observed"),
    )
    transcript = rows.where("size % 2 = 0").select("conv_id", "text")
    frames = rows.select("conv_id", (F.col("turn") % 2 == 0).alias("selected"), F.contains("text", F.lit("w")).alias("leaks"))
    return gates.form_gates(rows, steps, transcript, frames, "conv_id").select("conv_id", F.array_join("gates", ",").alias("gates"), F.round("score", 6).alias("score"))


def audit_routing(spark: SparkSession, sf: str) -> DataFrame:
    rows = _turns(spark, sf)
    verdict = F.when(F.col("size") % 4 == 0, "supported").when(F.col("size") % 4 == 1, " Pass").when(F.col("size") % 8 == 2, "Fabricated").when(F.col("size") % 8 == 6, "unclear")
    items = rows.select("conv_id", F.col("turn").alias("n"), verdict.alias("verdict"), F.substring("text", 1, 6).alias("reason"))
    audits = rows.select("conv_id").distinct().withColumn("accepted", F.when(F.col("conv_id") % 3 > 0, F.col("conv_id") % 3 == 1))
    return gates.audit_routing(audits, items, "conv_id")


def reference_values(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn refers to the one before it, to one that its length names and to a key."""
    rows = _turns(spark, sf)
    told = F.concat(
        F.lit("see $step_"), (F.col("turn") - 1).cast("string"), F.lit("_tool_result.words["), (F.col("size") % 6).cast("string"), F.lit("] and $step_"),
        (F.col("size") % 4).cast("string"), F.lit("_tool_result.meta.size, $step_0_tool_result.api_key or $step_0_tool_result.meta.none"),
    )
    words = F.slice(F.filter(F.split("text", " "), lambda w: F.rlike(w, F.lit("^[a-z]+$"))), F.lit(1), F.lit(4))
    result = F.to_json(F.struct(words.alias("words"), F.struct("size").alias("meta"), F.lit("k").alias("api_key")))
    results = rows.where("size % 3 != 0").select("conv_id", "turn", result.alias("result"))
    return tr.resolved(rows.where("turn > 0").withColumn("told", told), results, "conv_id", "turn", "told", "result")


def forbidden_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records of orders without the keys that must not get out."""
    key = F.col("o_orderkey").cast("string")
    text = F.concat(F.lit('{"id": '), key, F.lit(', "confirmed_location": {"id": 1}, "parts": [{"answer": ["x"], "id": '), key, F.lit('}, [{"answer": null}]], "note": "answer"}'))
    return fx.table(spark, sf, "orders").select("o_orderkey", tx.without_keys("confirmed_location", "answer")(text).alias("record"))


def bank_patches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nations as a bank of sentences (text: their region), customers as patches in the order of their keys, a catalog."""
    nation = fx.table(spark, sf, "nation").join(fx.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.lit(None).cast("string")
    told = [F.lit("planning").alias("kind"), F.col("r_name").alias("text"), F.col("n_name").alias("applicability"), F.lit("task").alias("level"), none.alias("tool"), none.alias("operation")]
    bank = nation.select(F.format_string("sent-%04d", F.col("n_nationkey") + 1).alias("id"), *told, F.array(F.concat(F.lit("b"), F.col("n_nationkey").cast("string"))).alias("trajectories"))
    c = fx.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    tool = F.col("c_mktsegment") == "MACHINERY"
    op = F.when(F.col("c_mktsegment") == "FURNITURE", "duplicate").when(F.col("c_mktsegment") == "HOUSEHOLD", "narrow").otherwise("add")
    patches = c.select(
        F.col("c_custkey").alias("n"), F.concat(F.lit("t"), (F.col("c_custkey") % 40).cast("string")).alias("trajectory_id"), op.alias("op"),
        F.when(tool, "tool").otherwise("planning").alias("kind"), F.col("r_name").alias("text"), F.concat(F.lit(" in "), (F.col("c_custkey") % 7).cast("string"), F.lit("  parts ")).alias("applicability"),
        F.lit("task").alias("level"), F.when(tool, F.lit("map")).alias("tool"), F.when(tool, F.concat(F.lit("op"), (F.col("c_custkey") % 4).cast("string"))).alias("operation"),
        F.format_string("sent-%04d", F.col("c_custkey") % 27 + 1).alias("target_id"),
    )
    return bank, patches, spark.range(3).select(F.lit("map").alias("tool"), F.concat(F.lit("op"), F.col("id").cast("string")).alias("operation"))


def patched_bank(spark: SparkSession, sf: str) -> DataFrame:
    """The nations' bank after the customers' patches."""
    found, _ = tr.patched(*bank_patches(spark, sf))
    return found.select("id", "kind", "text", "applicability", "tool", "operation", F.array_join("trajectories", ",").alias("trajectories"), "support", "status")


def evidence_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of the assistant's turns as evidence, two of them quoted, in the turns of their conversation."""
    rows = _turns(spark, sf)
    piece = F.concat(F.substring("text", 5, 14), F.lit(' says "'), F.substring("text", 40, 24), F.lit('" and "'), F.reverse(F.substring("text", 90, 30)), F.lit('"'))
    evidence = rows.where("role = 'assistant'").select("conv_id", F.col("turn").alias("evidence_id"), piece.alias("evidence"))
    segments = rows.select("conv_id", F.col("turn").cast("double").alias("start"), (F.col("turn") + 1.0).alias("end"), F.substring("text", 30, 60).alias("text"))
    return search.evidence_windows(evidence, segments, "conv_id")


def contract_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as calls of a tool for their priority, with their lines as inputs, against a catalog of three fields."""
    orders, lines = fx.table(spark, sf, "orders"), fx.table(spark, sf, "lineitem")
    hints = F.when(F.col("o_custkey") % 2 == 0, F.array(F.lit("mode_hint"))).otherwise(F.array().cast("array<string>"))
    calls = orders.select(F.col("o_orderkey").alias("call_id"), F.col("o_orderpriority").alias("tool"), F.when(F.col("o_custkey") % 9 == 0, "send").otherwise("ship").alias("operation"), hints.alias("context"))
    n = F.col("l_linenumber")
    name = F.when(n == 1, "quantity").when(n == 2, "Number-of parts").when(n == 3, "mode").when(n == 4, "extra").when(n == 5, "note").otherwise("Mode")
    text = n.isin(3, 5, 6)
    kind = F.when(text | (F.col("l_partkey") % 5 == 0), "string").otherwise("number")
    inputs = lines.select(F.col("l_orderkey").alias("call_id"), name.alias("name"), F.when(text, F.col("l_returnflag")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("value"), kind.alias("kind"))
    none, array = F.lit(None).cast("double"), F.array().cast("array<string>")
    field = F.explode(F.array(
        F.struct(F.lit("quantity").alias("field"), F.lit("number").alias("type"), F.lit(True).alias("required"), F.array(F.lit("number_of_parts")).alias("aliases"), F.lit(5.0).alias("minimum"), F.lit(45.0).alias("maximum"), array.alias("context_sources")),
        F.struct(F.lit("mode").alias("field"), F.lit("string").alias("type"), F.lit(True).alias("required"), array.alias("aliases"), none.alias("minimum"), none.alias("maximum"), F.array(F.lit("mode_hint")).alias("context_sources")),
        F.struct(F.lit("note").alias("field"), F.lit("integer").alias("type"), F.lit(False).alias("required"), array.alias("aliases"), none.alias("minimum"), none.alias("maximum"), array.alias("context_sources")),
    ))
    fields = orders.where("o_orderpriority < '5'").select(F.col("o_orderpriority").alias("tool")).distinct().select("tool", F.lit("ship").alias("operation"), field.alias("f")).select("tool", "operation", "f.*")
    found = contract.audited(inputs, calls, fields)
    return found.select("call_id", F.array_join("issues", ",").alias("issues"), "readiness", "valid")


_TURNS = """l AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY 1),
    t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS size, last FROM conversations JOIN l USING (conv_id))"""

ORACLE_SQL = {
    "form_gates": f"""WITH {_TURNS}, s AS (SELECT *, CASE WHEN turn = last AND size % 4 <> 0 THEN 'final' WHEN role = 'user' THEN 'reasoning' ELSE 'tool_call' END AS e FROM t),
        a AS (SELECT conv_id, count(*) FILTER (e = 'final') AS finals, count(*) FILTER (e = 'final' AND size % 5 = 0) AS observed, count(*) FILTER (e = 'final' AND size % 3 = 0) AS bad,
            count(*) FILTER (e = 'final' AND size % 3 <> 0 AND regexp_extract(text, '^([A-Z][a-z]+)', 1) = '') AS nowhere, bool_or(e = 'reasoning' AND (size % 17 = 0 OR size % 5 = 0)) AS acts,
            arg_max(e, turn) AS final, bool_or(size % 2 = 0 AND trim(text) <> '') AS said, bool_or(turn % 2 = 0 AND contains(text, 'w')) AS leaks FROM s GROUP BY conv_id),
        r AS (SELECT conv_id, [CASE WHEN NOT said THEN 'empty_transcript' END, CASE WHEN leaks THEN 'answer_leakage_selected' END, CASE WHEN final <> 'final' THEN 'last_not_final' END,
            CASE WHEN finals = 0 THEN 'missing_final' END, CASE WHEN observed > 0 THEN 'final_has_observation' END, CASE WHEN bad > 0 THEN 'final_bad_tool' END,
            CASE WHEN nowhere > 0 THEN 'empty_location' END, CASE WHEN acts THEN 'reasoning_has_action' END] AS g,
            0.4::DOUBLE * (NOT said)::INT + 0.5::DOUBLE * leaks::INT + 0.35::DOUBLE * (final <> 'final')::INT + 0.5::DOUBLE * (finals = 0)::INT + 0.25::DOUBLE * observed + 0.3::DOUBLE * bad + 0.4::DOUBLE * nowhere + 0.2::DOUBLE * acts::INT AS off FROM a)
        SELECT conv_id, array_to_string([x FOR x IN g IF x IS NOT NULL], ',') AS gates, round(greatest(0, 1 - off), 6) AS score FROM r""",
    "audit_routing": f"""WITH {_TURNS}, i AS (SELECT conv_id, turn, left(text, 6) AS reason, CASE WHEN size % 8 = 2 THEN 'hard' WHEN size % 4 NOT IN (0, 1) THEN 'soft' END AS kind FROM t),
        r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, kind ORDER BY turn) AS place FROM i),
        g AS (SELECT conv_id, bool_or(coalesce(kind = 'hard', false)) AS hard, bool_or(coalesce(kind = 'soft', false)) AS repair, string_agg(reason, '; ' ORDER BY turn) FILTER (kind = 'hard' AND place <= 3) AS h,
            string_agg(reason, '; ' ORDER BY turn) FILTER (kind = 'soft' AND place <= 3) AS s FROM r GROUP BY conv_id)
        SELECT conv_id, hard, repair OR conv_id % 3 = 2 AS soft, CASE WHEN hard THEN h WHEN repair THEN s END AS evidence FROM g""",
    "reference_values": f"""WITH {_TURNS}, k AS (SELECT conv_id, turn, size, [w FOR w IN string_split(text, ' ') IF regexp_full_match(w, '[a-z]+')][:4] AS words FROM t),
        f AS (SELECT conv_id, turn AS step, turn - 1 AS target, '.words[' || size % 6 || ']' AS path FROM k WHERE turn > 0 UNION SELECT conv_id, turn, size % 4, '.meta.size' FROM k WHERE turn > 0
              UNION SELECT conv_id, turn, 0, '.api_key' FROM k WHERE turn > 0 UNION SELECT conv_id, turn, 0, '.meta.none' FROM k WHERE turn > 0),
        j AS (SELECT f.*, h.size, h.words, CAST(substr(path, 8, 1) AS INT) AS place FROM (SELECT *, path LIKE '.words%' AS listed FROM f) f LEFT JOIN k h ON h.conv_id = f.conv_id AND h.turn = f.target AND h.size % 3 <> 0 WHERE listed
              UNION ALL SELECT f.*, h.size, h.words, NULL FROM (SELECT *, path LIKE '.words%' AS listed FROM f) f LEFT JOIN k h ON h.conv_id = f.conv_id AND h.turn = f.target AND h.size % 3 <> 0 WHERE NOT listed),
        s AS (SELECT conv_id, step, target, path, CASE WHEN target >= step THEN 'forward_reference' WHEN size IS NULL THEN 'unresolved_reference' WHEN path = '.api_key' THEN 'credential_reference_forbidden'
            WHEN listed AND place >= len(words) THEN 'reference_index_out_of_range' WHEN path = '.meta.none' THEN 'reference_path_missing' ELSE 'ok' END AS status, CASE WHEN listed THEN words[place + 1] ELSE CAST(size AS VARCHAR) END AS v FROM j)
        SELECT conv_id, step, target, path, status, CASE WHEN status = 'ok' THEN v END AS value FROM s""",
    "contract_audit": """WITH c AS (SELECT o_orderkey AS id, o_orderpriority AS tool, o_custkey % 9 <> 0 AS good, o_custkey % 2 = 0 AS hint, o_orderpriority < '5' AS known FROM orders),
        i AS (SELECT l_orderkey AS id, l_linenumber AS n, CASE WHEN l_linenumber IN (3, 5, 6) THEN l_returnflag ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS value,
            CASE WHEN l_linenumber IN (3, 5, 6) OR l_partkey % 5 = 0 THEN 'string' ELSE 'number' END AS kind, CASE WHEN l_linenumber IN (1, 2) THEN 'quantity' WHEN l_linenumber IN (3, 6) OR l_linenumber > 6 THEN 'mode'
            WHEN l_linenumber = 5 THEN 'note' END AS field FROM lineitem),
        v AS (SELECT id, field, min((value, kind)) AS least, min((value, kind)) <> max((value, kind)) AS differ, bool_or(n = 2 OR n >= 6) AS renamed FROM i WHERE field IS NOT NULL GROUP BY id, field),
        f AS (SELECT * FROM (VALUES ('quantity', true), ('mode', true), ('note', false)) t(field, required)),
        e AS (SELECT c.id, hint, f.field, required, least[1] AS value, least[2] AS kind, differ, renamed FROM c, f LEFT JOIN v ON v.id = c.id AND v.field = f.field WHERE known AND good),
        x AS (SELECT id, unnest([CASE WHEN differ THEN 'input_alias_conflict:' || field END, CASE WHEN renamed THEN 'input_alias_normalized:' || field END,
            CASE WHEN value IS NULL AND required AND field = 'mode' AND hint THEN 'input_from_context:mode' WHEN value IS NULL AND required THEN 'required_input_missing:' || field END,
            CASE WHEN value IS NOT NULL AND ((field = 'quantity' AND kind <> 'number') OR (field = 'mode' AND (kind <> 'string' OR trim(value) = '')) OR field = 'note') THEN 'input_type_mismatch:' || field END,
            CASE WHEN field = 'quantity' AND kind = 'number' AND CAST(value AS DOUBLE) < 5 THEN 'input_below_minimum:quantity' WHEN field = 'quantity' AND kind = 'number' AND CAST(value AS DOUBLE) > 45 THEN 'input_above_maximum:quantity' END]) AS issue FROM e
            UNION ALL SELECT id, 'undeclared_input:extra' FROM i JOIN c USING (id) WHERE n = 4 AND known AND good
            UNION ALL SELECT id, CASE WHEN NOT known THEN 'unknown_canonical_tool:' ELSE 'unknown_operation:operation' END FROM c WHERE NOT known OR NOT good),
        g AS (SELECT id, list_sort(list_distinct(list(issue) FILTER (issue IS NOT NULL))) AS issues FROM x GROUP BY id),
        r AS (SELECT c.id, coalesce(issues, []) AS issues FROM c LEFT JOIN g USING (id)),
        d AS (SELECT id, array_to_string(issues, ',') AS issues, CASE WHEN len([z FOR z IN issues IF split_part(z, ':', 1) IN ('unknown_canonical_tool', 'unknown_operation', 'input_alias_conflict', 'input_type_mismatch')]) > 0 THEN 'invalid'
            WHEN len([z FOR z IN issues IF z LIKE 'required_input_missing:%']) > 0 THEN 'repairable' WHEN len([z FOR z IN issues IF z LIKE 'input_from_context:%']) > 0 THEN 'context_resolvable' ELSE 'ready' END AS readiness FROM r)
        SELECT id AS call_id, issues, readiness, readiness IN ('ready', 'context_resolvable') AS valid FROM d""",
    "forbidden_keys": """SELECT o_orderkey, '{"id": ' || o_orderkey || ', "parts": [{"id": ' || o_orderkey || '}, [{}]], "note": "answer"}' AS record FROM orders""",
}

QUERIES = {f.__name__: f for f in (form_gates, audit_routing, reference_values, forbidden_keys, patched_bank, evidence_windows, contract_audit)}
