"""Banks of sentences, gates, references and forbidden keys against plain loops."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.functions import text as tx
from siltbed.operators import gates
from siltbed.operators import trajectory as tr
from siltbed.plans import reviews

SF = "/root/testdata/sf0.001"


def plain_bank(bank, patches, catalog):
    """The rules one by one, over one list."""
    state, review = [dict(s, trajectories=list(s["trajectories"])) for s in bank], []
    given_ids = {s["id"] for s in bank}

    def new(p, **more):
        number = max([int(s["id"][5:]) for s in state], default=0) + 1
        state.append({c: p[c] for c in tr.SENTENCE} | {"id": f"sent-{number:04d}", "trajectories": [p["trajectory_id"]]} | more)

    def add(s, t):
        if t not in s["trajectories"]:
            s["trajectories"].append(t)

    for p in patches:
        target = next((s for s in state if s["id"] == p["target_id"] and s["id"] in given_ids), None)
        condition = " ".join((p["applicability"] or "").split())
        if p["op"] == "add":
            if p["kind"] == "tool" and (p["tool"], p["operation"]) not in catalog:
                review.append(p["n"])
                continue
            old = [s for s in state if all(s[c] == p[c] for c in ("kind", "text", "applicability")) and (
                s["level"] == p["level"] if p["kind"] == "planning" else (s["tool"], s["operation"]) == (p["tool"], p["operation"]))]
            add(old[0], p["trajectory_id"]) if old else new(p)
        elif target is None or (p["op"] == "narrow" and not condition):
            review.append(p["n"])
        elif p["op"] == "duplicate":
            add(target, p["trajectory_id"])
        elif [t for t in target["trajectories"] if t != p["trajectory_id"]] and target["applicability"] != condition:
            new(target | {"trajectory_id": p["trajectory_id"]}, applicability=condition)
        else:
            target["applicability"] = condition
            add(target, p["trajectory_id"])
    return sorted((s["id"], *[s[c] or "" for c in tr.SENTENCE], tuple(s["trajectories"]), "skill" if len(s["trajectories"]) > 1 else "example") for s in state), sorted(review)


@pytest.mark.parametrize("shuffled", [False, True])
def test_patches_are_the_loop(spark, shuffled):
    bank, patches, catalog = reviews.bank_patches(spark, SF)
    blank = F.when(F.col("n") % 11 == 0, " ").otherwise(F.col("applicability"))
    patches = patches.withColumn("applicability", blank)
    rows = [r.asDict() for r in patches.orderBy("n").collect()]
    want = plain_bank([r.asDict() for r in bank.orderBy("id").collect()], rows, {tuple(r) for r in catalog.collect()})
    found, review = tr.patched(bank, patches.orderBy(F.rand(3)) if shuffled else patches, catalog)
    got = sorted((r["id"], *[r[c] or "" for c in tr.SENTENCE], tuple(r["trajectories"]), r["status"]) for r in found.collect())
    assert (got, sorted(r["n"] for r in review.collect())) == want
    assert len(got) > 30 and want[1]


def test_empty_patches(spark):
    bank, patches, catalog = reviews.bank_patches(spark, SF)
    found, review = tr.patched(bank, patches.limit(0), catalog)
    assert found.count() == bank.count() and review.count() == 0


def test_gates_without_steps(spark):
    made = spark.createDataFrame([(1,), (2,), (1,)], "k int")
    steps = spark.createDataFrame([(2, 1, "reasoning", None, None, True, False), (2, 2, "final", "final_answer", " ", True, None), (2, 3, "final", None, "x", None, None)],
                                  "k int, n int, event_type string, tool string, location string, acts boolean, observed boolean")
    said = spark.createDataFrame([(1, " "), (2, "x"), (2, None)], "k int, text string")
    frames = spark.createDataFrame([(1, True, True), (2, True, None)], "k int, selected boolean, leaks boolean")
    got = {r["k"]: (r["gates"], round(r["score"], 6)) for r in gates.form_gates(made, steps, said, frames, "k").collect()}
    assert got == {1: (["empty_transcript", "answer_leakage_selected", "missing_final"], 0.0), 2: (["final_bad_tool", "empty_location", "reasoning_has_action"], 0.1)}


def test_reference_values(spark):
    steps = spark.createDataFrame([("a", 3, "$step_1_tool_result.a[1].b $step_1_tool_result $step_3_tool_result.x $step_2_tool_result.a $step_1_tool_result.a[9] $step_1_tool_result.a[1].z $step_1_tool_result.password $step_0_tool_result.p $step_0_tool_result")], "k string, n long, t string")
    results = spark.createDataFrame([("a", 1, '{"a": [1, {"b": "x y"}]}'), ("a", 0, '{"p": {"q": [{"api_key": 1}]}}')], "k string, n long, r string")
    got = {(r["target"], r["path"]): (r["status"], r["value"]) for r in tr.resolved(steps, results, "k", "n", "t", "r").collect()}
    assert got == {
        (1, ".a[1].b"): ("ok", "x y"), (1, ""): ("ok", '{"a": [1, {"b": "x y"}]}'), (3, ".x"): ("forward_reference", None), (2, ".a"): ("unresolved_reference", None),
        (1, ".a[9]"): ("reference_index_out_of_range", None), (1, ".a[1].z"): ("reference_path_missing", None), (1, ".password"): ("credential_reference_forbidden", None),
        (0, ".p"): ("credential_reference_forbidden", None), (0, ""): ("credential_reference_forbidden", None),
    }


def planted(value, key):
    if isinstance(value, dict):
        return {k: planted(v, key) for k, v in value.items()} | {key: value}
    return [planted(v, key) for v in value] if isinstance(value, list) else value


def keys_of(value):
    if isinstance(value, dict):
        return set(value) | {k for v in value.values() for k in keys_of(v)}
    return {k for v in value for k in keys_of(v)} if isinstance(value, list) else set()


@settings(max_examples=100, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text(max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from("abc"), x, max_size=3), max_leaves=12))
def test_planted_keys_never_survive(value):
    clean = tx.without_keys("answer").func
    import pandas as pd

    out = json.loads(clean(pd.Series([json.dumps(planted(value, "answer"))]))[0])
    assert "answer" not in keys_of(out) and out == value


def test_odd_json(spark):
    rows = spark.createDataFrame([(None,), ("",), ("{",), ("[" * 100_000,), ('{"answer": 1, "a": [{"answer": {}}]}',)], "t string")
    assert [r[0] for r in rows.select(tx.without_keys("answer")("t")).collect()] == [None, None, None, None, '{"a": [{}]}']
