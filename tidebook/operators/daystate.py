"""State of a day's run from flags of its phases, what to do next, and the queues of days that wait for it.

A run has flags done<k>, failed<k>, out<k> for k = 1..8 (phase 7: labels, its three candidates as one), and
seconds (of the active process, else null), labels and sentinels (candidates with label files, and marked
as finished), files (input files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds, names of phases, states, actions and queues.
SLOW_S, HUNG_S = 600, 3600
CANDIDATES = 3
PHASES = ("p1_parse", "p2_reconstruct", "p3_features", "p4_agg", "p5_sample", "p6_excursion", "p7", "p8_ml")
QUEUES = (
    ("no_action_input_missing", "NO INPUT — Manual Required"), ("manual_review_input", "Manual Review — Input Missing"), ("manual_review", "Manual Review — Unknown State"),
    ("inspect_p1_checkpoint_bug", "Inspect — P1 Checkpoint Bug"), ("inspect_p1_input", "Inspect — P1 Input/Parse"), ("inspect_p7_failure", "Inspect — P7 Failure"),
    ("run_p8_only", "Run P8 Only"), ("run_p7_candidates", "Run P7 Candidates (all 3)"), ("rerun_p6_only", "Rerun P6 Only"), ("rerun_p5_p6", "Rerun P5-P6"),
    ("rerun_p4_p6", "Rerun P4-P6"), ("rerun_p3_p6", "Rerun P3-P6"), ("rerun_p2_p6", "Rerun P2-P6"), ("rerun_from_p6", "Rerun from P6"), ("rerun_from_p5", "Rerun from P5"),
    ("rerun_from_p4", "Rerun from P4"), ("rerun_from_p3", "Rerun from P3"), ("rerun_from_p2", "Rerun from P2"), ("rerun_from_p1", "Rerun from P1"),
    ("rerun_full", "Full Pipeline Rerun"), ("none", "Complete — No Action"), ("monitor", "Monitor (Running)"),
)

#: (state, condition); the first that holds. needs_p5 is a state that no rule leads to; it has actions all the same.
RULES = (
    ("hung", f"seconds > {HUNG_S}"),
    ("slow", f"seconds > {SLOW_S}"),
    ("running", "seconds IS NOT NULL"),
    ("no_input", "no_files AND NOT out1 AND NOT out5 AND NOT out6"),
    ("done", "done8"),
    ("ready_p8", f"labels = {CANDIDATES} AND sentinels = {CANDIDATES}"),
    ("needs_p7", "out6 AND (labels > 0 OR sentinels > 0)"),
    ("ready_p7", "out6"),
    ("needs_p6", "out5"),
    *((f"needs_p{k}", f"failed{k} AND out{k}") for k in (4, 3, 2, 1)),
    ("needs_p4", "done3 AND out3 AND (failed4 OR NOT out4)"),
    ("needs_p3", "done2 AND out2 AND (failed3 OR NOT out3)"),
    ("needs_p2", "out1 AND NOT done2"),
    ("no_input", "failed1 AND no_files"),
    ("needs_p1", "failed1"),
    ("unknown", "NOT any_done"),
    ("stalled", "true"),
)
#: (state, condition, action); the first that holds.
ACTIONS = (
    ("done", "true", "'none'"),
    ("ready_p8", "true", "'run_p8_only'"),
    ("ready_p7", "true", "'run_p7_candidates'"),
    ("needs_p7", "true", "'run_p7_candidates'"),
    ("needs_p6", "true", "'rerun_p6_only'"),
    *((f"needs_p{k}", f"out{k - 1}", f"'rerun_p{k}_p6'") for k in (5, 4, 3, 2)),
    *((f"needs_p{k}", "true", f"'inspect_p{k - 1}_output'") for k in (5, 4, 3)),
    ("needs_p2", "true", "'inspect_p1_input'"),
    ("needs_p1", "no_files", "'no_action_input_missing'"),
    ("needs_p1", "out1", "'inspect_p1_checkpoint_bug'"),
    ("needs_p1", "true", "'inspect_p1_input'"),
    ("no_input", "true", "'manual_review_input'"),
    *((s, "true", "'monitor'") for s in ("running", "slow", "hung")),
    ("stalled", "last_valid IS NOT NULL", "concat('rerun_from_', last_valid)"),
)


def _first(rules, otherwise: Column) -> Column:
    """The value of the first rule (condition, value) that holds; a null condition does not."""
    out = otherwise
    for rule, value in reversed(rules):
        out = F.when(F.expr(rule), F.expr(value)).otherwise(out)
    return out


def states(runs: DataFrame) -> DataFrame:
    """runs with no_files, last_valid (the last phase that is done and has its output), state and action."""
    phases = range(1, len(PHASES) + 1)
    valid = [(f"done{k} AND {'labels > 0' if k == 7 else f'out{k}'}", f"'{PHASES[k - 1]}'") for k in reversed(phases)]
    out = runs.withColumns({
        "no_files": F.expr("failed1 AND NOT out1 AND files = 0"),
        "any_done": F.expr(" OR ".join(f"done{k}" for k in phases)),
        "last_valid": _first(valid, F.lit(None).cast("string")),
    })
    out = out.withColumn("state", _first([(rule, f"'{name}'") for name, rule in RULES], F.lit("unknown")))
    return out.withColumn("action", _first([(f"state = '{s}' AND {rule}", action) for s, rule, action in ACTIONS], F.lit("manual_review"))).drop("any_done")


def queues(states: DataFrame, day: str = "day") -> DataFrame:
    """By action: its place in the order of queues (others come last), its label, how many days wait, the first and the last."""
    order = F.create_map(*[x for i, (action, _) in enumerate(QUEUES) for x in (F.lit(action), F.lit(i))])
    label = F.create_map(*[F.lit(x) for pair in QUEUES for x in pair])
    waiting = states.groupBy("action").agg(F.count("*").alias("n_days"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return waiting.withColumns({
        "place": F.coalesce(F.try_element_at(order, F.col("action")), F.lit(len(QUEUES))),
        "label": F.coalesce(F.try_element_at(label, F.col("action")), F.concat(F.lit("Other: "), F.col("action"))),
    })
