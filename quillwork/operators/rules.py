"""Rules as data: a pack of (name, condition, change of score) becomes one projection of score and issues.

score = base + changes of the rules that hold, kept within 0..100; issues are the names of these rules in the order
of the pack. Conditions are SQL over the columns of the row, corpus counts among them, so a pack adds no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwork.plans.dialect import Dialect, Spark


@dataclass(frozen=True)
class Rule:
    name: str
    when: str
    change: float
    named: bool = True  # whether it is an issue or only moves the score


def score_sql(d: Dialect, rules: list[Rule], base: float = 100.0) -> str:
    """A null condition counts as not met."""
    parts = [f"CASE WHEN {r.when} THEN {float(r.change)} ELSE 0.0 END" for r in rules]
    return d.dbl(f"greatest(0.0, least(100.0, {float(base)} + {' + '.join(parts)}))")


def issues_sql(d: Dialect, rules: list[Rule]) -> str:
    return d.compact([f"CASE WHEN {r.when} THEN {d.lit(r.name)} END" for r in rules if r.named])


def status_sql(d: Dialect, score: str, issues: str, reject: list[str], soft: list[str] | None, low: float = 60, high: float = 85) -> str:
    """rejected below `low` or with a hard issue; approved from `high` without a soft one (None: without any); else needs_review."""
    hard = f"{d.overlap(issues, d.strings(reject))}" if reject else "1 = 0"
    clean = f"{d.size(issues)} = 0" if soft is None else f"NOT {d.overlap(issues, d.strings(soft))}"
    return f"CASE WHEN {score} < {low} OR {hard} THEN 'rejected' WHEN {score} >= {high} AND {clean} THEN 'approved' ELSE 'needs_review' END"


def scored(df: DataFrame, rules: list[Rule], base: float = 100.0) -> DataFrame:
    """Add score and issues to a DataFrame that holds the columns of the conditions."""
    d = Spark()
    return df.withColumn("score", F.expr(score_sql(d, rules, base))).withColumn("issues", F.expr(issues_sql(d, rules)))
