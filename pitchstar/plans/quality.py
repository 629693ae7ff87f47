"""Quality reports over a built star: the failing rows of each test kind,
the one-frame summary, and the publish gate (Q1-Q8 as plans)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C


def _tests(kind: str):
    return [t for t in C.MODEL_TESTS if t[2] == kind]


def not_null_report(star) -> DataFrame:
    """(model, column_name, severity, failures) for every not_null test."""
    by_model: dict[str, list] = {}
    for model, col, _, _, sev in _tests("not_null"):
        by_model.setdefault(model, []).append((col, sev))
    parts = []
    for model, cols in by_model.items():
        sev = F.create_map(*[x for c, s in cols for x in (F.lit(c), F.lit(s))])
        parts.append(C.not_null(star[model], [c for c, _ in cols]).select(
            F.lit(model).alias("model"), "column_name", sev[F.col("column_name")].alias("severity"),
            F.col("failures").cast("bigint")))
    return reduce(DataFrame.unionByName, parts)


def unique_report(star) -> DataFrame:
    """Every repeated value of every unique test."""
    parts = [C.unique(star[m], c).select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                         F.col(c).cast("string").alias("value"), "n_records")
             for m, c, _, _, _ in _tests("unique")]
    return reduce(DataFrame.unionByName, parts)


def relationships_report(star) -> DataFrame:
    """Every relationships test with its failing rows and the smallest value
    that has no parent: one join for all tests, over values and counts."""
    tests = [(m, c, a) for m, c, _, a, _ in _tests("relationships")]
    spark = star[tests[0][0]].sparkSession
    named = spark.createDataFrame([(m, c, a[0]) for m, c, a in tests], "model string, column_name string, to_model string")
    found = C.relationship_counts(star, tests)
    # one row for each declared test
    return (F.broadcast(named).join(found, ["model", "column_name"], "left")
            .select("model", "column_name", "to_model", F.coalesce("failures", F.lit(0)).alias("failures"), "sample_value"))


def accepted_values_report(star) -> DataFrame:
    parts = [C.accepted_values(star[m], c, a).select(
        F.lit(m).alias("model"), F.lit(c).alias("column_name"),
        F.col(c).cast("string").alias("value"), "n_records")
        for m, c, _, a, _ in _tests("accepted_values")]
    return reduce(DataFrame.unionByName, parts)


def future_results(star, as_of=None) -> DataFrame:
    return C.no_future_results(star["fct_matches"], as_of)


def tbc_teams(star) -> DataFrame:
    return C.tbc_without_ids(star["fct_matches"], star["stg_matches"])


def summary(star, as_of=None) -> DataFrame:
    return C.run_checks(star, as_of)


def gate_decision(star, as_of=None) -> DataFrame:
    return C.gate(C.run_checks(star, as_of))


def unexpected_values(star, model: str, col: str, values: list[str]) -> DataFrame:
    """Q4 with a list of one's own."""
    return C.accepted_values(star[model], col, values)
