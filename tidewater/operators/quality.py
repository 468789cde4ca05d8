"""Data-quality rules: flags, metrics, quarantine, and rules that look into other tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("not_null", "regex", "accepted_values", "range", "consistency", "reference_exists", "reference_comparison")
SEVERITIES, ACTIONS = ("INFO", "WARNING", "ERROR", "CRITICAL"), ("quarantine", "observe", "fail_pipeline")


class DataQualityError(RuntimeError):
    """A rule whose action is fail_pipeline failed."""


@dataclass(frozen=True)
class Rule:
    rule_id: str
    dataset: str
    kind: str
    severity: str
    passes: str
    reference: tuple[str, tuple[tuple[str, str], ...], str | None] | None = None
    threshold: float = 0.0
    action: str = "quarantine"
    active: bool = True

    def __post_init__(self) -> None:
        wrong = [n for n, v, ok in (("kind", self.kind, KINDS), ("severity", self.severity, SEVERITIES), ("action", self.action, ACTIONS)) if v not in ok]
        if not 0 <= self.threshold <= 1:
            wrong.append("threshold")
        if self.kind.startswith("reference") and not (self.reference and self.reference[1]):
            wrong.append("reference keys")
        if self.kind == "reference_comparison" and not (self.reference and self.reference[2]):
            wrong.append("reference value")
        if wrong:
            raise ValueError(f"rule {self.rule_id}: bad {', '.join(wrong)}")


def load_rules(rows: Iterable[tuple], dataset: str | None = None) -> list[Rule]:
    """Active rules, of one dataset if given; ids must be unique."""
    rules = [r if isinstance(r, Rule) else Rule(*r) for r in rows]
    ids = [r.rule_id for r in rules]
    if len(ids) != len(set(ids)):
        raise ValueError("rule ids repeat")
    return [r for r in rules if r.active and dataset in (None, r.dataset)]


def rules_from(config: Mapping) -> list[Rule]:
    """Rules of a configuration: a list under 'rules' with the fields of Rule; a reference is a mapping
    of table, keys (pairs of own and referenced column) and, for comparisons, value."""
    out = []
    for r in config["rules"]:
        r = dict(r)
        if ref := r.pop("reference", None):
            r["reference"] = (ref["table"], tuple(tuple(k) for k in ref["keys"]), ref.get("value"))
        out.append(Rule(**r))
    return load_rules(out)


def with_references(rows: DataFrame, rules: list[Rule], tables: Mapping[str, DataFrame]) -> tuple[DataFrame, list[Rule]]:
    """Joins what reference rules look up and rewrites them to plain flag rules.

    Keys match NULL-safely, so NULL finds NULL. A comparison also needs its reference found. Where
    a reference key repeats, its greatest compared value counts.
    """
    plain = []
    for n, rule in enumerate(rules):
        if not rule.kind.startswith("reference"):
            plain.append(rule)
            continue
        name, pairs, value = rule.reference
        if name not in tables:
            raise ValueError(f"rule {rule.rule_id} needs table {name}")
        held = tables[name].groupBy(*[F.col(r).alias(f"__r{n}_{i}") for i, (_, r) in enumerate(pairs)]).agg(F.lit(True).alias(f"__hit{n}"), F.max(value if value else F.lit(None)).alias(f"__val{n}"))
        on = [rows[c].eqNullSafe(held[f"__r{n}_{i}"]) for i, (c, _) in enumerate(pairs)]
        passes = F.coalesce(F.col(f"__hit{n}"), F.lit(False))
        joined = rows.join(held, on, "left").withColumns({"_reference_exists": passes, "_reference_value": F.col(f"__val{n}")})
        if value:
            passes = passes & F.expr(rule.passes)
        elif rule.passes != "_reference_exists":
            passes = passes & F.expr(rule.passes)
        rows = joined.withColumn(f"__flag{n}", passes).drop("_reference_exists", "_reference_value", f"__hit{n}", f"__val{n}", *[f"__r{n}_{i}" for i in range(len(pairs))])
        plain.append(Rule(rule.rule_id, rule.dataset, "consistency", rule.severity, f"__flag{n}", None, rule.threshold, rule.action))
    return rows, plain


def flag(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds _failed_rule_ids, in rule order; an expression that is NULL fails."""
    ok = [F.coalesce(F.expr(r.passes).cast("boolean"), F.lit(False)) for r in rules]
    failed: Column = F.filter(F.array(*[F.when(~p, F.lit(r.rule_id)) for p, r in zip(ok, rules, strict=True)]), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    out = rows.withColumn("_failed_rule_ids", failed)
    return out.drop(*[c for c in out.columns if c.startswith("__flag")])


def metrics(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule from one pass over the rows: evaluated, failed, percentage, PASS or FAIL."""
    spark = flagged.sparkSession
    schema = "rule_id string, dataset string, severity string, evaluated_rows bigint, failed_rows bigint, failure_percentage double, status string"
    if not rules:
        return spark.createDataFrame([], schema)
    sums = flagged.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.array_contains("_failed_rule_ids", r.rule_id).cast("bigint")).alias(f"f{i}") for i, r in enumerate(rules)])
    each = F.explode(F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.dataset).alias("dataset"), F.lit(r.severity).alias("severity"), F.lit(float(r.threshold)).alias("threshold"), F.coalesce(f"f{i}", F.lit(0)).alias("failed_rows")) for i, r in enumerate(rules)]))
    rate = F.coalesce(F.try_divide(F.col("m.failed_rows").cast("double"), F.col("n").cast("double")), F.lit(0.0))
    return sums.select("n", each.alias("m")).select(
        "m.rule_id", "m.dataset", "m.severity", F.col("n").alias("evaluated_rows"), "m.failed_rows", F.round(rate * 100, 6).alias("failure_percentage"),
        F.when(rate <= F.col("m.threshold"), "PASS").otherwise("FAIL").alias("status"),
    )


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and quarantined rows with their failed rules; together they are all rows."""
    return flagged.where("size(_failed_rule_ids) = 0").drop("_failed_rule_ids"), flagged.where("size(_failed_rule_ids) > 0")


def enforce(measured: DataFrame, rules: list[Rule]) -> None:
    """Raises if a fail_pipeline rule failed; reads at most one row per rule."""
    strict = [r.rule_id for r in rules if r.action == "fail_pipeline"]
    if strict and (bad := [r.rule_id for r in measured.where("status = 'FAIL'").collect() if r.rule_id in strict]):
        raise DataQualityError(", ".join(bad))
