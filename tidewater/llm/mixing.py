"""Mixing sources to target weights by hierarchical budgeting.

Weights go down a tree domain - language - source. A node that cannot use its budget passes the
shortage to its siblings in proportion to their weights, and only what all of them cannot take goes
up to its parent's siblings. A leaf's budget is taken as whole epochs of all its documents and then
a prefix of one more epoch in an order drawn from the seed, counted in tokens.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clean

#: Slices of a leaf's hash order; only the slice in which a prefix ends is sorted row by row.
SLICES = 4_096
#: Rows of the plan (mixes x leaves), which the driver computes and every task receives.
MAX_PLAN = 100_000

# ---- fixed values: domains of the sources' kinds ---------------------------------------------
DOMAINS = {
    "PRODUCT_REVIEW": "CUSTOMER", "SUPPORT_TICKET": "CUSTOMER", "CHAT_TRANSCRIPT": "CUSTOMER", "RETURN_NOTE": "CUSTOMER",
    "STORE_LOG": "OPERATIONS", "RUNBOOK": "OPERATIONS", "TRAINING_MANUAL": "OPERATIONS", "POLICY_FAQ": "OPERATIONS", "SUPPLIER_MAIL": "PARTNER",
}
# ---- end of fixed values ---------------------------------------------------------------------


@dataclass
class Node:
    weight: float
    capacity: float = 0.0  # of a leaf: tokens times repeats
    children: dict[str, Node] = field(default_factory=dict)
    budget: float = 0.0

    def room(self) -> float:
        return sum(c.room() for c in self.children.values()) if self.children else self.capacity

    def assign(self, tokens: float) -> None:
        """Gives this node ``tokens`` (at most its room) and deals them out below."""
        self.budget = tokens
        left, open_ = tokens, {k: c for k, c in self.children.items() if c.weight > 0 and c.room() > 0}
        given = dict.fromkeys(self.children, 0.0)
        while open_ and left > 1e-9:
            total = sum(c.weight for c in open_.values())
            full = {k for k, c in open_.items() if c.room() - given[k] <= left * c.weight / total + 1e-9}
            if not full:
                for k, c in open_.items():
                    given[k] += left * c.weight / total
                break
            # Those that run short get all they have; the rest is dealt again among their siblings.
            for k in full:
                left -= open_[k].room() - given[k]
                given[k] = open_.pop(k).room()
        for k, c in self.children.items():
            c.assign(given[k])


def tree(leaves: list[tuple[str, str, str, float, float]]) -> Node:
    """Root of (domain, language, source, weight, capacity) leaves; a node's weight is its leaves' sum."""
    root = Node(0.0)
    for domain, lang, source, weight, capacity in leaves:
        at = root
        at.weight += weight
        for name in (domain, lang, source):
            at = at.children.setdefault(name, Node(0.0))
            at.weight += weight
        at.capacity += capacity
    return root


def language(col: str):
    """Two-letter language in upper case, without region; UND where there is none."""
    return F.coalesce(F.when(clean(col).rlike("^[A-Z]{2}([-_].*)?$"), F.substring(clean(col), 1, 2)), F.lit("UND"))


@dataclass
class Plan:
    """Per mix and leaf: budget, and how it is met (whole epochs, tokens of the next one)."""

    leaves: list[tuple]  # mix, domain, lang, source, epochs, rest, budget
    targets: list[tuple]  # mix, source, target share of the total, tokens there are, most usable


def plan(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> Plan:
    """Budgets of every mix. ``sized`` has source and lang as cleaned here, and n_tokens.

    Without ``total_tokens`` a mix is as large as its scarcest source allows at exact shares; with
    it, short sources are made up for by their siblings, and the mix ends early only where nothing
    is left. A source's weight is dealt to its languages as its tokens are. Sources without any
    tokens have no share; weights that are NULL or not positive count as absent; repeats below 1
    allow none. Of repeated target rows of one source the weights add up and the larger repeat holds.
    """
    want = targets.where("target_weight > 0").groupBy("mix_name", clean("source").alias("source")).agg(F.sum("target_weight").alias("w"), F.max("max_repeats").alias("r"))
    rows = want.where("source IS NOT NULL AND mix_name IS NOT NULL").collect()  # a setting: one row per mix and source
    names = sorted({r.source for r in rows})
    there = sized.where(F.col("source").isin(names) & (F.col("n_tokens") > 0)).groupBy("source", "lang").agg(F.sum("n_tokens").alias("n")).collect()
    if len(rows) * max(1, len({t.lang for t in there})) > MAX_PLAN:
        raise ValueError(f"more than {MAX_PLAN} mix leaves")
    tokens: dict[str, dict[str, int]] = {}
    for t in there:
        tokens.setdefault(t.source, {})[t.lang] = t.n
    result = Plan([], [])
    for mix in sorted({r.mix_name for r in rows}):
        mine = sorted((r for r in rows if r.mix_name == mix), key=lambda r: r.source)
        asked = sum(r.w for r in mine)
        leaves = []
        for r in mine:
            have = sum(tokens.get(r.source, {}).values())
            result.targets.append((mix, r.source, r.w / asked, have, have * max(0, r.r or 0)))
            for lang, n in sorted(tokens.get(r.source, {}).items()):
                leaves.append((DOMAINS.get(r.source, "OTHER"), lang, r.source, r.w * n / have, n * max(0, r.r or 0)))
        usable = [x for x in leaves if x[4] > 0]
        root = tree(usable)
        if not usable:
            continue
        exact = min(x[4] * root.weight / x[3] for x in usable)
        root.assign(min(root.room(), exact if total_tokens is None else total_tokens))
        for domain, lang, source, _, _ in usable:
            budget = root.children[domain].children[lang].children[source].budget
            n = tokens[source][lang]
            epochs = int((budget + 1e-6) // n)
            result.leaves.append((mix, domain, lang, source, epochs, max(0, round(budget - epochs * n)), budget))
    return result


def select(sized: DataFrame, the_plan: Plan, seed: int = 0) -> DataFrame:
    """(mix_name, domain, lang, source, doc_id, n_tokens, copies) of the documents in each mix.

    A document is used ``copies`` times: once per whole epoch, and once more if it lies in the prefix
    of the next epoch. The prefix ends at the document border nearest to its budget, so a leaf misses
    its budget by half a document at most. Prefix sums go over SLICES hash slices per leaf; only the
    slice that holds the border is ordered by row, so a leaf with a third of all rows is no burden.
    """
    spark = sized.sparkSession
    leaves = spark.createDataFrame(the_plan.leaves, "mix_name string, domain string, lang string, source string, epochs bigint, rest bigint, budget double")
    # The plan has at most MAX_PLAN rows, checked when it is made.
    docs = sized.where("n_tokens > 0 AND doc_id IS NOT NULL").select("doc_id", "source", "lang", "n_tokens").join(F.broadcast(leaves), ["source", "lang"])
    order = F.xxhash64(F.lit(seed), "mix_name", "epochs", "doc_id")
    docs = docs.withColumn("h", order).withColumn("slice", F.shiftrightunsigned("h", 52))
    leaf = ["mix_name", "source", "lang"]
    sums = docs.where("rest > 0").groupBy(*leaf, "slice").agg(F.sum("n_tokens").alias("t"))
    before = F.sum("t").over(Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*leaf, "slice", F.coalesce(before, F.lit(0)).alias("b"), "t")
    put = docs.join(sums, [*leaf, "slice"], "left")
    inside = F.col("b") + F.col("t") <= F.col("rest")
    crossing = F.col("b").isNotNull() & ~inside & (F.col("b") < F.col("rest"))
    plain = put.where(~crossing | F.col("b").isNull()).withColumn("more", F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0))
    row = Window.partitionBy(*leaf).orderBy("h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = put.where(crossing).withColumn("upto", F.col("b") + F.sum("n_tokens").over(row))
    nearer = F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("n_tokens"))
    edge = edge.withColumn("more", F.when((F.col("upto") <= F.col("rest")) | nearer, 1).otherwise(0)).drop("upto")
    chosen = plain.unionByName(edge).withColumn("copies", F.col("epochs") + F.col("more")).where("copies > 0")
    return chosen.select("mix_name", "domain", "lang", "source", "doc_id", "n_tokens", "copies")


def shares(chosen: DataFrame, the_plan: Plan) -> DataFrame:
    """Per mix and source: target share, actual share of the mix's tokens, and what there was to use."""
    spark = chosen.sparkSession
    targets = spark.createDataFrame(the_plan.targets, "mix_name string, source string, target_share double, available_tokens bigint, usable_tokens bigint")
    took = chosen.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("uses"), F.max("copies").alias("most_copies"))
    all_ = targets.join(took, ["mix_name", "source"], "left").fillna(0, ["tokens", "uses", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy("mix_name"))  # one row per mix and source
    return all_.select("mix_name", "source", "target_share", F.coalesce(F.try_divide(F.col("tokens"), total), F.lit(0.0)).alias("actual_share"), "tokens", "uses", "most_copies", "available_tokens", "usable_tokens")
