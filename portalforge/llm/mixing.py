"""Mixing sources to target weights: hierarchical token budgets (native).

The tree is domain > language > source.  A node's token budget is split among
its children by weight and water-filled: a child that cannot take its share
(all its documents in all allowed epochs) is filled, and the shortage goes to
its siblings by weight; only when a whole subtree is full does the rest reach
the ancestor's other children.  Leaves then take whole epochs and a token
prefix of the next epoch, whose order is a seeded hash of the document.

Plan: one aggregate over the documents, a handful of windows over tree nodes
(one row per node), and a prefix found by hash buckets, so that a leaf with a
third of all rows never meets in one task: only the documents of the single
bucket in which a leaf's budget ends are sorted.  No Python on the rows.

Defined cases: null text has 0 tokens; a null tree level is the level 'none';
a missing weight is 1; weight 0 (or less) excludes the node; the budget is cut
to what the tree can hold; shares are floored, so up to one token per node can
stay unspent; repeated rows are documents of their own; documents are never
cut, so a leaf ends at the last whole document that fits; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalforge.llm.common import WORD_REGEX, stored

LEVELS = ("domain", "lang", "source")
BUCKET_DIGITS = 3  # hex digits of the order hash that name a bucket: 4096 a leaf

# Production targets of the registered query and the pipeline.
WEIGHTS = {
    "domain": {"domain0": 5, "domain1": 3, "domain2": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {"src0": 3},
}
BUDGET_PERCENT = 60
MAX_EPOCHS = 2
SEED = "mix-1"


def domain_of(source: Column) -> Column:
    """Domain of a source: its number modulo three (sources without one: 0)."""
    number = F.regexp_extract(source, r"([0-9]+)$", 1).try_cast("int")
    return F.concat(F.lit("domain"), (F.coalesce(number, F.lit(0)) % 3).cast("string"))


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(level, {})
    if not given:
        return F.lit(1)
    pairs = [x for name, w in given.items() for x in (F.lit(name), F.lit(int(max(w, 0))))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(1))


def _fill(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Water-fill ``parent_budget`` over the children: adds ``budget``.

    Children are ordered by capacity per unit of weight; the ones whose
    capacity is below their share of what is left are full, the others share
    the rest by weight.  Exact integers (decimals) throughout."""
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.col("capacity") / F.col("weight"), F.col(name))
    big = lambda c: c.cast("decimal(20,0)")
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    out = nodes.withColumns({"before": before, "weight_left": weight_left})
    out = out.withColumn("is_full", big(F.col("capacity")) * F.col("weight_left").cast("decimal(14,0)")
                         <= F.col("weight").cast("decimal(14,0)") * big(F.col("parent_budget") - F.col("before")))
    out = out.withColumns({
        "taken": F.coalesce(F.sum(F.when(F.col("is_full"), F.col("capacity"))).over(siblings), F.lit(0)),
        "open_weight": F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(siblings)})
    share = F.expr("(cast(weight as decimal(14,0)) * cast(parent_budget - taken as decimal(20,0)))"
                   " div cast(open_weight as decimal(14,0))")
    return out.withColumn("budget", F.when(F.col("is_full"), F.col("capacity")).otherwise(share).cast("long")) \
        .drop("before", "weight_left", "is_full", "taken", "open_weight")


def leaf_budgets(leaves: DataFrame, *, weights: Mapping[str, Mapping[str, int]], budget_percent: int,
                 max_epochs: int) -> DataFrame:
    """Leaves (tree columns, ``tokens``) -> the same with ``budget``."""
    weighted = leaves
    for level in LEVELS:
        weighted = weighted.withColumn(f"w_{level}", _weight(level, weights).cast("long"))
    usable = (F.col("w_domain") > 0) & (F.col("w_lang") > 0) & (F.col("w_source") > 0)
    weighted = weighted.withColumn("capacity", F.when(usable, F.col("tokens") * max_epochs).otherwise(0))
    everything = Window.partitionBy(F.lit(0))
    budget = F.sum("tokens").over(everything) * budget_percent
    total = F.least(F.expr("budget_all div 100"), F.sum("capacity").over(everything))
    current = weighted.withColumn("budget_all", budget).withColumn("parent_budget", total).drop("budget_all")
    for depth, level in enumerate(LEVELS):
        node, parents = list(LEVELS[:depth + 1]), list(LEVELS[:depth])
        nodes = current.filter("capacity > 0").groupBy(*node).agg(
            F.sum("capacity").alias("capacity"), F.first(f"w_{level}").alias("weight"),
            F.first("parent_budget").alias("parent_budget"))
        filled = _fill(nodes, parents, level).select(*node, F.col("budget").alias("node_budget"))
        current = current.join(filled, node, "left").withColumn(
            "parent_budget", F.coalesce("node_budget", F.lit(0).cast("long"))).drop("node_budget")
    return current.select(*LEVELS, "tokens", F.col("parent_budget").alias("budget"))


def _order_hash(seed: str, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), doc_id.cast("string")))


def _with_order(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Rows with their leaf's plan and their place in the leaf's last epoch."""
    joined = rows.join(plan, list(LEVELS), "inner")
    joined = joined.withColumn("mix_key", _order_hash(seed, F.col("mix_full") + 1, F.col("doc_id")))
    return joined.withColumn("mix_bucket", F.substring("mix_key", 1, BUCKET_DIGITS))


def mix(docs: DataFrame, *, weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
        budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
        keep: Sequence[str] = ()) -> DataFrame:
    """Documents (doc_id, text, lang, source) -> the mixture: one row per
    document and epoch with domain, lang, source, epoch, n_tokens and the
    ``keep`` columns (e.g. the text; ``keep_<name>`` if the name is taken)."""
    level = lambda c: F.coalesce(F.col(c), F.lit("none"))
    tree = docs.select(
        *[docs[c].alias(f"keep_{c}") for c in keep], "doc_id",
        domain_of(F.col("source")).alias("domain"), level("lang").alias("lang"),
        level("source").alias("source"), token_count(F.col("text")).alias("n_tokens"))
    counted = stored(tree.select("doc_id", *LEVELS, "n_tokens"), "mix-tokens")

    leaves = counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, weights=weights, budget_percent=budget_percent, max_epochs=max_epochs)
    plan = stored(budgets.select(
        *LEVELS,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("int").alias("mix_full"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("mix_rest")), "mix-plan")

    # the bucket of the next epoch in which each leaf's prefix ends
    buckets = _with_order(counted, plan.filter("mix_rest > 0"), seed).groupBy(*LEVELS, "mix_rest", "mix_bucket").agg(
        F.sum("n_tokens").alias("bucket_tokens"))
    upto = Window.partitionBy(*LEVELS).orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = buckets.withColumn("after", F.sum("bucket_tokens").over(upto)).filter("after > mix_rest") \
        .groupBy(*LEVELS).agg(F.min("mix_bucket").alias("mix_cut"),
                              F.min_by(F.col("after") - F.col("bucket_tokens"), "mix_bucket").alias("mix_before"))
    plan = stored(plan.join(ends, list(LEVELS), "left"), "mix-cuts")

    rows = _with_order(tree if keep else counted, plan, seed)
    rows = rows.withColumn("mix_in_cut", F.coalesce(F.col("mix_bucket") == F.col("mix_cut"), F.lit(False)))
    produced = {"doc_id", *LEVELS, "n_tokens", "epoch"}
    out = [*[F.col(f"keep_{c}").alias(f"keep_{c}" if c in produced else c) for c in keep], F.col("doc_id"), *[F.col(c) for c in LEVELS], F.col("n_tokens")]
    whole = rows.withColumn("mix_partial", (F.col("mix_rest") > 0) & F.coalesce(F.col("mix_bucket") < F.col("mix_cut"), F.lit(False)))
    epochs = F.col("mix_full") + F.col("mix_partial").cast("int")
    whole = whole.withColumn("mix_epochs", epochs).filter("mix_epochs > 0").select(
        *out, F.explode(F.sequence(F.lit(1), F.col("mix_epochs"))).alias("epoch"))
    running = Window.partitionBy(*LEVELS).orderBy("mix_key", "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, 0)
    edge = rows.filter((F.col("mix_rest") > 0) & F.col("mix_in_cut")).withColumn(
        "mix_after", F.col("mix_before") + F.sum("n_tokens").over(running)).filter("mix_after <= mix_rest").select(
        *out, (F.col("mix_full") + 1).alias("epoch"))
    return whole.unionByName(edge)
