"""Mixing sources to target weights, by hierarchical budgeting.

The tree is root -> domain -> language -> source. A token budget enters at the root.
At every node it is shared among the children by weight; a child that cannot use its
share (its tokens times the allowed epochs) is filled, and what it leaves goes to its
siblings, and further up only when the whole family is full. Each leaf then takes
whole epochs of its documents and a prefix of one more, in a seeded order that is
dealt anew for every epoch.

All sharing is in whole tokens with exact integer arithmetic, so that any engine gets
the same shares.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged

#: Leading hex digits of the order key that split a leaf for its prefix sums: 16 ** 3 ranges.
KEY_DIGITS = 3
#: Ranges of capacity per weight, for each doubling, by which large families are shared.
RANGES = 64
_EXACT = "decimal(38,0)"


def weight_of(column: Column, weights: Mapping[str, int], default: int = 1) -> Column:
    """Integer weight of a node by its name; `default` for names that aren't listed."""
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(column == name, weight).otherwise(out)
    return out


def share(nodes: DataFrame, parent: Sequence[str], budget: str, name: str, weight: str, capacity: str, out: str, shown: bool = False) -> DataFrame:
    """nodes with `out`: the part of the parent's `budget` that each child gets.

    Children are taken by capacity per weight. A child is filled if its share of what
    is left, by weight among the children left, reaches its capacity; from the first
    child that isn't on, the rest is shared by weight, rounded down. shown adds that rest and
    the weight that shares it (rest__, heads__).
    """
    family = Window.partitionBy(*parent)
    order = family.orderBy(F.col(capacity).cast("double") / F.col(weight), F.col(name))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.greatest(F.col(budget).cast(_EXACT) - F.coalesce(F.sum(F.col(capacity)).over(before), F.lit(0)), F.lit(0).cast(_EXACT))
    rows = nodes.withColumn("left__", left.cast("long")).withColumn("weight__", F.sum(weight).over(onward))
    filled = F.col(capacity).cast(_EXACT) * F.col("weight__") <= F.col(weight).cast(_EXACT) * F.col("left__")
    rows = rows.withColumn("filled__", filled)
    rest = F.max(F.when(~F.col("filled__"), F.col("left__"))).over(family)
    heads = F.max(F.when(~F.col("filled__"), F.col("weight__"))).over(family)
    rows = rows.withColumn("rest__", rest).withColumn("heads__", heads)
    rows = rows.withColumn(out, F.when(F.col("filled__"), F.col(capacity)).otherwise(_part(weight, "rest__", "heads__")).cast("long"))
    return rows.drop("left__", "weight__", "filled__", *([] if shown else ["rest__", "heads__"]))


def _part(weight: str, rest: str, heads: str) -> Column:
    """weight * rest / heads, rounded down."""
    return F.expr(f"cast(cast({weight} as decimal(18,0)) * cast({rest} as decimal(18,0)) as decimal(38,0)) div {heads}")


def share_in_ranges(nodes: DataFrame, parent: Sequence[str], budget: str, name: str, weight: str, capacity: str, out: str) -> DataFrame:
    """What share gives, for families of any size: no family is one task.

    Children are pre-aggregated by ranges of capacity per weight. If the last child of a range
    is filled all before it are, so the sums of ranges tell in which one filling ends. Only that
    range's children are taken one by one, together with one stand-in for all later ranges,
    whose children then share by weight what the stand-in's row shows.
    """
    ratio = F.col(capacity).cast("double") / F.col(weight)
    ranged = nodes.withColumn("range__", F.when(ratio > 0, F.floor(F.log2(ratio) * RANGES)).otherwise(F.lit(-(1 << 40))))
    last = F.max_by(F.struct(F.col(capacity).cast(_EXACT).alias("c"), F.col(weight).cast(_EXACT).alias("w")), F.struct(ratio, F.col(name)))
    sums = ranged.groupBy(*parent, "range__").agg(F.sum(F.col(capacity).cast(_EXACT)).alias("here"), F.sum(F.col(weight).cast(_EXACT)).alias("weights"), last.alias("last"), F.max(budget).cast(_EXACT).alias("given"))
    family = Window.partitionBy(*parent)
    upto, later = family.orderBy("range__").rowsBetween(Window.unboundedPreceding, 0), family.orderBy("range__").rowsBetween(1, Window.unboundedFollowing)
    after = lambda c: F.coalesce(F.sum(c).over(later), F.lit(0).cast(_EXACT))
    sums = sums.withColumn("upto", F.sum("here").over(upto)).withColumn("later_weight", after("weights")).withColumn("later", after("here"))
    none = F.lit(0).cast(_EXACT)
    full = F.col("last.c") * (F.col("later_weight") + F.col("last.w")) <= F.col("last.w") * F.greatest(F.col("given") - F.col("upto") + F.col("last.c"), none)
    sums = sums.withColumn("edge__", F.min(F.when(~full, F.col("range__"))).over(family)).where("range__ = edge__")
    left = F.greatest(F.col("given") - F.col("upto") + F.col("here"), none).cast("long")
    edges = staged(sums.select(*parent, "edge__", left.alias("edge_left__"), F.col("later_weight").cast("long").alias("later_weight__"), F.col("later").cast("long").alias("later__")), "edges")
    placed = ranged.join(edges.select(*parent, "edge__", "edge_left__"), list(parent), "left")
    filled = placed.where("edge__ is null or range__ < edge__").withColumn(out, F.col(capacity).cast("long"))
    inside = placed.where("range__ = edge__").drop(budget).withColumnRenamed("edge_left__", budget).withColumn("later__", F.lit(False))
    rest = edges.where("later_weight__ > 0").select(*parent, F.col("later_weight__").alias(weight), F.col("later__").alias(capacity), F.col("edge_left__").alias(budget), F.lit(True).alias("later__"))
    shared = share(inside.unionByName(rest, allowMissingColumns=True), parent, budget, name, weight, capacity, out, shown=True)
    heads = shared.where("later__").select(*parent, "rest__", "heads__")
    beyond = placed.where("range__ > edge__").join(heads, list(parent)).withColumn(out, _part(weight, "rest__", "heads__").cast("long"))
    columns = [*(c for c in nodes.columns if c != budget), out]
    return reduce(DataFrame.unionByName, [df.select(*columns) for df in (filled, shared.where("not later__"), beyond)])


def _by_size(nodes: DataFrame, budget: str, out: str) -> DataFrame:
    """nodes(tokens, capacity, parent_tokens, parent_capacity) with `out`: equal parts of all
    children's tokens, rounded down, or all they may give."""
    part = F.expr(f"cast(cast(tokens as decimal(18,0)) * cast({budget} as decimal(18,0)) as decimal(38,0)) div greatest(parent_tokens, 1)")
    return nodes.withColumn(out, F.when(F.col("parent_capacity") <= F.col(budget), F.col("capacity")).otherwise(part).cast("long"))


def allocate(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int] | None], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, share) from leaves(domain, lang, source, tokens).

    tokens is what one epoch of a leaf holds; budget may refer to `total`, the tokens
    of all leaves. weights has the weights of a level ("domain", "lang", "source") by name:
    nodes not named, and those of a level left out, weigh 1; a level given as None keeps its
    nodes' own proportions. No list of leaves goes to the driver, and a family of sources may be
    of any size.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    sums = F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")
    langs = leaves.groupBy("domain", "lang").agg(*sums)
    domains = langs.groupBy("domain").agg(*sums)
    whole = domains.agg(F.sum("tokens").alias("total"), F.sum("capacity").alias("parent_capacity")).withColumn("root", F.lit(0))
    root = whole.select("root", F.col("total").alias("parent_tokens"), "parent_capacity", F.least(budget, F.col("parent_capacity")).cast("long").alias("budget"))

    def given(children: DataFrame, parents: DataFrame, parent: list[str], level: str, out: str, divide) -> DataFrame:
        rows = children.join(parents, parent)
        chosen = weights.get(level, {})
        if chosen is None:
            return _by_size(rows, "budget", out)
        return divide(rows.withColumn("weight", weight_of(F.col(level), chosen)), parent, "budget", level, "weight", "capacity", out)

    as_parent = lambda df, *keys: df.select(*keys, F.col("tokens").alias("parent_tokens"), F.col("capacity").alias("parent_capacity"), F.col("share").alias("budget"))
    top = as_parent(given(domains.withColumn("root", F.lit(0)), root, ["root"], "domain", "share", share), "domain")
    mid = as_parent(given(langs, top, ["domain"], "lang", "share", share), "domain", "lang")
    low = given(leaves, mid, ["domain", "lang"], "source", "share", share_in_ranges)
    return low.select("domain", "lang", "source", "tokens", "share")


def mix(docs: DataFrame, domain: Column, lang: Column, source: Column, tokens: Column, budget: Column, weights: Mapping[str, Mapping[str, int] | None], max_epochs: int = 4, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """(id_col, domain, lang, source, n_tokens, epoch) for every document taken, once an
    epoch (from 0). Null domains, languages and sources form nodes named ''.

    In each epoch a leaf's documents are ordered by md5 of seed, epoch and id, then by
    id and tokens. Whole epochs are taken while the leaf's share lasts; of the last, the
    documents whose running sum of tokens stays within the rest. Documents without
    tokens come along with their place in the order. Repeated rows are documents each;
    a null id is ordered as the text 'null'. An empty table gives an empty table.

    A leaf may hold a third of all rows: its running sums are made over ranges of the
    order key, pre-aggregated, and only the range in which the share ends is sorted.
    """
    kind = dict(docs.select(id_col).dtypes)[id_col]
    flat = docs.select(
        F.col(id_col).alias("id__"), *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in (("domain", domain), ("lang", lang), ("source", source))], F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens")
    )
    flat = staged(flat, "tokens")
    leaf = ["domain", "lang", "source"]
    shares = allocate(staged(flat.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), "leaves"), budget, weights, max_epochs)
    plan = shares.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(1).cast("int"))
    plan = plan.withColumn("rest", F.col("share") - F.col("whole") * F.col("tokens")).select(*leaf, "whole", "rest")
    plan = staged(plan, "plan")
    epochs = flat.join(plan, leaf).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.least(F.col("whole"), F.lit(max_epochs - 1)))))
    key = F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("id__").cast("string"), F.lit("null"))), "UTF-8"))
    taken = epochs.where("epoch < whole")
    partial = epochs.where("epoch = whole and rest > 0").withColumn("key__", key).withColumn("range__", F.substring("key__", 1, KEY_DIGITS))
    sums = partial.groupBy(*leaf, "range__").agg(F.sum("n_tokens").alias("here__"))
    upto = Window.partitionBy(*leaf).orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before__", F.coalesce(F.sum("here__").over(upto), F.lit(0)))
    placed = partial.join(sums.join(plan.select(*leaf, F.col("rest").alias("rest__")), leaf).where("before__ <= rest__").drop("rest__"), [*leaf, "range__"])
    inside = placed.where("before__ + here__ <= rest")
    edge = placed.where("before__ + here__ > rest")
    running = Window.partitionBy(*leaf, "range__").orderBy("key__", "id__", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("run__", F.col("before__") + F.sum("n_tokens").over(running)).where("run__ <= rest")
    columns = [F.col("id__").cast(kind).alias(id_col), *leaf, "n_tokens", "epoch"]
    return taken.select(*columns).unionByName(inside.select(*columns)).unionByName(edge.select(*columns))
