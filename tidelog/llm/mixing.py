"""Mixing sources to target weights: hierarchical token budgets, then seeded epochs.

The budget of the root goes down a tree (say domain, language, source) by integer
weights. A node never gets more than its subtree can give (its tokens times the epochs
allowed). What a child can't take goes to its siblings, in proportion to their weights,
until they are full as well; only what a whole family can't take leaves it, as the
family then counts with its capacity among its own siblings. What lies below a weight of 0
can take nothing, so it counts in no capacity.

The level of water among siblings is found in closed form: in order of capacity per
weight, a child is full if it fills up before the rest share what remains.

A leaf with budget g and T tokens takes g // T whole epochs, and of one more epoch the
documents in seeded order up to the remaining tokens. Sums along that order are made in
two steps (over slices of the order, then within a slice), so a leaf with a third of all
documents is spread over as many tasks as it has slices. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BIG = "decimal(38,0)"
#: A table of leaves of at most this many rows goes to all tasks (under 200 bytes each).
BROADCAST_LEAVES = 20_000


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    """Weight of a node of one level: given by name, else 1."""
    out: Column | None = None
    for name, w in sorted(weights.items()):
        out = F.when(F.col(level) == name, F.lit(w)) if out is None else out.when(F.col(level) == name, F.lit(w))
    return (F.lit(1) if out is None else out.otherwise(F.lit(1))).cast("long")


def _share(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Fill siblings from their parent's ``given``: ``nodes`` has weight, capacity and given, of the parent."""
    by = [F.col(c) for c in parents] or [F.lit(0)]
    w, cap, given = (F.col(c).cast(_BIG) for c in ("weight", "capacity", "given"))
    order = Window.partitionBy(*by).orderBy(F.col("ratio").asc_nulls_last(), F.col(level))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    family = Window.partitionBy(*by)
    nodes = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity").cast("double") / F.col("weight").cast("double")))
    step = nodes.select(
        "*",
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("cap_before"),
        (F.sum(w).over(family) - F.coalesce(F.sum(w).over(before), F.lit(0))).alias("w_left"),
        F.coalesce(F.sum(w).over(before), F.lit(0)).alias("w_before"),
    )
    left = F.greatest(given - F.col("cap_before"), F.lit(0).cast(_BIG))
    full = (cap * F.col("w_left") <= w * left) & (F.col("weight") > 0)
    step = step.withColumn("full", full)
    # What the full ones leave, dealt to the rest by weight; rounded so that it adds up.
    rest = given - F.coalesce(F.sum(F.when(F.col("full"), cap)).over(family), F.lit(0))
    rest_w = F.coalesce(F.sum(F.when(~F.col("full"), w)).over(family), F.lit(0))
    rest_before = F.coalesce(F.sum(F.when(~F.col("full"), w)).over(before), F.lit(0))
    step = step.select("*", rest.alias("rest"), rest_w.alias("rest_w"), rest_before.alias("rest_before"))
    upto = lambda x: F.expr(f"div(cast(rest as {_BIG}) * cast({x} as {_BIG}), greatest(cast(rest_w as {_BIG}), 1))")
    dealt = upto(f"(rest_before + cast(weight as {_BIG}))") - upto("rest_before")
    granted = F.when(F.col("full"), F.col("capacity")).otherwise(F.least(F.col("capacity"), dealt.cast("long")))
    return step.withColumn("granted", granted.cast("long")).select(*parents, level, "capacity", F.col("granted").alias("given"))


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], budget: int, weights: Mapping[str, Mapping[str, int]], max_epochs: int) -> DataFrame:
    """``*levels, tokens, given`` of each leaf; ``leaves`` has the levels and ``tokens``."""
    served = F.lit(True)
    for level in levels:
        served &= _weight(level, weights.get(level, {})) > 0
    known = leaves.withColumn("capacity", F.when(served, F.col("tokens") * max_epochs).otherwise(0).cast("long"))
    given: DataFrame | None = None
    for i, level in enumerate(levels):
        parents, here = list(levels[:i]), list(levels[: i + 1])
        nodes = known.groupBy(*here).agg(F.sum("capacity").alias("capacity")).withColumn("weight", _weight(level, weights.get(level, {})))
        if given is None:
            nodes = nodes.withColumn("given", F.least(F.lit(budget).cast("long"), F.sum("capacity").over(Window.partitionBy(F.lit(0)))))
        else:
            nodes = nodes.join(given.select(*parents, F.col("given")), parents)
        given = _share(nodes, parents, level)
    return known.join(given.select(*levels, "given"), list(levels)).select(*levels, "tokens", "given")


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    *,
    budget: int | None = None,
    budget_share: tuple[int, int] | None = None,
    weights: Mapping[str, Mapping[str, int]],
    max_epochs: int = 4,
    seed: int = 0,
    slices: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Selected documents: ``doc_id, <levels>, epoch, n_tokens, take_tokens`` and ``keep``.

    ``levels``: names and columns of the tree, root's children first. A document counts
    ``tokens`` (a column of whole numbers, as of a token count), or without that a token per
    four bytes of UTF-8, rounded up. ``budget`` is in tokens, or ``budget_share``
    gives it as a fraction of all tokens. Nodes without a weight count 1; a weight of 0
    gives nothing. The last document of a leaf's prefix has ``take_tokens`` under
    ``n_tokens``.

    Nulls in a level are the level ''. Null and empty texts, or null counts, have no tokens
    and are never selected. The order hashes a row's id and text, so rows without an id, or
    of one id, are drawn by their texts; rows equal in both stand together in it, and each is
    selected for itself. An empty table gives no rows. Columns that clash with names used here aren't read unless
    named in ``keep``.
    """
    spark = docs.sparkSession
    names = list(levels)
    if tokens is None:
        tokens = F.ceil(F.octet_length(F.col(text_col).cast("string")) / 4)
    tokens = F.coalesce(tokens, F.lit(0)).cast("long")
    kept = [F.col(c).alias(f"kept_{c}") for c in keep]
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")) if text_col in docs.columns else F.lit("")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()], tokens.alias("n_tokens"), digest.alias("text_digest"), *kept)
    rows = rows.where(F.col("n_tokens") > 0)
    plain = rows.select("doc_id", *names, "n_tokens", "text_digest")
    leaves = plain.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    size = leaves.agg(F.count("*").alias("leaves"), F.sum("tokens").alias("tokens"), F.sum("n_docs").alias("docs")).first()
    if budget is None:
        part, whole = budget_share or (1, 1)
        budget = (size["tokens"] or 0) * part // whole
    slices = slices or max(16, (size["docs"] or 0) // 8192)
    given = leaf_budgets(leaves.drop("n_docs"), names, budget, weights, max_epochs)
    given = given.select(*names, (F.expr("given div tokens")).alias("whole"), (F.col("given") % F.col("tokens")).alias("part"))
    if size["leaves"] <= BROADCAST_LEAVES:
        given = F.broadcast(given)

    def placed(df: DataFrame) -> DataFrame:
        """The order within the leaf's partial epoch, and the slice of that order."""
        order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_digest")).cast("binary"))
        df = df.join(given, names).withColumn("order_key", order)
        return df.withColumn("slice", F.expr(f"cast(conv(substring(order_key, 1, 8), 16, 10) as long) * {slices} div 4294967296"))

    by_slice = placed(plain).where(F.col("part") > 0).groupBy(*names, "slice").agg(F.sum("n_tokens").alias("in_slice"))
    ahead = Window.partitionBy(*names).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    by_slice = by_slice.select(*names, "slice", F.coalesce(F.sum("in_slice").over(ahead), F.lit(0)).alias("slice_start"))
    out = placed(rows)
    whole = out.where(F.col("whole") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1))).withColumn("take_tokens", F.col("n_tokens"))
    # Slices that begin past the prefix are left out before anything is ordered.
    begun = out.where(F.col("part") > 0).join(by_slice, [*names, "slice"]).where(F.col("slice_start") < F.col("part"))
    inside = Window.partitionBy(*names, "slice").orderBy("order_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("slice_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    prefix = begun.withColumn("take_tokens", F.least(F.col("n_tokens"), F.col("part") - start)).where(F.col("take_tokens") > 0).withColumn("epoch", F.col("whole"))
    columns = ["doc_id", *names, "epoch", "n_tokens", "take_tokens"]
    both = whole.select(*columns, *[f"kept_{c}" for c in keep]).unionByName(prefix.select(*columns, *[f"kept_{c}" for c in keep]))
    return both.select(*columns, *[F.col(f"kept_{c}").alias(c if c not in columns else f"kept_{c}") for c in keep])
