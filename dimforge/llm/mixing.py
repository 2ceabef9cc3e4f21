"""Mixing sources to target weights by hierarchical budgeting.

Sources form a tree: domain, language, source.  A token budget is handed down
the tree by weights.  A leaf can use its tokens at most ``max_epochs`` times; what
it can't use goes to its siblings first (again by weight, as far as they can use
it), and only what a whole subtree can't use goes to the ancestor's other
children.  Each leaf then takes whole epochs of its documents and the prefix of
one more, in an order seeded per epoch.

The tree's table (a row per leaf) is handed down with Spark's grouped sums, level
by level.  A leaf's prefix is found by narrowing: tokens are summed in 1024 cells
of the seeded order, then in 1024 cells of the cell where the budget ends, and
only the documents of the last cell are summed one by one, so that a leaf may
hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.line_rules import words_of
from dimforge.llm.shared import pick, store

LEVELS = ("domain", "lang", "source")
CELL_BITS = 10
ORDER_BITS = 60  # of the seeded order


def share_out(children: DataFrame, parents: list[str], own: str) -> DataFrame:
    """Give each group's ``budget`` to its rows by ``weight``, no row more than its ``most``: adds ``granted``.

    Water filling in closed form: in the order of most / weight, a row is full if
    the budget left, shared by the weights left, would give it at least its most.
    Amounts are rounded down, and what that leaves goes, one token a row, to the
    first rows with room by name.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("most").cast("decimal(38,12)") / F.col("weight"), own)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = (children
              .withColumn("_weights", F.sum("weight").over(rest).cast("decimal(38,0)"))
              .withColumn("_used", F.coalesce(F.sum("most").over(before), F.lit(0)).cast("decimal(38,0)")))
    # rows are full from the first on until one is not
    fits = F.col("most").cast("decimal(38,0)") * F.col("_weights") <= F.greatest(
        F.col("budget").cast("decimal(38,0)") - F.col("_used"), F.lit(0)) * F.col("weight")
    filled = filled.withColumn("_full", F.min(fits.cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 1)
    group = Window.partitionBy(*parents)
    filled = (filled
              .withColumn("_left", F.col("budget") - F.sum(F.when(F.col("_full"), F.col("most")).otherwise(0)).over(group))
              .withColumn("_open", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(group)))
    part = F.expr("cast((cast(_left as decimal(38,0)) * weight) div _open as bigint)")
    filled = filled.withColumn("granted", F.when(F.col("_full"), F.col("most")).otherwise(part))
    spare = F.col("budget") - F.sum("granted").over(group)
    turn = F.row_number().over(Window.partitionBy(*parents).orderBy(F.col("granted") >= F.col("most"), own))
    return (filled.withColumn("_spare", spare).withColumn("_turn", turn)
            .withColumn("granted", F.col("granted") + ((F.col("_turn") <= F.col("_spare"))
                                                       & (F.col("granted") < F.col("most"))).cast("long"))
            .drop("_weights", "_used", "_full", "_left", "_open", "_spare", "_turn"))


def budgets(leaves: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """``leaves(domain, lang, source, tokens, weight)`` -> with ``granted`` tokens per leaf.

    A subtree's weight is the sum of its leaves' weights.  ``total`` is cut to
    what all leaves together can use.
    """
    tree = leaves.withColumn("most", F.col("tokens") * max_epochs)
    granted = None
    for depth, own in enumerate(LEVELS):
        above, keys = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        level = tree.groupBy(*keys).agg(F.sum("weight").alias("weight"), F.sum("most").alias("most"))
        if granted is None:
            level = level.withColumn("_all", F.sum("most").over(Window.partitionBy(F.lit(0)))).withColumn(
                "budget", F.least(F.lit(total).cast("long"), F.col("_all"))).drop("_all").withColumn("_root", F.lit(0))
            granted = share_out(level, ["_root"], own).select(*keys, F.col("granted").alias("budget"))
        else:
            granted = share_out(level.join(granted, above), above, own).select(*keys, F.col("granted").alias("budget"))
    return leaves.join(granted.withColumnRenamed("budget", "granted"), list(LEVELS))


def seeded_order(seed: int, epoch: Column, *identity: Column) -> Column:
    """A place in [0, 2**60) for a document in an epoch; MD5, as SQL of other engines has it too."""
    name = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), *(x.cast("string") for x in identity))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def _narrow(rows: DataFrame, wanted: DataFrame, shift: int) -> DataFrame:
    """One step: ``wanted(leaf keys, cell, need)`` -> the next finer cell in which ``need`` tokens end.

    ``rows`` has ``place`` and ``n_tokens``.  The cell before has been taken whole.
    """
    keys = list(LEVELS)
    own = rows.join(wanted, keys).where(F.shiftright("place", shift + CELL_BITS) == F.col("cell"))
    sums = own.groupBy(*keys, "need", F.shiftright("place", shift).alias("next")).agg(F.sum("n_tokens").alias("n"))
    ordered = Window.partitionBy(*keys).orderBy("next")  # at most 2**CELL_BITS rows
    sums = sums.withColumn("until", F.sum("n").over(ordered)).where(
        (F.col("until") - F.col("n") < F.col("need")) & (F.col("need") <= F.col("until")))
    return sums.select(*keys, F.col("next").alias("cell"), (F.col("need") - F.col("until") + F.col("n")).alias("need"))


def n_tokens(text: Column) -> Column:
    """What a document costs: its words."""
    return F.size(words_of(F.coalesce(text, F.lit("")))).cast("long")


def with_domain(documents: DataFrame) -> DataFrame:
    """Documents with a ``domain`` where a corpus names none: sources by the first digit of their MD5."""
    digit = F.substring(F.md5(F.coalesce(F.col("source").cast("string"), F.lit("none")).cast("binary")), 1, 1)
    return documents.withColumn("domain", F.concat(F.lit("d"), digit))


def mix(documents: DataFrame, weights: DataFrame | None, total: int | None = None, max_epochs: int = 2,
        seed: int = 7) -> DataFrame:
    """``documents(doc_id, text, domain, lang, source)`` -> ``(doc_id, domain, lang, source, n_tokens, epochs)``.

    A row for each document that is taken, ``epochs`` how often.  ``weights`` has
    (domain, lang, source, weight) with whole weights of at least 1; leaves
    without a row, or all if it is None, weigh 1.  ``total`` tokens (words) are
    wanted; None asks for as many as there are.  A leaf takes documents of an
    epoch in seeded order up to the last that fits its grant wholly; at equal
    places the smaller (doc_id, n_tokens) goes first.  Null and wordless texts
    have no token and go with a leaf's whole epochs only; null keys are the leaf
    ``none``; rows that are equal in all of these are taken alike.  Other columns
    are ignored.
    """
    keys = list(LEVELS)
    docs = pick(documents, doc_id="long", text="string", domain="string", lang="string", source="string").select(
        "doc_id", *(F.coalesce(F.col(k), F.lit("none")).alias(k) for k in keys),
        n_tokens(F.col("text")).alias("n_tokens"))
    docs = store(docs, "mix")
    leaves = docs.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"))
    if weights is None:
        leaves = leaves.withColumn("weight", F.lit(1).cast("long"))
    else:
        given = weights.groupBy(*keys).agg(F.max("weight").cast("long").alias("weight"))
        leaves = leaves.join(given, keys, "left").withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))
    if total is None:
        total = leaves.agg(F.sum("tokens")).first()[0] or 0
    granted = store(budgets(leaves, total, max_epochs), "grants")
    plan = granted.select(*keys, F.when(F.col("tokens") > 0, F.floor(F.col("granted") / F.col("tokens"))).otherwise(
        F.lit(1)).cast("long").alias("whole"), F.when(F.col("tokens") > 0, F.col("granted") % F.col("tokens")).otherwise(
        F.lit(0)).cast("long").alias("need"))
    placed = docs.join(plan.select(*keys, "whole"), keys).withColumn(
        "place", seeded_order(seed, F.col("whole"), F.col("source"), F.col("doc_id")))
    # the cell in which the need ends, in two steps; then its documents one by one
    wanted = plan.where("need > 0").select(*keys, F.lit(0).cast("long").alias("cell"), "need")
    rows = placed.select(*keys, "place", "n_tokens")
    shift = ORDER_BITS - CELL_BITS
    first = _narrow(rows, wanted, shift)
    second = _narrow(rows, first, shift - CELL_BITS)
    last = shift - CELL_BITS
    ordered = Window.partitionBy(*keys).orderBy("place", F.col("doc_id").asc_nulls_first(), "n_tokens")
    inside = (placed.join(second.withColumnRenamed("need", "rest"), keys)
              .where(F.shiftright("place", last) == F.col("cell"))
              .withColumn("until", F.sum("n_tokens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
              .where(F.col("until") <= F.col("rest"))
              .groupBy(*keys).agg(F.max(F.struct("place", "doc_id", "n_tokens")).alias("end")))
    limits = second.join(inside, keys, "left").select(*keys, F.shiftleft("cell", last).alias("cell_start"), "end")
    taken = placed.join(limits, keys, "left")
    this = F.struct("place", "doc_id", "n_tokens")
    partial = (F.col("n_tokens") > 0) & F.col("cell_start").isNotNull() & ((F.col("place") < F.col("cell_start"))
                                                 | (F.col("end").isNotNull() & (this <= F.col("end"))))
    epochs = F.col("whole") + F.coalesce(partial, F.lit(False)).cast("long")
    return taken.withColumn("epochs", epochs).where("epochs > 0").select("doc_id", *keys, "n_tokens", "epochs")


def _share_sql(source: str, parents: str, own: str) -> str:
    order = f"PARTITION BY {parents} ORDER BY most::DOUBLE / weight, {own}"
    return f"""
  SELECT * EXCLUDE (part, taken), part + (CASE WHEN taken <= budget - sum(part) OVER (PARTITION BY {parents})
                                                AND part < most THEN 1 ELSE 0 END) AS granted
  FROM (SELECT *, row_number() OVER (PARTITION BY {parents} ORDER BY part >= most, {own}) AS taken
  FROM (SELECT * EXCLUDE (filled), CASE WHEN filled THEN most ELSE
          ((budget - sum(CASE WHEN filled THEN most ELSE 0 END) OVER (PARTITION BY {parents}))::HUGEINT * weight)
          // nullif(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (PARTITION BY {parents}), 0) END AS part
  FROM (SELECT * EXCLUDE (fits), min(fits) OVER ({order} ROWS UNBOUNDED PRECEDING) = 1 AS filled
  FROM (SELECT *, (most::HUGEINT * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
          <= greatest(budget - coalesce(sum(most) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
             * weight)::INTEGER AS fits
  FROM ({source})))))"""


def mix_sql(weight: str, seed: int = 7, max_epochs: int = 2) -> str:
    """The mix of ``documents`` as SQL, every leaf's prefix by one running sum; ``weight`` is an expression of a leaf."""
    levels, given = [], "SELECT least((SELECT sum(tokens) FROM leaves), (SELECT sum(most) FROM leaves)) AS budget"
    for depth, own in enumerate(LEVELS):
        above, keys = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[:depth + 1])
        level = f"SELECT {keys}, sum(weight) AS weight, sum(most) AS most FROM leaves GROUP BY {keys}"
        source = (f"SELECT * FROM ({level}) CROSS JOIN ({given})" if not depth else
                  f"SELECT * FROM ({level}) JOIN (SELECT {above}, granted AS budget FROM level{depth - 1}) USING ({above})")
        levels.append(f"level{depth} AS ({_share_sql(source, above or '1', own)})")
    keys = ", ".join(LEVELS)
    return f"""
WITH docs AS (
  SELECT doc_id, 'd' || left(md5(coalesce(source, 'none')), 1) AS domain, coalesce(lang, 'none') AS lang,
         coalesce(source, 'none') AS source,
         len(list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> ''))::BIGINT AS n_tokens
  FROM documents
), leaves AS (
  SELECT {keys}, sum(n_tokens) AS tokens, sum(n_tokens) * {max_epochs} AS most, {weight} AS weight FROM docs GROUP BY {keys}
), {", ".join(levels)}, plan AS (
  SELECT {keys}, CASE WHEN tokens > 0 THEN granted // tokens ELSE 1 END AS whole,
         CASE WHEN tokens > 0 THEN granted % tokens ELSE 0 END AS need
  FROM leaves JOIN (SELECT {keys}, granted FROM level2) USING ({keys})
), placed AS (
  SELECT *, ('0x' || left(md5(concat_ws('|', {seed}, whole, source, doc_id)), 15))::BIGINT AS place
  FROM docs JOIN plan USING ({keys})
), taken AS (
  SELECT *, whole + (n_tokens > 0 AND sum(n_tokens) OVER (PARTITION BY {keys} ORDER BY place, doc_id NULLS FIRST, n_tokens
                                                          ROWS UNBOUNDED PRECEDING) <= need)::BIGINT AS epochs FROM placed
)
SELECT doc_id, {keys}, n_tokens, epochs::BIGINT AS epochs FROM taken WHERE epochs > 0
"""
