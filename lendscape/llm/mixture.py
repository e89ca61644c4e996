"""Mixing sources to target weights by hierarchical budgets.

A token budget is passed down a tree of levels (domain, language, source).
Children share it by weight. What a child can't use, because its documents run
out, goes to its siblings; only what a whole family can't use goes to the
family's siblings, since a family never gets more than it can use. Each leaf
then takes whole epochs of its documents, and of the last epoch the prefix, in
an order seeded by epoch, that starts before its budget is used up.

The prefix of a leaf is found by a table of counts over slices of the order and
a running total inside the one slice where the budget ends, so that no task
sorts a leaf.

Defined cases: a NULL level is a value of its own; a NULL text has no tokens; a
weight of 0 gets nothing; documents that tie in the order (repeated ids, missing
ids) are taken or left together; a budget beyond all epochs takes everything; an
empty table gives an empty result; fractions of a token are dropped per child.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscape.llm.common import fresh, table, text_of, words_of
from lendscape.session import keep

LEVELS = ("domain", "lang", "source")
# Whole numbers; a value that is not listed weighs 1.
WEIGHTS = {"lang": {"en": 4, "de": 2, "es": 2, "fr": 2}}
BUDGET_PCT = 60
EPOCHS = 2
SEED = 17
SLICE_DIGITS = 3


def domain_of(source: Column) -> Column:
    """Sources come in families of five by their number."""
    number = F.try_to_number(F.regexp_extract(source, r"^src([0-9]{1,9})$", 1), F.lit("999999999")).cast("long")
    return F.coalesce(F.concat(F.lit("family"), F.floor(number / 5).cast("string")), F.lit("other"))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    listed = weights.get(level) or {}
    pairs = [F.lit(x) for k, w in listed.items() for x in (k, w)]
    return (F.coalesce(F.element_at(F.create_map(*pairs), F.col(level)), F.lit(1)) if pairs else F.lit(1)).cast("long")


def allot(leaves: DataFrame, budget: Column, levels: tuple[str, ...] = LEVELS, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:  # noqa: ANN001
    """``leaves`` (levels and ``tokens``) with the tokens each may use as ``budget``.

    Every family is a window over rows of one level's counts.
    """
    known = leaves.withColumn("_parent", budget)
    for i, level in enumerate(levels):
        nodes = known.groupBy(*levels[: i + 1]).agg(F.first("_parent").alias("_b"), (F.sum("tokens") * epochs).alias("_cap"))
        nodes = nodes.withColumn("_w", _weight(level, weights))
        family = Window.partitionBy(*(levels[:i] or [F.lit(0)]))
        filled = family.orderBy((F.col("_cap") / F.nullif(F.col("_w"), F.lit(0))).asc_nulls_last(), F.col(level).asc_nulls_first())
        before = F.coalesce(F.sum("_cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("_w").over(filled.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("_full", (F.col("_w") > 0) & (F.col("_cap") * rest <= F.col("_w") * (F.col("_b") - before)))
        spent = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(family), F.lit(0))
        weight = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(family)
        share = F.expr("_w * (_b - _spent) div nullif(_weight, 0)")
        nodes = nodes.withColumn("_spent", spent).withColumn("_weight", weight)
        nodes = nodes.select(
            *(F.col(c).alias(f"_{c}_") for c in levels[: i + 1]),
            F.when(F.col("_full"), F.col("_cap")).otherwise(F.coalesce(share, F.lit(0))).cast("long").alias("_new"),
        )
        match = [known[c].eqNullSafe(nodes[f"_{c}_"]) for c in levels[: i + 1]]
        condition = match[0]
        for m in match[1:]:
            condition = condition & m
        known = keep(known.join(nodes, condition).select(*leaves.columns, F.col("_new").alias("_parent")), "budgets")
    return known.withColumnRenamed("_parent", "budget")


def _order(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")).cast("binary"), 256)


def plan(counted: DataFrame, budget_pct: int = BUDGET_PCT, levels=LEVELS, weights=WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:  # noqa: ANN001
    """Per leaf: ``levels, epochs_done, cut``: all documents that often, and once more those ordered up to ``cut``.

    ``counted`` holds ``doc_id, levels, tokens`` and is read three times: give it
    as a written table.
    """
    leaves = counted.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    leaves = keep(leaves.withColumn("_budget", F.expr(f"sum(tokens) over () * {int(budget_pct)} div 100")), "leaves")
    budgets = allot(leaves.select(*levels, "tokens", "_budget"), F.col("_budget"), levels, weights, epochs)
    budgets = budgets.select(
        *(F.col(c).alias(f"leaf_{c}") for c in levels),
        F.expr("coalesce(budget div nullif(tokens, 0), 0)").alias("epochs_done"),
        F.expr("coalesce(budget % nullif(tokens, 0), 0)").alias("rest"),
    )
    condition = F.lit(True)
    for c in levels:
        condition = condition & counted[c].eqNullSafe(F.col(f"leaf_{c}"))
    own = [f"leaf_{c}" for c in levels]
    placed = counted.join(budgets, condition).where("rest > 0").select(
        *own, "rest", "tokens", _order(seed, F.col("epochs_done"), F.col("doc_id")).alias("key")
    )
    placed = keep(placed.withColumn("slice", F.substring("key", 1, SLICE_DIGITS)), "ordered")
    sums = placed.groupBy(*own, "slice", "rest").agg(F.sum("tokens").alias("n"))
    so_far = Window.partitionBy(*own).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    ends = ends.where("before < rest and rest <= before + n").select(*(F.col(c).alias(f"_{c}") for c in own), F.col("slice").alias("_slice"), "before")
    condition = F.col("slice") == F.col("_slice")
    for c in own:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    keys = placed.join(ends, condition).groupBy(*own, "rest", "before", "key").agg(F.sum("tokens").alias("n"))
    inside = Window.partitionBy(*own).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cuts = keys.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).where("start < rest")
    cuts = cuts.groupBy(*own).agg(F.max("key").alias("cut")).select(*(F.col(c).alias(f"_{c}") for c in own), "cut")
    condition = F.lit(True)
    for c in own:
        condition = condition & budgets[c].eqNullSafe(F.col(f"_{c}"))
    return keep(budgets.join(cuts, condition, "left").select(*own, "epochs_done", "cut"), "mixture")


def copies(docs: DataFrame, leaves: DataFrame, doc_id: str, levels: dict[str, Column], seed: int = SEED) -> tuple[DataFrame, str]:
    """``docs`` with the number of copies each gets, and that column's name. No text moves: the leaves' table is small."""
    (name,) = fresh(docs, "copies")
    table_ = leaves.select(*(F.col(c).alias(f"_mix_{c}") for c in leaves.columns))
    condition = F.lit(True)
    for level, value in levels.items():
        condition = condition & value.eqNullSafe(F.col(f"_mix_leaf_{level}"))
    once_more = _order(seed, F.col("_mix_epochs_done"), docs[doc_id]) <= F.col("_mix_cut")
    number = F.col("_mix_epochs_done") + F.when(once_more, 1).otherwise(0)
    return docs.join(table_, condition).select(*(docs[c] for c in docs.columns), number.cast("long").alias(name)), name


def count_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, domain, lang, source, tokens``; tokens are words."""
    return docs.select(
        "doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", F.size(words_of(text_of(F.col("text")))).cast("long").alias("tokens")
    )


def mix(docs: DataFrame, budget_pct: int, epochs: int = 1) -> DataFrame:
    """The chosen documents with their own columns, each as often as its leaf's epochs say."""
    leaves = plan(keep(count_documents(docs), "counted"), budget_pct, epochs=epochs)
    chosen, name = copies(docs, leaves, "doc_id", {"domain": domain_of(docs["source"]), "lang": docs["lang"], "source": docs["source"]})
    chosen = chosen.where(F.col(name) > 0)
    if epochs == 1:
        return chosen.select(*docs.columns)
    return chosen.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(name))).alias(name)).select(*docs.columns)


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = keep(count_documents(table(spark, sf_dir, "documents")), "counted")
    chosen, name = copies(counted, plan(counted), "doc_id", {c: counted[c] for c in LEVELS})
    return chosen.where(F.col(name) > 0).select("doc_id", "domain", "lang", "source", F.col("tokens").alias("n_tokens"), F.col(name).alias("copies"))


def _oracle() -> str:
    steps, levels = [], LEVELS
    for i, level in enumerate(levels):
        own, up = ", ".join(levels[: i + 1]), ", ".join(levels[:i]) or "0"
        listed = " ".join(f"WHEN {level} = '{k}' THEN {w}" for k, w in WEIGHTS.get(level, {}).items())
        weight = f"CASE {listed} ELSE 1 END" if listed else "1"
        source = f"b{i - 1}" if i else "root"
        steps.append(f"""
n{i} AS (SELECT {own}, first(b) AS b, CAST(sum(tokens) * {EPOCHS} AS BIGINT) AS cap, CAST({weight} AS BIGINT) AS w FROM {source} GROUP BY {own}),
f{i} AS (
  SELECT *, cap * sum(w) OVER (PARTITION BY {up} ORDER BY cap / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= w * (b - coalesce(sum(cap) OVER (PARTITION BY {up} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM n{i}),
s{i} AS (
  SELECT {own}, CAST(CASE WHEN filled THEN cap ELSE w * (b - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY {up}), 0))
    // sum(w) FILTER (NOT filled) OVER (PARTITION BY {up}) END AS BIGINT) AS b FROM f{i}),
b{i} AS (SELECT l.domain, l.lang, l.source, l.tokens, s.b FROM leaf l JOIN s{i} s ON {" AND ".join(f"l.{c} IS NOT DISTINCT FROM s.{c}" for c in levels[: i + 1])}),""")
    last = f"b{len(levels) - 1}"
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce('family' || (try_cast(regexp_extract(source, '^src([0-9]{{1,9}})$', 1) AS BIGINT) // 5), 'other') AS domain,
         lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
root AS (SELECT *, CAST(sum(tokens) OVER () * {BUDGET_PCT} // 100 AS BIGINT) AS b FROM leaf),{"".join(steps)}
e AS (SELECT *, coalesce(b // nullif(tokens, 0), 0) AS done, coalesce(b % nullif(tokens, 0), 0) AS rest FROM {last}),
o AS (SELECT d.*, done, rest, sha256('{SEED}:' || done || ':' || doc_id) AS key
      FROM d JOIN e ON d.domain IS NOT DISTINCT FROM e.domain AND d.lang IS NOT DISTINCT FROM e.lang AND d.source IS NOT DISTINCT FROM e.source),
t AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM o)
SELECT doc_id, domain, lang, source, tokens AS n_tokens, CAST(done + CASE WHEN start < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM t WHERE done > 0 OR start < rest
"""


OP2_SQL = _oracle()
