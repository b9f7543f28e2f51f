"""Mixing sources to target weights by hierarchical budgeting (operator 7, native).

Documents are leaves' streams in a tree domain > language > source. Integer
weights share a token budget down the tree; a node can take at most its
tokens times ``max_epochs``. What a node can't take goes to its siblings in
proportion to their weights, and only what all siblings together can't take
goes on to the siblings of their parent. Sharing a parent's budget top-down
over children capped by what they hold does exactly that, level by level.

A leaf's stream is its documents in a seeded order, anew for each epoch; the
leaf's budget is a prefix of the stream: some whole epochs and a prefix of
the next. Orders are by MD5 of seed, epoch and doc_id, so the prefix of the
last epoch is a bound on that key, found in two steps: token sums of 4,096 key
ranges per leaf (pre-aggregated), then the keys of the one range in which the
budget ends. No task ever holds a whole leaf, and documents aren't shuffled:
each meets only its leaf's bound.

Defined cases: null domain, language or source is the node ``?``; a null or
empty text has no tokens (it may be chosen, at no cost); a document whose
first token lies inside the prefix is chosen, and ``tokens_used`` says how far
the prefix reaches into it; rows with equal doc_id in a leaf share a key and
are chosen together; shares are rounded down; texts are counted whole, whatever
their length; input columns named like one of the output are dropped; empty
tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.storage import written
from hourglass.operators.joins import bounded_broadcast

BLANK = r"[\x20\x09-\x0D]+"
NODES = ["_domain", "_lang", "_source"]
SEED = 17

# Production weights: shares of a parent's budget; children not named weigh 1.
DOMAIN_WEIGHTS = {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS = {"src0": 2}


def domain_of(source: Column) -> Column:
    """Domains group sources by their number; none for a source without one."""
    number = F.regexp_extract(source, r"([0-9]{1,6})", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("int"), F.lit(4)).cast("string")))


def weight(node: str, weights: dict[str, int]) -> Column:
    """A node's weight by its name, from a literal table of the configuration."""
    out = F.lit(1)
    for name, w in sorted(weights.items()):
        out = F.when(F.col(node) == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def share(children: DataFrame, parent: list[str]) -> DataFrame:
    """Divides ``budget`` (the parent's, on every row) over the children in
    proportion to ``weight``, none above ``capacity``; adds ``share``.

    With children by capacity per weight, the water level is the largest of
    the levels that would hold if all children before were full."""
    group = W.partitionBy(*parent)
    order = group.orderBy(F.col("capacity") / F.col("weight"), *NODES[:len(parent) + 1])
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    rest = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).cast("decimal(38,0)")
    levels = children.withColumns({"_rest": rest, "_weights": F.sum("weight").over(after).cast("decimal(38,0)")})
    level = F.max(F.struct((F.col("_rest") / F.col("_weights")).cast("double").alias("x"),
                           F.col("_rest").alias("rest"), F.col("_weights").alias("weights"))).over(group)
    levels = levels.withColumn("_level", level)
    poured = F.expr("(weight * _level.rest) div _level.weights")
    return levels.withColumn("share", F.greatest(F.lit(0), F.least("capacity", poured)).cast("long")) \
        .drop("_rest", "_weights", "_level")


def tagged(docs: DataFrame, domain: Column) -> DataFrame:
    """The nodes and token count of each document."""
    node = lambda c: F.coalesce(c, F.lit("?"))
    return docs.withColumns({
        "_domain": node(domain), "_lang": node(F.col("lang")), "_source": node(F.col("source")),
        "_tokens": F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), BLANK), "")).cast("long")})


def key(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def budgets(leaves: DataFrame, budget_percent: int, max_epochs: int, domain_weights: dict[str, int],
            lang_weights: dict[str, int], source_weights: dict[str, int]) -> DataFrame:
    """Each leaf's tokens and budget. ``leaves``: a row per leaf, with tokens."""
    big = "decimal(38,0)"
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    out = None
    for depth, weights in ((1, domain_weights), (2, lang_weights), (3, source_weights)):
        nodes, parent = NODES[:depth], NODES[:depth - 1]
        children = leaves.groupBy(*nodes).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")) \
            .withColumn("weight", weight(nodes[-1], weights))
        if out is None:
            children = children.withColumn("budget", F.lit(total * budget_percent // 100))
        else:
            children = children.join(out.select(*parent, F.col("share").alias("budget")), parent)
        out = share(children.withColumn("capacity", F.col("capacity").cast(big)), parent)
    return out.select(*NODES, "tokens", F.col("share").alias("budget"),
                      F.expr("CASE WHEN tokens > 0 THEN share div tokens ELSE 0 END").alias("full_epochs"),
                      F.expr("CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END").alias("remainder"))


def bounds(slim: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """For each leaf, the key up to which its partial epoch goes (``bound``,
    null: none of it) and how far into that key's document (``into``)."""
    keyed = slim.join(bounded_broadcast(leaves.filter("remainder > 0").select(*NODES, "full_epochs", "remainder")), NODES) \
        .withColumn("_key", key(F.col("full_epochs"), seed))
    ranges = keyed.withColumn("_range", F.substring("_key", 1, 3)).groupBy(*NODES, "_range") \
        .agg(F.sum("_tokens").alias("_sum"), F.first("remainder").alias("remainder"))
    so_far = F.sum("_sum").over(W.partitionBy(*NODES).orderBy("_range"))  # at most 4,096 rows a leaf
    # Ranges without tokens never hold the end: the one that does starts below the remainder and reaches it.
    ends = ranges.withColumn("_before", so_far - F.col("_sum")) \
        .filter("_before < remainder AND _before + _sum >= remainder").select(*NODES, "_range", "_before")
    last = keyed.withColumn("_range", F.substring("_key", 1, 3)).join(bounded_broadcast(ends), [*NODES, "_range"]) \
        .groupBy(*NODES, "_key").agg(F.sum("_tokens").alias("_sum"), F.first("_before").alias("_before"),
                                     F.first("remainder").alias("remainder"))
    start = F.col("_before") + F.sum("_sum").over(W.partitionBy(*NODES).orderBy("_key")) - F.col("_sum")
    return last.withColumn("_start", start).filter("_start < remainder").groupBy(*NODES) \
        .agg(F.max("_key").alias("bound"), F.max_by(F.col("remainder") - F.col("_start"), "_key").alias("into"))


def mix(docs: DataFrame, budget_percent: int = 80, max_epochs: int = 3, domain: Column | None = None,
        domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None,
        source_weights: dict[str, int] | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once for each epoch that takes
    them, with ``_domain``, ``_lang``, ``_source``, ``_tokens``, ``epoch`` and
    ``tokens_used``. ``docs`` needs doc_id, text, lang, source."""
    docs = docs.drop("epoch", "tokens_used", "_tokens", *NODES)
    rows = tagged(docs, domain_of(F.col("source")) if domain is None else domain)
    slim = written(rows.select("doc_id", *NODES, "_tokens"), "mix-tokens")
    leaves = written(budgets(slim.groupBy(*NODES).agg(F.sum("_tokens").alias("tokens")), budget_percent, max_epochs,
                             DOMAIN_WEIGHTS if domain_weights is None else domain_weights,
                             LANG_WEIGHTS if lang_weights is None else lang_weights,
                             SOURCE_WEIGHTS if source_weights is None else source_weights), "mix-leaves")
    plan = written(leaves.join(bounds(slim, leaves, seed), NODES, "left"), "mix-plan")
    return chosen(rows, plan, seed)


def chosen(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Documents meet their leaf's plan, a row per leaf and so broadcast after
    a check of its size."""
    out = rows.join(bounded_broadcast(plan.select(*NODES, "full_epochs", "bound", "into")), NODES) \
        .withColumn("_key", key(F.col("full_epochs"), seed))
    copies = F.col("full_epochs") + F.when(F.col("_key") <= F.col("bound"), 1).otherwise(0)
    out = out.withColumn("_copies", copies.cast("int")).filter("_copies > 0") \
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    used = F.when((F.col("epoch") == F.col("full_epochs")) & (F.col("_key") == F.col("bound")),
                  F.least("_tokens", "into")).otherwise(F.col("_tokens"))
    return out.withColumn("tokens_used", used).drop("full_epochs", "bound", "into", "_key", "_copies")


def query(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "lang", "source")).select(
        "doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"),
        "epoch", F.col("_tokens").alias("n_tokens"), "tokens_used")


def _case(node: str, weights: dict[str, int]) -> str:
    return f"CASE {node} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _level(name: str, parent_cols: list[str], cols: list[str], weights: dict[str, int], parent: str) -> str:
    """One level of the tree: for each child, the level at which it and all
    later ones would stand, from sums over its siblings."""
    on = " AND ".join(f"b.{c} = a.{c}" for c in parent_cols) or "true"
    by, pby = ", ".join(cols), ", ".join(parent_cols)
    return f"""
{name}_c AS (SELECT {by}, sum(capacity)::HUGEINT AS capacity, {_case(cols[-1], weights)}::HUGEINT AS weight
       FROM leaf GROUP BY {by}),
{name}_b AS (SELECT c.*, p.share AS budget FROM {name}_c c JOIN {parent} p {'USING (' + pby + ')' if pby else 'ON true'}),
{name}_l AS (SELECT a.*, a.budget - coalesce((SELECT sum(b.capacity) FROM {name}_b b WHERE {on}
              AND (b.capacity / b.weight, {', '.join('b.' + c for c in cols)}) < (a.capacity / a.weight, {', '.join('a.' + c for c in cols)})), 0) AS rest,
              (SELECT sum(b.weight) FROM {name}_b b WHERE {on}
              AND (b.capacity / b.weight, {', '.join('b.' + c for c in cols)}) >= (a.capacity / a.weight, {', '.join('a.' + c for c in cols)})) AS weights
       FROM {name}_b a),
{name} AS (SELECT a.*, greatest(0, least(capacity, (weight * t.rest::HUGEINT) // t.weights::HUGEINT)) AS share
       FROM {name}_l a JOIN (SELECT {pby + ', ' if pby else ''}arg_max(rest, (rest / weights, rest)) AS rest,
                 arg_max(weights, (rest / weights, rest)) AS weights FROM {name}_l {'GROUP BY ' + pby if pby else ''}) t
       {'USING (' + pby + ')' if pby else 'ON true'})"""


def oracle_sql(budget_percent: int = 80, max_epochs: int = 3, seed: int = SEED) -> str:
    return f"""
WITH doc AS (SELECT doc_id, coalesce('domain' || (CAST(nullif(regexp_extract(source, '([0-9]{{1,6}})', 1), '') AS INT) % 4)::VARCHAR, '?') AS domain,
       coalesce(lang, '?') AS lang, coalesce(source, '?') AS source,
       len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens
       FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::HUGEINT * {max_epochs} AS capacity
       FROM doc GROUP BY ALL),
root AS (SELECT sum(tokens)::HUGEINT * {budget_percent} // 100 AS share FROM leaf),
{_level('d', [], ['domain'], DOMAIN_WEIGHTS, 'root')},
{_level('l', ['domain'], ['domain', 'lang'], LANG_WEIGHTS, 'd')},
{_level('s', ['domain', 'lang'], ['domain', 'lang', 'source'], SOURCE_WEIGHTS, 'l')},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS full_epochs,
       CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS remainder FROM s JOIN leaf USING (domain, lang, source)),
keyed AS (SELECT *, md5('{seed}:' || full_epochs::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'null')) AS k
       FROM doc JOIN plan USING (domain, lang, source)),
stream AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k
       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(n_tokens) OVER (PARTITION BY domain, lang, source, k) AS start
       FROM keyed)
SELECT doc_id, domain, lang, source, unnest(range(full_epochs::INT))::INT AS epoch, n_tokens, n_tokens AS tokens_used FROM stream
UNION ALL
SELECT doc_id, domain, lang, source, full_epochs::INT, n_tokens, least(n_tokens, remainder - start)::BIGINT
FROM stream WHERE start < remainder
"""
