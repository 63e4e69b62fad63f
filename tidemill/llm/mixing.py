"""Sampling documents so that token totals meet target weights: iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.frames import text_or_empty
from tidemill.session import cut

#: A word: no ASCII white space.
WORD = r"[^\x09-\x0D\x20]+"
#: Topics by the first pattern that the text holds; "other" if none does.
TOPICS = {"legal": r"(?i)licen[cs]e|copyright|warranty", "contact": r"[A-Za-z0-9._-]@[A-Za-z0-9-]+\.|https?://"}
#: Rounds of scaling that are planned together, and the most there are: margins that contradict each other never settle.
ROUNDS_AT_ONCE, ROUNDS = 3, 24
#: Scaling ends once every margin is as near to its target, in parts of it.
TOLERANCE = 1e-9
#: Share of all tokens that is expected to stay, however small a cell is.
KEPT_TOKENS = 0.5


def topic_of(text: Column, topics: Mapping[str, str] = TOPICS) -> Column:
    found = F.lit("other")
    for name, pattern in reversed(list(topics.items())):
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def even_targets(cells: DataFrame, margin: str, power: float = 0.8) -> DataFrame:
    """Target shares ``value, share`` of a margin in proportion to its tokens to a power: below 1 lifts the small ones."""
    totals = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").cast("double").alias("t"))
    weights = totals.select("value", F.when(F.col("t") > 0, F.pow("t", F.lit(power))).otherwise(0.0).alias("w"))
    whole = weights.agg(F.sum("w").alias("all"))  # one row
    return weights.crossJoin(F.broadcast(whole)).select("value", (F.col("w") / F.col("all")).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells (margins, ``tokens``) with ``weight`` and ``residual``: the tokens scaled until each margin has its target
    share, and how far the worst margin is still off, in parts of its target.

    Each round scales the cells to every margin in turn, until all are within ``TOLERANCE`` or after ``rounds``. A
    margin's value without a target keeps its total. Cells are combinations of margin values, not documents; their table
    is cut every few rounds, so plans stay short.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("_total"))  # one row
    current = cells.withColumn("weight", F.col("tokens").cast("double"))
    for margin, target in targets.items():
        goal = target.crossJoin(F.broadcast(total)).select(
            F.col("value").alias("_value"), (F.col("share") * F.col("_total")).alias(f"_goal_{margin}")
        )
        current = current.join(goal, F.col(margin).eqNullSafe(F.col("_value")), "left").drop("_value")
    current, residual = cut(current), float("inf")
    for done in range(1, rounds + 1):
        for margin in targets:
            sums, goal = F.sum("weight").over(Window.partitionBy(margin)), F.col(f"_goal_{margin}")
            current = current.withColumn(
                "weight", F.when((sums > 0) & goal.isNotNull(), F.col("weight") * goal / sums).otherwise(F.col("weight"))
            )
        if done % ROUNDS_AT_ONCE == 0 or done == rounds:
            current = cut(current)
            residual = _residual(current, list(targets))
            if residual < TOLERANCE:
                break
    return current.select(*cells.columns, "weight", F.lit(residual).alias("residual"))


def _residual(cells: DataFrame, margins: Sequence[str]) -> float:
    """The largest distance of a margin's sum from its target, in parts of the target; values without tokens don't count."""
    off = []
    for margin in margins:
        sums, goal = F.sum("weight").over(Window.partitionBy(margin)), F.col(f"_goal_{margin}")
        off.append(F.when((sums > 0) & (goal > 0), F.abs(sums - goal) / goal))
    worst = cells.select(F.greatest(*off, F.lit(0.0)).alias("off")).agg(F.max("off")).first()[0]
    return worst or 0.0


def chance(key: Column, salt: str) -> Column:
    """A number in [0, 1) that the key alone decides."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), key)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def budgeted(weighted: DataFrame, keep: float) -> DataFrame:
    """Cells with ``_chance``, by which a share ``keep`` of all tokens is expected to stay, however small a cell is.

    Chances are ``ratio`` times one scale, at most 1: cells whose supply is too short keep all, and what they lack goes
    to the others by weight. The window goes over cells, not documents.
    """
    whole = weighted.agg((F.sum("tokens") * F.lit(keep)).alias("_budget"), F.sum(F.when(F.col("tokens") > 0, F.col("weight"))).alias("_all"))  # one row
    shortest = Window.orderBy(F.col("ratio").desc_nulls_last(), "source", "lang", "topic").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(shortest), F.lit(0))
    scale = F.try_divide(F.col("_budget") - before("tokens"), F.col("_all") - before("weight"))
    scaled = cut(weighted.crossJoin(F.broadcast(whole)).withColumn("_scale", scale))
    # The scale at the first cell that doesn't keep all is the largest of such cells.
    settled = scaled.where(F.col("_scale") * F.col("ratio") < 1).agg(F.max("_scale").alias("_settled"))
    drawn = F.when(F.col("weight") > 0, F.coalesce(F.least(F.lit(1.0), F.col("_settled") * F.col("ratio")), F.lit(1.0))).otherwise(0.0)
    return scaled.crossJoin(F.broadcast(settled)).withColumn("_chance", F.when(F.col("ratio").isNull(), 1.0).otherwise(drawn))


def mixed(
    docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, rounds: int = ROUNDS, salt: str = "mix",
    topics: Mapping[str, str] = TOPICS, keep: float | None = None,
) -> DataFrame:
    """All columns of ``docs`` (but those added) with _topic, _tokens, _weight, _chance, _draw and _kept.

    Tokens are words of whole texts. The token table of source, language and topic is raked to ``targets`` (margin name
    to ``value, share``; :func:`even_targets` if None), and a document is kept if the draw of its doc_id is below its
    cell's chance. With ``keep``, chances are such that this share of all tokens is expected to stay
    (:func:`budgeted`). Without it weights are divided by the largest weight per token: all cells meet their weights in
    proportion, but the cell in shortest supply decides how much stays.

    Null source, lang and topics are values of their own. Null and empty texts have no tokens and topic "other"; a cell
    without tokens keeps its documents. Rows of equal doc_id share a draw; a null doc_id draws as "null".
    """
    added = ["_source", "_lang", "_topic", "_tokens", "_weight", "_chance", "_residual", "_draw", "_kept"]
    names = [c for c in docs.columns if c not in added]
    column = lambda c: F.col(f"`{c}`") if c in docs.columns else F.lit(None).cast("string")
    text = text_or_empty()
    marked = docs.select(
        *[F.col(f"`{c}`") for c in names],
        column("source").cast("string").alias("_source"), column("lang").cast("string").alias("_lang"),
        topic_of(text, topics).alias("_topic"), F.expr(f"regexp_count(coalesce(text, ''), r'{WORD}')").cast("bigint").alias("_tokens"),
    )
    cells = cut(
        marked.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"))
        .agg(F.sum("_tokens").alias("tokens"))
    )
    chosen = targets or {m: even_targets(cells, m) for m in ("source", "lang", "topic")}
    weighted = rake(cells, chosen, rounds).withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    if keep is None:
        most = weighted.agg(F.max("ratio").alias("_most"))
        weighted = weighted.crossJoin(F.broadcast(most)).withColumn("_chance", F.coalesce(F.col("ratio") / F.col("_most"), F.lit(1.0)))
    else:
        weighted = budgeted(weighted, keep)
    rates = weighted.select(
        F.col("source").alias("_s"), F.col("lang").alias("_l"), F.col("topic").alias("_t"), F.col("weight").alias("_weight"), "_chance",
        F.col("residual").alias("_residual"),
    )
    draw = chance(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), salt)
    same = F.col("_source").eqNullSafe(F.col("_s")) & F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_topic").eqNullSafe(F.col("_t"))
    return (
        marked.join(rates, same).drop("_s", "_l", "_t")
        .withColumn("_draw", draw).withColumn("_kept", F.col("_draw") < F.col("_chance"))
    )


def mix_sql(rounds: int = ROUNDS, salt: str = "mix", topics: Mapping[str, str] = TOPICS, power: float = 0.8, keep: float = KEPT_TOKENS) -> str:
    """DuckDB: the same result over ``documents``, as ``doc_id, topic, tokens, weight, chance, kept, settled``, from
    the same round."""
    case = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in topics.items())
    parts = [
        f"marked AS (SELECT doc_id, source, lang, CASE {case} ELSE 'other' END AS topic, "
        f"CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS tokens FROM documents)",
        "c0 AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens, CAST(sum(tokens) AS DOUBLE) AS weight "
        "FROM marked GROUP BY ALL)",
    ]
    for m in ("source", "lang", "topic"):
        parts.append(
            f"g_{m} AS (SELECT value, pow(t, {power}) / sum(pow(t, {power})) OVER () * (SELECT sum(tokens) FROM c0) AS goal "
            f"FROM (SELECT {m} AS value, sum(tokens) AS t FROM c0 GROUP BY 1))"
        )
    last, ends = "c0", []
    for i in range(rounds):
        for m in ("source", "lang", "topic"):
            name = f"c{i}_{m}"
            parts.append(
                f"{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, CASE WHEN sum(weight) OVER (PARTITION BY {m}) > 0 "
                f"THEN weight * goal / sum(weight) OVER (PARTITION BY {m}) ELSE weight END AS weight "
                f"FROM {last} JOIN g_{m} ON {m} IS NOT DISTINCT FROM value)"
            )
            last = name
        if (i + 1) % ROUNDS_AT_ONCE == 0 or i == rounds - 1:
            ends.append((i, last))
            off = " UNION ALL ".join(
                f"SELECT abs(sum(weight) - any_value(goal)) / any_value(goal) AS off FROM {last} JOIN g_{m} ON {m} IS NOT DISTINCT FROM value "
                f"GROUP BY {m} HAVING sum(weight) > 0 AND any_value(goal) > 0" for m in ("source", "lang", "topic")
            )
            parts.append(f"off_{i} AS MATERIALIZED (SELECT coalesce(max(off), 0.0) AS off FROM ({off}))")
    # The first block of rounds after which all margins are near enough, or the last one.
    blocks = " UNION ALL ".join(f"SELECT {i} AS nr, off FROM off_{i}" for i, _ in ends)
    parts.append(f"ended AS MATERIALIZED (SELECT coalesce(min(nr) FILTER (WHERE off < {TOLERANCE}), {ends[-1][0]}) AS nr FROM ({blocks}))")
    parts.append("raked AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {name}.* FROM {name}, ended WHERE nr = {i}" for i, name in ends) + ")")
    last = "raked"
    parts.append(
        f"cells AS (SELECT *, CASE WHEN tokens > 0 THEN weight / tokens END AS ratio FROM {last}), "
        f"whole AS (SELECT sum(tokens) * {keep} AS budget, sum(CASE WHEN tokens > 0 THEN weight END) AS weights FROM cells), "
        "scaled AS (SELECT cells.*, (budget - coalesce(sum(tokens) OVER shortest, 0)) / nullif(weights - coalesce(sum(weight) OVER shortest, 0), 0) AS scale "
        "FROM cells, whole WINDOW shortest AS (ORDER BY ratio DESC NULLS LAST, source NULLS FIRST, lang NULLS FIRST, topic "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
        "settled AS (SELECT max(scale) AS s FROM scaled WHERE scale * ratio < 1), "
        "rates AS (SELECT source, lang, topic, weight, CASE WHEN ratio IS NULL THEN 1.0 WHEN weight > 0 THEN coalesce(least(1.0, s * ratio), 1.0) ELSE 0.0 END "
        "AS chance FROM scaled, settled)"
    )
    draw = f"CAST(('0x' || substr(md5('{salt}' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12)) AS BIGINT) / 281474976710656.0"
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, topic, m.tokens, round(weight, 3) AS weight, round(chance, 6) AS chance, {draw} < chance AS kept, true AS settled "
        "FROM marked m JOIN rates r ON m.source IS NOT DISTINCT FROM r.source AND m.lang IS NOT DISTINCT FROM r.lang AND m.topic = r.topic"
        .replace("doc_id, topic,", "doc_id, m.topic,")
    )
