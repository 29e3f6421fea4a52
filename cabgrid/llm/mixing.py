"""Mixing sources to target weights, in DataFrame operations only.

Iterative proportional fitting. Token counts are added up per cell of source,
language and topic; each round scales the cells to the target share of every
source, then of every language, then of every topic. The factor of a cell is
its fitted over its observed tokens. A document is kept with a probability
proportional to its cell's factor, drawn from a hash of its id, so the kept
tokens meet all three marginals in expectation and a rerun keeps the same rows.

The largest factor would set the scale for all, so one rare document with a
large one could cost the whole corpus. Hence at least ``least_kept`` of the
tokens are kept: where the scale that keeps the largest factor at probability
1 keeps less, it is raised until the rest is filled up, and cells that would
exceed 1 are kept whole. Those fall short of their target, as nothing is
repeated; ``reached`` gives the share of every value beside its target.

Targets are tempered shares: a margin with observed share ``p`` aims at
``p ** temper``, normalised. 1 leaves a margin as it is, 0 makes it even.

Only the cell table, one row per combination that occurs, is iterated on; it is
cut from its lineage with ``checkpoint`` every few rounds.

Cases: a null text is an empty one with 0 tokens; null source or language is a
value of its own; a null doc_id draws as the text "null". Rows that repeat are
drawn alike. Cells without any token keep the factor of 1 before scaling. An
empty table gives no rows. Further columns are kept by ``mix`` and ignored by
``mixing_rows``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.llm.common import stored

MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Targets:
    """Tempering of each margin, rounds of fitting, and the seed of the draw."""

    source: float = 0.7
    lang: float = 0.7
    topic: float = 1.0
    rounds: int = 12
    seed: str = "mix"
    #: Share of all tokens that is kept in any case; 0 meets the margins whatever that costs.
    least_kept: float = 0.0
    #: Rounds between two checkpoints of the cell table.
    cut_every: int = 4


#: What the query and the pipeline mix with.
PRODUCTION = Targets(least_kept=0.5)


def n_tokens(text: Column) -> Column:
    """Words between blanks, tabs and line ends."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    """Topic by surface: texts of marks, of capitals, or of prose (short or long).

    Stands in for a topic column, which the tables don't have. Any column can be
    given to ``mix`` instead.
    """
    marks = F.length(text) - F.length(F.translate(text, "*#$%&!?;:/=<>{}[]()_+", ""))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return (
        F.when(marks * 20 > F.length(text), "marks")
        .when(capitals * 3 > F.length(text), "capitals")
        .when(F.length(text) < 1000, "short prose")
        .otherwise("long prose")
    )


def draw(doc_id: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f"/{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def measured(docs: DataFrame, topic: Column | None, *keep: str) -> DataFrame:
    """The three margins and the token count of each row, beside the columns named."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *keep,
        F.coalesce(F.col("source"), F.lit("(none)")).alias("__source"),
        F.coalesce(F.col("lang"), F.lit("(none)")).alias("__lang"),
        (topic_of(text) if topic is None else topic).alias("__topic"),
        n_tokens(text).alias("__tokens"),
    )


def fitted_cells(rows: DataFrame, targets: Targets) -> DataFrame:
    """Cell table of ``rows`` with the probability that a document of the cell is kept."""
    session.ensure_checkpoint_dir(rows.sparkSession)
    cells = rows.groupBy(*(f"__{m}" for m in MARGINS)).agg(F.sum("__tokens").cast("double").alias("seen"))
    for m in MARGINS:
        share = F.sum("seen").over(Window.partitionBy(f"__{m}")) / F.sum("seen").over(Window.partitionBy())
        cells = cells.withColumn(f"aim_{m}", F.pow(share, F.lit(float(getattr(targets, m)))))
    for m in MARGINS:
        # Each value counts once in the sum, however many cells it has.
        once = F.row_number().over(Window.partitionBy(f"__{m}").orderBy(*(f"__{x}" for x in MARGINS))) == 1
        cells = cells.withColumn("once", F.when(once, F.col(f"aim_{m}")).otherwise(0.0))
        cells = cells.withColumn(f"aim_{m}", F.col(f"aim_{m}") / F.sum("once").over(Window.partitionBy())).drop("once")
    cells = stored(cells.withColumn("fit", F.col("seen") / F.sum("seen").over(Window.partitionBy())), "mix-cells")
    for turn in range(targets.rounds):
        for m in MARGINS:
            total = F.sum("fit").over(Window.partitionBy(f"__{m}"))
            cells = cells.withColumn("fit", F.when(total > 0, F.col("fit") * F.col(f"aim_{m}") / total).otherwise(0.0))
        if turn % targets.cut_every == targets.cut_every - 1:
            cells = cells.checkpoint()
    factor = F.when(F.col("seen") > 0, F.col("fit") / F.col("seen"))
    cells = stored(cells.withColumn("factor", factor), "mix-factors")
    chance = F.least(F.col("factor") * F.lit(scale_of(cells, targets.least_kept)), F.lit(1.0))
    keys = [f"__{m}" for m in MARGINS]
    return cells.select(*keys, F.coalesce(chance, F.lit(1.0)).alias("__probability"), "seen", *(f"aim_{m}" for m in MARGINS))


def scale_of(cells: DataFrame, least_kept: float) -> float:
    """What factors are multiplied with to become probabilities; those beyond 1 are then 1.

    ``seen * factor`` is ``fit``, so with the cells beyond 1 kept whole the others
    have to fill the rest of the budget. That may push more cells beyond 1; the set only grows, and
    each round takes one aggregate of the cell table.
    """
    top, seen = cells.agg(F.max("factor"), F.sum("seen")).first()
    if not top:
        return 1.0
    scale, whole = 1.0 / top, -1
    while True:
        beyond = F.col("factor") * F.lit(scale) >= 1.0
        now, held, fit = cells.agg(
            F.count_if(beyond), F.sum(F.when(beyond, F.col("seen"))), F.sum(F.when(~beyond, F.col("fit")))
        ).first()
        if now == whole or not fit:
            return scale
        scale, whole = max(scale, (least_kept * seen - (held or 0.0)) / fit), now


def reached(docs: DataFrame, targets: Targets = PRODUCTION, topic: Column | None = None) -> DataFrame:
    """Per margin and value: the share of tokens seen, aimed at, and kept in expectation."""
    cells = stored(fitted_cells(measured(docs, topic), targets), "mix-fit")
    total = cells.agg(F.sum("seen"), F.sum(F.col("seen") * F.col("__probability"))).first()
    shares = [
        cells.groupBy(F.lit(m).alias("margin"), F.col(f"__{m}").alias("value")).agg(
            (F.sum("seen") / F.lit(total[0])).alias("seen"),
            F.max(f"aim_{m}").alias("target"),
            (F.sum(F.col("seen") * F.col("__probability")) / F.lit(total[1])).alias("kept"),
        )
        for m in MARGINS
    ]
    return shares[0].unionByName(shares[1]).unionByName(shares[2])


def mixing_rows(docs: DataFrame, targets: Targets = PRODUCTION, topic: Column | None = None) -> DataFrame:
    """One row per document: its margins, tokens, probability, and whether it is kept."""
    rows = stored(measured(docs, topic, "doc_id"), "mix-rows")
    cells = stored(fitted_cells(rows, targets).select(*(f"__{m}" for m in MARGINS), "__probability"), "mix-fit")
    return rows.join(cells, [f"__{m}" for m in MARGINS]).select(
        "doc_id",
        *(F.col(f"__{m}").alias(m) for m in MARGINS),
        F.col("__tokens").alias("n_tokens"),
        F.round("__probability", 6).alias("probability"),
        (draw(F.col("doc_id"), targets.seed) < F.col("__probability")).alias("kept"),
    )


def mix(docs: DataFrame, targets: Targets = PRODUCTION, topic: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; those travel in one struct, whatever they are called."""
    keys = [f"__{m}" for m in MARGINS]
    cells = stored(fitted_cells(measured(docs, topic), targets).select(*keys, "__probability"), "mix-fit")
    own = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("own")
    rows = measured(docs.select("*", own) if "own" not in docs.columns else docs.withColumn("own", own), topic, "own")
    kept = rows.join(cells, keys).filter(draw(F.col("own.doc_id"), targets.seed) < F.col("__probability"))
    return kept.select("own.*")


def mixing_sql(targets: Targets = PRODUCTION) -> str:
    """The rows of ``mixing_rows`` over ``documents``, as DuckDB SQL."""
    cells = ", ".join(MARGINS)
    steps = [
        """rows AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  CASE WHEN (length(t) - length(translate(t, '*#$%&!?;:/=<>{}[]()_+', ''))) * 20 > length(t) THEN 'marks'
       WHEN (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) * 3 > length(t) THEN 'capitals'
       WHEN length(t) < 1000 THEN 'short prose' ELSE 'long prose' END AS topic,
  len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        f"seen AS (SELECT {cells}, sum(n_tokens)::DOUBLE AS seen FROM rows GROUP BY ALL)",
    ]
    for m in MARGINS:
        steps.append(
            f"aim_{m} AS (SELECT {m}, share / sum(share) OVER () AS aim_{m} FROM (SELECT {m}, "
            f"pow(sum(seen) / (SELECT sum(seen) FROM seen), {getattr(targets, m)}) AS share FROM seen GROUP BY {m}))"
        )
    joined = " ".join(f"JOIN aim_{m} USING ({m})" for m in MARGINS)
    steps.append(f"fit_0 AS MATERIALIZED (SELECT seen.*, aim_source, aim_lang, aim_topic, seen / sum(seen) OVER () AS fit FROM seen {joined})")
    at = 0
    for _ in range(targets.rounds):
        for m in MARGINS:
            total = f"sum(fit) OVER (PARTITION BY {m})"
            steps.append(
                f"fit_{at + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {total} > 0 THEN fit * aim_{m} / {total} ELSE 0.0 END AS fit) FROM fit_{at})"
            )
            at += 1
    steps.append(f"factor AS (SELECT {cells}, seen, CASE WHEN seen > 0 THEN fit / seen END AS factor FROM fit_{at})")
    # Cells by falling factor; with the first ones kept whole, the others fill up the budget.
    steps.append(
        f"""filled AS (SELECT *, ({targets.least_kept} * total - coalesce(sum(seen) OVER before, 0))
  / nullif(sum(seen * factor) OVER (ORDER BY factor DESC, {cells} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS scale
  FROM factor, (SELECT sum(seen) AS total FROM factor) WHERE factor IS NOT NULL
  WINDOW before AS (ORDER BY factor DESC, {cells} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
    )
    steps.append(
        "scaled AS (SELECT coalesce(greatest(1 / max(factor), max(scale) FILTER (scale * factor <= 1)), 1 / max(factor), 1) AS scale FROM filled)"
    )
    steps.append(f"chance AS (SELECT {cells}, coalesce(least(factor * scale, 1.0), 1.0) AS probability FROM factor, scaled)")
    draw_sql = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/{targets.seed}'), 1, 13))::BIGINT / {float(1 << 52)!r}"
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, {cells}, n_tokens, round(probability, 6) AS probability, "
        f"{draw_sql} < probability AS kept FROM rows JOIN chance USING ({cells})"
    )
