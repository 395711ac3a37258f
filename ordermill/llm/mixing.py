"""Mixing sources to target weights.

Every row gets a hash-random key. Within a source the keys are cut into equal ranges, about as many
ranges as a range has rows (the square root of the source's rows), so that neither the rows of a range
nor the ranges of a source grow into one large task: a third of ten billion rows gives 58 thousand
ranges of 58 thousand rows. Word counts are summed per range and ranges are summed along the source;
only the rows of the range in which a source's budget ends are sorted and summed one by one. A source
takes its whole epochs and then all rows before its cut, and of the row at the cut the words up to the
exact budget. With the cuts known, a handful of numbers per source, each row decides for itself: texts
are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import WORD, quoted, saved, without

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
OWN = ("size", "source_size", "target", "taken")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) with ``target``: the total shared by weight, no source above ``most`` epochs.

    Sources are weighed in code point order, null last. In order of cap / weight a source is full when
    the level of what is left reaches its cap; the first that is not full gives the level of the rest.
    One row per source; empty sources get 0.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int")).cast("long")
    caps = ranked.withColumns({"_w": weight, "_cap": F.col("source_size") * most})
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = caps.withColumns({
        "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
        "_weights": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0)),
    })
    full = F.col("_left") * F.col("_w") >= F.col("_cap") * F.col("_weights")
    level = F.first(F.when(~F.col("_full"), F.struct("_left", "_weights")), ignorenulls=True).over(whole)
    return (
        left.withColumn("_full", full)
        .withColumn("_level", level)
        .select(
            "source", "source_size",
            F.when(F.col("_full"), F.col("_cap").cast("double"))
            .otherwise(F.col("_w") * F.col("_level._left") / F.col("_level._weights")).alias("target"),
        )
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target and taken (words the mix takes, repeats counted).

    Null texts have no words and are never taken; null sources are one source, the last. Rows that
    repeat are rows of their own; where a source's cut falls among rows of equal id and size, each of them
    gives an equal share. Input columns named like the operator's are replaced. An empty table gives an
    empty table. Reruns agree: the key is the MD5 of the id.
    """
    keep = without(docs, OWN)
    rows = docs.select(
        *[quoted(x).alias(f"_doc{k}") for k, x in enumerate(keep)],
        quoted(source_col).alias("_source"),
        F.coalesce(F.regexp_count(quoted(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        F.md5(F.coalesce(quoted(id_col).cast("string"), F.lit(""))).alias("_key"),
    )
    ranges = saved(docs.groupBy(quoted(source_col).alias("_s")).agg(F.ceil(F.sqrt(F.count("*"))).alias("_ranges")), "mix-ranges")
    share = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / 2**32
    placed = rows.join(ranges, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_range", F.floor(share * F.col("_ranges")))
    sums = saved(placed.groupBy("_source", "_range").agg(F.sum("_size").alias("_words")), "mix-sums")
    goal = targets(sums.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size")), weights, most)
    budget = F.round("target").cast("long")
    plan = saved(
        goal.withColumn("epochs", F.floor(budget / F.greatest("source_size", F.lit(1)))).withColumn("rest", budget - F.col("epochs") * F.col("source_size")),
        "mix-plan",
    )
    # The range of each source, and in it the row, where what is left of the budget ends.
    along = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        sums.withColumn("_start", F.coalesce(F.sum("_words").over(along), F.lit(0)))
        .join(plan, F.col("_source").eqNullSafe(F.col("source")))
        .where("_start <= rest and rest < _start + _words")
        .select(F.col("_source").alias("_s2"), F.col("_range").alias("_r2"), (F.col("rest") - F.col("_start")).alias("_rest"))
    )
    ends = saved(ends, "mix-ends")
    near = placed.join(ends, F.col("_source").eqNullSafe(F.col("_s2")) & (F.col("_range") == F.col("_r2"))).groupBy("_source", "_rest", "_key", "_size").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy("_source").orderBy("_key", "_size").rowsBetween(Window.unboundedPreceding, -1)
    before = near.withColumn("_at", F.coalesce(F.sum(F.col("_size") * F.col("_n")).over(inside), F.lit(0)))
    cuts = before.where("_at <= _rest and _rest < _at + _size * _n").select(
        F.col("_source").alias("_s3"), F.col("_key").alias("_cut_key"), F.col("_size").alias("_cut_size"), F.floor((F.col("_rest") - F.col("_at")) / F.col("_n")).alias("_part")
    )
    plan = saved(plan.join(cuts, F.col("source").eqNullSafe(F.col("_s3")), "left").drop("_s3", "rest"), "mix-cuts")
    part = (
        F.when((F.col("_key") < F.col("_cut_key")) | ((F.col("_key") == F.col("_cut_key")) & (F.col("_size") < F.col("_cut_size"))), F.col("_size"))
        .when((F.col("_key") == F.col("_cut_key")) & (F.col("_size") == F.col("_cut_size")), F.col("_part"))
        .otherwise(0)
    )
    return rows.join(plan, F.col("_source").eqNullSafe(F.col("source"))).select(
        *[F.col(f"_doc{k}").alias(x) for k, x in enumerate(keep)],
        F.col("_size").alias("size"), "source_size", "target", (F.col("epochs") * F.col("_size") + part).alias("taken"),
    )


def mixed_documents(mixed: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The mix as documents: a row per repeat taken; of the row at a source's cut, the words up to the cut.

    Rows of which nothing is taken go, and so do rows without words. ``n_chars`` follows a cut text.
    """
    keep = without(mixed, OWN)
    copies = F.ceil(F.col("taken") / F.col("size"))
    part = F.col("taken") - (F.col("_copy") - 1) * F.col("size")
    text = quoted(text_col)
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    pieces = F.split(text, r"[\x20\x09-\x0D]+", (F.col("_part") + 1 + lead).cast("int"))
    cut = F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(F.element_at(pieces, -1))), F.lit(" \t\n\x0b\f\r"))
    out = (
        mixed.where("taken > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("_part", part)
        .withColumn("_text", F.when(F.col("_part") < F.col("size"), cut).otherwise(text))
    )
    swap = {text_col: F.col("_text"), chars_col: F.length("_text").cast("long")}
    return out.select(*[swap.get(x, quoted(x)).alias(x) for x in keep])


def op9(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM r),
f AS (
  SELECT *, ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER b, 0))::BIGINT AS rest,
         ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0))::BIGINT AS weights
  FROM w WINDOW b AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, rest * w >= cap * weights AS is_full FROM f),
l AS (SELECT rest, weights FROM g WHERE NOT is_full ORDER BY cap / w, rk LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE (w * l.rest) / l.weights END AS target
  FROM g LEFT JOIN l ON true),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, budget // greatest(source_size, 1) AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - pos)))::BIGINT AS taken
FROM e
"""
