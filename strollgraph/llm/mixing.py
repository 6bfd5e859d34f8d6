"""Mixing sources to target weights.

Every document gets a hash-random key.  Within its source the keys define the order in which the mix
takes documents; prefix sums of word counts over that order say where the source's budget ends.  The order is
never built as a whole: sums per key range (two hexadecimal digits a level) locate the range that holds the cut, and
only the few rows of the last range are sorted.  A hot source is therefore just more partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.llm.text import row_key, whole_row, word_count
from strollgraph.plans.prepare import dense_index
from strollgraph.session import cut

WEIGHTS = (5, 2, 1)
#: Rows that one source may leave in the last key range, on average.
RANGE_ROWS = 2000


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, have the weights in turn.  ``share`` times all words are dealt by
    weight; no target exceeds ``most`` times its source, and what is cut off is dealt again by weight among the others
    until none is above.  Only two sums a round reach the driver.
    """
    numbered = dense_index(
        totals.withColumn("_null", F.col("source").isNull().cast("int")), ["_null", "source"], "_rank"
    )
    cycle = F.array(*[F.lit(w) for w in weights])
    sized = cut(
        numbered.select(
            "source", "source_size",
            F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * most).alias("ceiling"),
        )
    )
    first = sized.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    budget = share * (first["n"] or 0)
    level, before = (budget / first["w"] if first["w"] else 0.0), None
    while level != before:
        over = F.lit(level) * F.col("weight") > F.col("ceiling")
        row = sized.agg(
            F.sum(F.when(over, F.col("ceiling")).otherwise(0)).alias("full"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("w"),
        ).first()
        before, level = level, (max(level, (budget - row["full"]) / row["w"]) if row["w"] else level)
    target = F.least(F.col("ceiling").cast("double"), F.lit(level) * F.col("weight"))
    return sized.select("source", "source_size", target.alias("target"))


def source_cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, source_size, target, epochs, cut_key, cut_words``: whole passes over a source, then the key at which
    its budget ends and the words still wanted from the documents with that key."""
    goals = cut(
        targets.withColumn("_want", F.floor("target").cast("bigint"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("_want div source_size")).otherwise(F.lit(0)))
        .withColumn("_rest", F.col("_want") - F.col("epochs") * F.col("source_size"))
    )
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    state = goals.where("_rest > 0").select(
        F.col("source").alias("_s"), F.lit("").alias("_prefix"), F.col("_rest").alias("_left")
    )
    n, digits = sized.count(), 0
    while n > RANGE_ROWS and digits < 30:
        digits, n = digits + 2, n / 256
        sums = (
            sized.join(state, same("source", "_s") & F.col("key").startswith(F.col("_prefix")))
            .groupBy("_s", "_left", F.substring("key", 1, digits).alias("_range"))
            .agg(F.sum("size").alias("_n"))
        )
        order = Window.partitionBy("_s").orderBy("_range")
        upto = F.sum("_n").over(order)
        hit = sums.withColumn("_upto", upto).where("_upto >= _left and _upto - _n < _left")
        state = cut(hit.select("_s", F.col("_range").alias("_prefix"), (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left")))
    last = (
        sized.join(state, same("source", "_s") & F.col("key").startswith(F.col("_prefix")))
        .groupBy("_s", "_left", "key").agg(F.sum("size").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(Window.partitionBy("_s").orderBy("key")))
        .where("_upto >= _left and _upto - _n < _left")
        .select("_s", F.col("key").alias("cut_key"), (F.col("_left") - F.col("_upto") + F.col("_n")).alias("cut_words"))
    )
    return cut(
        goals.join(last, same("source", "_s"), "left")
        .select("source", "source_size", "target", "epochs", "cut_key", "cut_words")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs`` (doc_id, text, source).

    ``taken`` counts the words the mix takes from the row: its size for every whole pass over the source, and once more if
    its key lies before the cut.  The document at the cut gives only the words that are left, so each source
    gives the whole part of its target exactly.  A null or empty text has size 0 and gives nothing; a null source
    is a source of its own; rows equal in id and text share a key, and the cut deals what is left among them in turn; an
    empty table gives an empty result.
    """
    sized = cut(docs.select("doc_id", "source", word_count("text").alias("size"), row_key("doc_id", "text").alias("key")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = source_cuts(sized, source_targets(totals, weights, share, most))
    c = cuts.withColumnRenamed("source", "_s")
    return _taken(sized.join(c, F.col("source").eqNullSafe(F.col("_s")))).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def _taken(joined: DataFrame) -> DataFrame:
    """Rows at the cut are few: the one document with that key, or its repeats."""
    at_cut = joined.where("key = cut_key").withColumn(
        "_before",
        F.coalesce(
            F.sum("size").over(Window.partitionBy("source", "key").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    )
    whole = joined.where("cut_key is null or key <> cut_key").withColumn(
        "taken", F.col("epochs") * F.col("size") + F.when(F.col("key") < F.col("cut_key"), F.col("size")).otherwise(0)
    )
    part = at_cut.withColumn(
        "taken",
        F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least("size", F.col("cut_words") - F.col("_before"))),
    ).drop("_before")
    return whole.unionByName(part)


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """The mix as rows with the columns of ``docs``: one row for each pass that takes the document.

    Texts stay whole, so the document at a source's cut is taken whole.  Documents without words have no part in a budget
    and stay once.
    """
    keyed = docs.select(
        whole_row(docs).alias("_row"), F.col("source").alias("source"), word_count("text").alias("size"),
        row_key("doc_id", "text").alias("key"),
    )
    sized = cut(keyed.select("source", "size", "key"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = source_cuts(sized, source_targets(totals, weights, share, most)).withColumnRenamed("source", "_s")
    passes = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.col("epochs") + F.when(F.col("key") <= F.col("cut_key"), 1).otherwise(0)
    ).cast("int")
    taken = keyed.join(cuts, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_passes", passes)
    return taken.where("_passes > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_passes")))).select("_row.*")


#: The query op10 in DuckDB's SQL.
MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, chr(0)) || '|' || coalesce(text, chr(0))) AS key
  FROM documents
), s AS (
  SELECT source, source_size, (ARRAY[5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
    2 * source_size AS ceiling
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), lv(level) AS (
  SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE / sum(w)::DOUBLE FROM s
  UNION
  SELECT greatest(lv.level, (1.5::DOUBLE * sum(source_size)::DOUBLE - sum(CASE WHEN lv.level * w > ceiling THEN ceiling ELSE 0 END)::DOUBLE)
      / nullif(sum(CASE WHEN lv.level * w > ceiling THEN 0 ELSE w END), 0)::DOUBLE)
  FROM lv, s GROUP BY lv.level
), t AS (
  SELECT source, source_size, least(ceiling::DOUBLE, (SELECT max(level) FROM lv) * w) AS target FROM s
), g AS (
  SELECT *, floor(target)::BIGINT AS want, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t
), o AS (
  SELECT d.*, g.source_size, g.target, g.epochs, g.want - g.epochs * g.source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM o
"""
