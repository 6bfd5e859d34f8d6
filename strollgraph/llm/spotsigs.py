"""Document fingerprints by SpotSigs.

A spot is a common word (an anchor) that is followed by content words; its signature is a hash of the anchor and the chain of the
next content words.  The set of signatures is the fingerprint: it lives in running prose and passes over what surrounds it.
Sets fall into classes by their length, growing by the factor 1 / ``LEAST``; the Jaccard of two sets is at most the
ratio of their lengths, so sets more than one class apart are not compared at all.

Everything is column expressions.  Neighbours in the order of ids are found from the ids alone, in ranges; texts then move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.session import cut

#: Common words that start a chain (fixed values).
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his in is it its not of on or she that the their they this to was were "
    "which who will with you "
    "au aux avec ce dans de des du elle en est et il la le les leur mais ou par pas pour que qui sa se son sur un une "
    "al como con del el es esta las lo los mas no para pero por se su sus una uno y "
    "am auch auf aus bei das dass dem den der die ein eine einer er es für ich im ist mit nicht sich sie sind und von vor war wie zu zum zur"
).split()
#: Content words of a chain.
CHAIN = 2
#: Ratio of lengths below which two sets count as unlike.
LEAST = 0.05
_MARK = "="


def _spots(text: Column) -> Column:
    """Content words in order; a word after common words is written ``anchor=word`` with the last of them."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    # A common word keeps no space behind it, so splitting again leaves it on the next content word.
    marked = F.array_join(F.transform(
        F.split(plain, " "), lambda w: F.concat(w, F.when(w.isin(ANCHORS), F.lit(_MARK)).otherwise(F.lit(" ")))
    ), "")
    held = F.filter(F.split(marked, " "), lambda w: (w != "") & ~w.endswith(_MARK))
    return F.transform(held, lambda w: F.substring_index(w, _MARK, -2))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct 32-bit signatures of a text.

    Without a spot every content word is one, and without any word the whole text (also a null or empty one).
    """
    text = F.coalesce(text, F.lit(""))
    hashed = lambda *c: F.xxhash64(*c).bitwiseAND(0xFFFFFFFF).cast("bigint")
    wrap = lambda h: F.when(h >= 1 << 31, h - (1 << 32)).otherwise(h).cast("int")

    def of(spots: Column) -> Column:
        # The spots and their content words are bound as variables, so neither is worked out again for every spot.
        contents = F.array(F.transform(spots, lambda w: F.substring_index(w, _MARK, -1)))
        return F.transform(contents, lambda words: F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest(F.size(spots), F.lit(1))), lambda i: F.contains(F.get(spots, i - 1), F.lit(_MARK))),
            lambda i: wrap(hashed(F.get(spots, i - 1), F.slice(words, i + 1, chain - 1))),
        ))[0]

    def either(spots: Column) -> Column:
        return F.transform(F.array(of(spots)), lambda found: F.when(F.size(found) > 0, found).otherwise(
            F.transform(spots, lambda w: wrap(hashed(w)))
        ))[0]

    found = F.transform(F.array(_spots(text)), either)
    return F.transform(found, lambda f: F.sort_array(
        F.when(F.size(f) > 0, F.array_distinct(f)).otherwise(F.array(wrap(hashed(text))))
    ))[0]


def length_class(sigs: Column, least: float = LEAST) -> Column:
    return F.floor(F.log(F.size(sigs).cast("double")) / F.log(F.lit(1 / least))).cast("int")


def likeness(a: Column, b: Column, least: float = LEAST) -> Column:
    """Jaccard of two signature sets; 0 where their lengths alone keep it below ``least``."""
    na, nb = F.size(a), F.size(b)
    near = F.abs(length_class(a, least) - length_class(b, least)) <= 1
    possible = near & (F.least(na, nb) >= F.greatest(na, nb) * least)
    both = F.size(F.array_intersect(a, b))
    return F.when(possible, both / (na + nb - both)).otherwise(0.0)


def as_text(sigs: Column) -> Column:
    return F.lower(F.array_join(F.transform(sigs, lambda s: F.lpad(F.hex(s.cast("bigint").bitwiseAND(0xFFFFFFFF)), 8, "0")), ""))


def next_ids(ids: DataFrame) -> DataFrame:
    """``doc_id, next_id``: for every distinct id the next lower one, and for the lowest the highest.

    Ids are dealt to ranges; only the ends of the ranges, a row for each, are put in one order.
    """
    ranged = cut(
        ids.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
        .repartitionByRange("doc_id").withColumn("_part", F.spark_partition_id())
    )
    ends = ranged.groupBy("_part").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high"))
    before = F.lag("_high").over(Window.orderBy("_low"))
    top = F.max("_high").over(Window.orderBy("_low").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("_part", F.coalesce(before, top).alias("_before"))
    inside = F.lag("doc_id").over(Window.partitionBy("_part").orderBy("doc_id"))
    return ranged.withColumn("_next", inside).join(ends, "_part").select(
        "doc_id", F.coalesce("_next", "_before").alias("next_id")
    )


def edited(text: Column, head: Column) -> Column:
    """The text with its last third (whole code points) replaced by as much of ``head`` as there is."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(head, F.lit(1), third))


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, text, edited_text, signatures, edited_signatures, next_signatures`` for every row of ``docs``.

    The next document is the one with the next lower id, after the lowest the highest.  Rows that share an id share a place
    in that order, where the least (signatures, beginning) stands for them; a row without an id has the highest id's document
    as its next and is no row's next itself.  A null text counts as empty.  A single document is its own next.
    """
    # One shape of the texts, dealt by one key, serves both joins: Spark moves them once and reuses the exchange.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(key.alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    order = next_ids(docs)
    lengths = docs.groupBy("doc_id").agg(F.max(F.length(F.coalesce("text", F.lit("")))).alias("_n"))
    top = order.agg(F.max("doc_id")).first()[0]
    named = lengths.where(F.col("doc_id").isNotNull()).join(order, "doc_id")
    nameless = lengths.where(F.col("doc_id").isNull()).withColumn("next_id", F.lit(top).cast("bigint"))
    # Who needs whose beginning, and how much of it.
    asks = cut(named.unionByName(nameless).select(
        F.col("next_id").cast("string").alias("_key"), key.alias("_for"), F.floor(F.col("_n") / 3).cast("int").alias("_take")
    ))
    heads = (
        rows.join(asks, "_key")
        .select("_for", F.struct(signatures(F.col("text")).alias("next"), F.substring(F.col("text"), F.lit(1), F.col("_take")).alias("head")).alias("_h"))
        .groupBy("_for").agg(F.min("_h").alias("_h")).withColumnRenamed("_for", "_key")
    )
    joined = rows.join(heads, "_key", "left").select(
        F.expr("try_cast(_key AS bigint)").alias("doc_id"), "text", F.col("_h.next").alias("next_signatures"),
        edited(F.col("text"), F.coalesce(F.col("_h.head"), F.lit(""))).alias("edited_text"),
    )
    return joined.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), "text", "edited_text", "next_signatures",
        signatures(F.col("text")).alias("signatures"), signatures(F.col("edited_text")).alias("edited_signatures"),
    )
