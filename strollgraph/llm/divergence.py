"""How far the sources of a language lie apart, by chunk factorization.

Texts are cut at white space into chunks, which are counted for every document; a term never crosses white space.  Each distinct chunk of the
corpus is cut into terms once, beside the counts of the chunk, and the counts go on to its terms: documents by language, occurrences by language
and source.

A task counts lots of whole documents.  For each language and chunk a lot leaves one packed row: the sources' occurrences, and the numbers of the
chunk's documents if they are fewer than a term needs.  Several chunks of one document can hold the same term, so documents are told apart by these
numbers; a lot with enough documents for a chunk decides the term by itself.

Probabilities are whole numbers (``SCALE`` for certainty), so all sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.llm.text import arrow_rows
from strollgraph.session import cut

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents of its language that a term needs.
LEAST_DOCS = 10
SCALE = 1_000_000_000
#: Terms listed for a source.
RANKS = 10
#: Chunks by document, distinct chunks, and bytes of those over ``LONG`` that a task counts before it hands them on.
HELD_PAIRS, HELD_CHUNKS, HELD_BYTES, LONG = 4_000_000, 800_000, 32 << 20, 64


class _Lot:
    """Chunks of the documents read so far, as numbers."""

    def __init__(self, number: int):
        self.number = number
        self.chunk: dict[bytes, int] = {}
        self.found: list[np.ndarray] = []  # chunks of each document
        self.times: list[np.ndarray] = []
        self.groups: list[int] = []
        self.size = self.bytes = 0

    def add(self, text: str, group: int) -> None:
        number, chunk = self.chunk.setdefault, self.chunk
        words = text.encode().split()
        found, times = np.unique(np.array([number(w, len(chunk)) for w in words], dtype=np.int32), return_counts=True)
        self.found.append(found)
        self.times.append(times.astype(np.int32))
        self.groups.append(group)
        self.size += len(found)
        if words and len(text) > LONG and max(map(len, words)) > LONG:
            self.bytes += sum(len(w) for w in words if len(w) > LONG)

    def rows(self, lang_of: dict[int, int], least: int) -> Iterator[pa.RecordBatch]:
        """``chunk, lang, packed``; packed holds as 32-bit numbers the lot (two), how many documents follow (-1: enough), they, then groups and occurrences."""
        if not self.chunk:
            return
        doc = np.repeat(np.arange(len(self.found), dtype=np.int32), [len(t) for t in self.found])
        chunk, times = np.concatenate(self.found), np.concatenate(self.times)
        self.found, self.times = [], []
        own = np.array(self.groups, dtype=np.int32)
        known = np.unique(own)
        group = own[doc]
        lang = np.array([lang_of[g] for g in known.tolist()], dtype=np.int32)[np.searchsorted(known, own)][doc]
        # By language and chunk, in the order of documents.
        order = np.argsort(lang.astype(np.int64) * len(self.chunk) + chunk, kind="stable")
        doc, chunk, group, lang, times = (x[order] for x in (doc, chunk, group, lang, times))
        del order
        first = np.flatnonzero((np.diff(lang, prepend=-1) != 0) | (np.diff(chunk, prepend=-1) != 0))
        bounds = np.append(first, len(doc))
        names = pa.array(list(self.chunk), pa.binary()).cast(pa.string())
        for low in range(0, len(first), 20_000):  # so many rows at once: the sorted numbers are all that is held as a whole
            high = min(low + 20_000, len(first))
            part = slice(bounds[low], bounds[high])
            packed = self._packed(np.diff(bounds[low : high + 1]), doc[part], group[part], times[part], least)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(chunk[first[low:high]])), pa.array(lang[first[low:high]], pa.int32()), packed], names=["chunk", "lang", "packed"]
            )

    def _packed(self, docs: np.ndarray, doc: np.ndarray, group: np.ndarray, times: np.ndarray, least: int) -> pa.Array:
        """Of rows of ``docs`` documents each, whose numbers, groups and occurrences follow each other."""
        first = np.cumsum(docs) - docs
        listed = np.where(docs < least, docs, 0)
        row_of = np.repeat(np.arange(len(first)), docs)
        inner = np.lexsort((group, row_of))
        row, own = row_of[inner], group[inner]
        start = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(own, prepend=-1) != 0))
        counted, counts_row, counts_group = np.add.reduceat(times[inner], start), row[start], own[start]
        counts = np.bincount(counts_row, minlength=len(first))
        lengths = 3 + listed + 2 * counts
        at = np.cumsum(lengths) - lengths
        out = np.zeros(lengths.sum(), dtype="<i4")
        out[at], out[at + 1] = self.number >> 31, self.number & 0x7FFFFFFF
        out[at + 2] = np.where(docs < least, docs, -1)
        few = docs[row_of] < least
        out[(at[row_of] + 3 + np.arange(len(doc)) - first[row_of])[few]] = doc[few]
        place = (at + 3 + listed)[counts_row] + 2 * (np.arange(len(counts_row)) - (np.cumsum(counts) - counts)[counts_row])
        out[place], out[place + 1] = counts_group, counted
        offsets = (4 * np.append(at, len(out))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())])


def _chunk_batches(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot = _Lot(TaskContext.get().partitionId() << 24)
        lang_of: dict[int, int] = {}
        for batch in batches:
            for text, group, lang in zip(*(batch.column(c).to_pylist() for c in ("_text", "_group", "_lang"))):
                lang_of[group] = lang
                lot.add(text, group)
                if lot.size > HELD_PAIRS or len(lot.chunk) > HELD_CHUNKS or lot.bytes > HELD_BYTES:
                    yield from lot.rows(lang_of, least)
                    lot, lang_of = _Lot(lot.number + 1), {}
        yield from lot.rows(lang_of, least)

    return run


def groups_of(docs: DataFrame) -> DataFrame:
    """``lang, source, _lang, _group``: every language and source with a number, and one for the language."""
    found = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    # As many rows as there are sources: a table of names, ranked in one task.
    return cut(found.select(
        "lang", "source", F.dense_rank().over(Window.orderBy("lang")).alias("_lang"), F.row_number().over(Window.orderBy("lang", "source")).alias("_group")
    ))


def chunk_counts(docs: DataFrame, groups: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Packed counts ``chunk, lang, packed``; every document is in one lot alone."""
    clean = arrow_rows(docs).select(F.coalesce("text", F.lit("")).alias("_text"), *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")])
    return clean.join(groups, ["lang", "source"]).select("_text", "_group", "_lang").mapInArrow(
        _chunk_batches(least), "chunk string, lang int, packed binary"
    )


def term_parts(partial: DataFrame) -> DataFrame:
    """``term, parts``: of every term how often its chunks hold it, with their packed counts."""
    chunks = partial.groupBy("chunk").agg(F.collect_list(F.struct("lang", "packed")).alias("rows"))  # one row for each lot and language
    found = F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), F.lit(0))
    times = F.transform(F.array(found), lambda ts: F.transform(
        F.array_distinct(ts), lambda t: F.struct(t.alias("term"), F.size(F.filter(ts, lambda x: x == t)).alias("times"))
    ))[0]
    terms = chunks.select("rows", F.explode(times).alias("_t")).select("_t.term", "_t.times", "rows")
    return terms.groupBy("term").agg(F.collect_list(F.struct("times", "rows")).alias("parts"))


def _spread(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions ``flat[i], flat[i] + 1, ...``, ``counts[i]`` of each."""
    return np.repeat(flat - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _term_batches(least: int):
    """``lang, term, groups, counts`` of the terms in enough documents of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("parts")
            chunks = parts.flatten()
            rows = chunks.field("rows")
            packed = rows.flatten()
            if not len(packed):
                continue
            sizes = lambda lists: np.diff(lists.offsets.to_numpy())
            chunk_of = np.repeat(np.arange(len(chunks)), sizes(rows))
            term_of = np.repeat(np.arange(len(batch)), sizes(parts))[chunk_of]
            times = chunks.field("times").to_numpy(zero_copy_only=False).astype(np.int64)[chunk_of]
            lang = packed.field("lang").to_numpy(zero_copy_only=False).astype(np.int64)
            blob = packed.field("packed")
            numbers = np.frombuffer(b"".join(blob.to_pylist()), "<i4").astype(np.int64)
            lengths = pa.compute.binary_length(blob).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            at = np.cumsum(lengths) - lengths
            keys, key = np.unique(term_of * (int(lang.max()) + 1) + lang, return_inverse=True)
            docs = numbers[at + 2]
            listed = np.maximum(docs, 0)
            seen = np.column_stack([
                np.repeat(key, listed), np.repeat(numbers[at], listed), np.repeat(numbers[at + 1], listed), numbers[_spread(at + 3, listed)]
            ])
            # Of equal rows the first counts.
            seen = seen[np.lexsort(seen.T[::-1])]
            fresh = np.any(np.diff(seen, axis=0, prepend=-1), axis=1) if len(seen) else np.zeros(0, dtype=bool)
            enough = np.bincount(seen[fresh, 0], minlength=len(keys)) >= least
            enough[key[docs < 0]] = True
            pairs = (lengths - 3 - listed) // 2
            place = np.repeat(at + 3 + listed, pairs) + 2 * (np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs))
            owner, group, n = np.repeat(key, pairs), numbers[place], numbers[place + 1] * np.repeat(times, pairs)
            some = enough[owner]
            owner, group, n = owner[some], group[some], n[some]
            if not len(owner):
                continue
            order = np.lexsort((group, owner))
            owner, group = owner[order], group[order]
            first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0))
            total, owner, group = np.add.reduceat(n[order], first), owner[first], group[first]
            of, count = np.unique(owner, return_counts=True)
            offsets = pa.array(np.append(0, np.cumsum(count)), pa.int32())
            base = int(lang.max()) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[of] % base, pa.int32()), batch.column("term").take(pa.array(keys[of] // base)),
                 pa.ListArray.from_arrays(offsets, pa.array(group, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(total))],
                names=["_lang", "term", "groups", "counts"],
            )

    return run


def kept_counts(docs: DataFrame, groups: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``_lang, term, groups, counts``: the terms in at least ``least`` documents of their language, with their occurrences by group."""
    parts = term_parts(chunk_counts(docs, groups, least))
    return cut(parts.mapInArrow(_term_batches(least), "_lang int, term string, groups array<int>, counts array<bigint>"))


def _probability(n: str, total: str, terms: str) -> F.Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)) in whole numbers of any size."""
    wide = lambda e: f"cast({e} as decimal(28, 0))"
    return F.expr(f"1L + ({wide(n)} + 2) * {SCALE} div ({wide(total)} + 2 * {wide(terms)})")


def divergence(docs: DataFrame, least: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for the sources of every language in ``docs`` (text, lang, source).

    Part ``pair`` compares a source with each other source of its language: the sum of floor((p - q)^2 / (p + q)) over the kept terms.  Part
    ``term`` lists up to ``ranks`` terms that a source uses more than its language.  Null texts, languages and sources count as empty ones; a
    source without terms is compared all the same; repeated rows are documents of their own; ties rank by name; an empty table gives an empty result.
    """
    groups = groups_of(docs)
    kept = kept_counts(docs, groups, least)
    counts = kept.select("_lang", "term", F.explode(F.arrays_zip("groups", "counts")).alias("_g")).select(
        "_lang", "term", F.col("_g.groups").alias("_group"), F.col("_g.counts").alias("n")
    )
    sizes = counts.groupBy("_group").agg(F.sum("n").alias("total"))
    vocabulary = kept.groupBy("_lang").agg(F.count("*").alias("terms"))
    # A term without occurrences in a source has the same probability as any other such term of it.
    known = cut(
        groups.join(sizes, "_group", "left").join(vocabulary, "_lang", "left")
        .select("_lang", "_group", "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
        .withColumn("absent", F.when(F.col("terms") > 0, _probability("0", "total", "terms")))
    )
    totals = known.groupBy("_lang").agg(F.sum("total").alias("l_total"), F.max("terms").alias("l_terms"))
    spoken = kept.join(totals, "_lang").select("term", F.explode(F.arrays_zip("groups", "counts")).alias("_g"), _probability(
        "aggregate(counts, 0L, (x, y) -> x + y)", "l_total", "l_terms").alias("q"))
    present = cut(
        spoken.select("term", "q", F.col("_g.groups").alias("_group"), F.col("_g.counts").alias("n")).join(known, "_group")
        .select("_lang", "_group", "term", "q", "absent", _probability("n", "total", "terms").alias("p"))
    )
    f = lambda p, q: f"({p} - {q}) * ({p} - {q}) div ({p} + {q})"
    side = lambda df, mark: df.select("_lang", *[F.col(c).alias(f"{mark}{c}") for c in df.columns if c != "_lang"])
    sources = known.select("_lang", "_group", "terms", "absent")
    pairs = side(sources, "a").join(side(sources, "b"), "_lang").where("a_group < b_group")
    # Terms that both have: the value, less what each side counts for it on its own below.
    each = present.groupBy("_lang", "term").agg(F.sort_array(F.collect_list(F.struct("_group", "p", "absent"))).alias("_m"))  # the sources of a language
    both = (
        each.select("_m", F.posexplode("_m").alias("_at", "a")).select("a", F.explode(F.expr("slice(_m, _at + 2, size(_m))")).alias("b"))
        .groupBy(F.col("a._group").alias("a_group"), F.col("b._group").alias("b_group"))
        .agg(F.sum(F.expr(f"{f('a.p', 'b.p')} - {f('a.p', 'b.absent')} - {f('a.absent', 'b.p')} + {f('a.absent', 'b.absent')}")).alias("value"))
    )
    # Terms of one side, by how often they occur there: equal counts have equal probabilities.
    levels = cut(present.groupBy("_group", "p").agg(F.count("*").alias("times")))
    single = lambda mine, other: (
        pairs.join(levels.withColumnRenamed("_group", f"{mine}_group"), f"{mine}_group")
        .groupBy("a_group", "b_group")
        .agg(F.sum(F.expr(f"times * ({f('p', f'{other}absent')} - {f('aabsent', 'babsent')})")).alias("value"))
    )
    none = pairs.select("a_group", "b_group", F.coalesce(F.expr(f"aterms * ({f('aabsent', 'babsent')})"), F.lit(0)).alias("value"))
    values = cut(
        both.unionByName(single("a", "b")).unionByName(single("b", "a")).unionByName(none)
        .groupBy("a_group", "b_group").agg(F.sum("value").alias("value"))
    )
    names = known.select("_group", "lang", "source")
    other = names.select(F.col("_group").alias("_other"), F.col("source").alias("item"))
    pair_rows = (
        values.select(F.col("a_group").alias("_group"), F.col("b_group").alias("_other"), "value")
        .unionByName(values.select(F.col("b_group").alias("_group"), F.col("a_group").alias("_other"), "value")).join(other, "_other")
    )
    term_rows = present.where("p > q").select("_group", F.col("term").alias("item"), F.expr(f("p", "q")).alias("value"))
    order = Window.partitionBy("_group").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.select("_group", "item", "value", F.row_number().over(order).alias("rank"))
    rows = ranked(pair_rows).withColumn("part", F.lit("pair")).unionByName(ranked(term_rows).where(F.col("rank") <= ranks).withColumn("part", F.lit("term")))
    return rows.join(names, "_group").select("lang", "source", "part", "item", "value", "rank")


def divergence_sql(least: int = LEAST_DOCS, ranks: int = RANKS) -> str:
    """The same in SQL, from the terms of every document."""
    p = lambda n, total: f"CAST(1 + (CAST({SCALE} AS HUGEINT) * ({n} + 2)) // ({total} + 2 * terms) AS BIGINT)"
    f = "CAST((CAST(p AS HUGEINT) - q) * (CAST(p AS HUGEINT) - q) // (CAST(p AS HUGEINT) + q) AS BIGINT)"
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS MATERIALIZED (
    SELECT id, lang, source, term, count(*) AS n FROM (
        SELECT id, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM d
    ) GROUP BY ALL
), kept AS MATERIALIZED (
    SELECT lang, term FROM t GROUP BY lang, term HAVING count(*) >= {least}
), v AS (
    SELECT lang, count(*) AS terms FROM kept GROUP BY lang
), c AS (
    SELECT lang, source, term, sum(n) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
    SELECT lang, source, coalesce(total, 0) AS total, coalesce(terms, 0) AS terms
    FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)
), s AS MATERIALIZED (
    SELECT g.lang, g.source, term, coalesce(n, 0) AS n, {p("coalesce(n, 0)", "total")} AS p
    FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
), l AS (
    SELECT lang, term, {p("sum(n)", "any_value(total)")} AS q
    FROM c JOIN (SELECT lang, sum(total) AS total, max(terms) AS terms FROM g GROUP BY lang) USING (lang) GROUP BY lang, term, terms
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, x.other, sum({f}) AS value
        FROM (SELECT a.lang, a.source, b.source AS other, a.p, b.p AS q FROM s AS a JOIN s AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source) AS x
        GROUP BY ALL
    ) AS m ON m.lang = a.lang AND m.source = a.source AND m.other = b.source
), terms AS (
    SELECT s.lang, source, term AS item, {f} AS value FROM s JOIN l USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {ranks}
"""
