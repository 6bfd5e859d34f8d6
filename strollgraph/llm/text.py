"""Words, hash keys and label folds shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column | str) -> Column:
    """Number of words; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def words(text: Column | str) -> Column:
    """The words in order; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; 0 for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def row_key(*names: str) -> Column:
    """Hash-random hexadecimal key of a row; equal rows have equal keys and nulls count as a value."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("\u0000")) for n in names]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no name clashes with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


#: Rows of an Arrow batch: whole texts are long, and a Python worker holds a batch and its result at once.
BATCH_ROWS = 1000


def arrow_rows(docs: DataFrame) -> DataFrame:
    """``docs``, after bounding the session's Arrow batches by ``BATCH_ROWS``."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs
