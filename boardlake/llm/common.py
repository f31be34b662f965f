"""Helpers that the training-data operators share: table access, written stages and filters of keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.scratch import shared_folder as shared_dir

#: ASCII white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
SPACES = "\t\n\x0b\x0c\r"
#: Most words of 64 bits of a key filter: what is broadcast has at most so many rows of two longs, whatever the input.
FILTER_WORDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back.

    This cuts lineage in a way that survives the loss of executors, and gives Spark the true size of the table, so it
    broadcasts a small one by its own threshold and shuffles a large one.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    _WRITTEN.append(out)
    return out


#: The tables of this session that are not deleted yet.
_WRITTEN: list[DataFrame] = []


def discard(*tables: DataFrame) -> None:
    """Deletes tables of `written` that no later plan reads."""
    for df in tables:
        _WRITTEN[:] = [t for t in _WRITTEN if t is not df]
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._table_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def written_tables() -> list[DataFrame]:
    """The tables of `written` that are still there."""
    return list(_WRITTEN)


def discard_others(*keep: DataFrame) -> None:
    """Deletes all tables that operators wrote in this session but these, once the results that read them are written."""
    discard(*[t for t in _WRITTEN if not any(t is k for k in keep)])


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The runs of anything but ASCII white space, in order; null has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(flat, " "), "")


def row_key(*columns: str) -> list[Column]:
    """Columns that tell rows apart where ids may be null or repeat: the id, whether it is null, and a hash of the text."""
    key, text = columns
    return [F.coalesce(F.col(key), F.lit(-1)).alias("_k"), F.xxhash64(F.col(key).isNull(), F.coalesce(F.col(text), F.lit(""))).alias("_h")]


class KeyFilter:
    """A bitmap of bounded size over the keys of a table, which tells most other rows apart before they are shuffled.

    Each key sets two bits of one word. A row whose bits are not set surely lacks a partner; the others must still be
    joined exactly. With more keys than bits the filter lets more rows through, and no result changes.
    """

    def __init__(self, keys: DataFrame, columns: list[str], most: int = FILTER_WORDS):
        self.columns, self.words, n = columns, 1 << 10, keys.count()
        while self.words < most and self.words * 4 < n:
            self.words *= 2
        bits = keys.select(self._slot().alias("_slot"), self._mask().alias("_m")).groupBy("_slot").agg(F.bit_or("_m").alias("_bits"))
        self.bits = written(bits, "key-filter")

    def _hash(self) -> Column:
        return F.xxhash64(F.lit(17), *self.columns)

    def _slot(self) -> Column:
        return F.shiftrightunsigned(self._hash(), 12).bitwiseAND(F.lit(self.words - 1))

    def _mask(self) -> Column:
        bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
        return bit(self._hash()).bitwiseOR(bit(F.shiftrightunsigned(self._hash(), 6)))

    def flagged(self, rows: DataFrame) -> DataFrame:
        """rows with _maybe: false where no key equals the row's."""
        out = rows.withColumns({"_slot": self._slot(), "_m": self._mask()}).join(F.broadcast(self.bits), "_slot", "left")
        return out.withColumn("_maybe", F.coalesce(F.col("_bits").bitwiseAND(F.col("_m")) == F.col("_m"), F.lit(False))).drop("_slot", "_m", "_bits")

    def candidates(self, rows: DataFrame) -> DataFrame:
        return self.flagged(rows).filter("_maybe").drop("_maybe")
