"""What several operators share: columns, batches of texts and hash folds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words.  ``bytes.split`` splits on exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch that are Python objects at a time.
SLICE = 128


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def utf8(column: str = "text") -> Column:
    """The text as bytes; bytes cross to Python without being decoded."""
    return text_or_empty(column).cast("binary")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_names(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns of these names, which the caller adds anew."""
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in names])


def fold(parts: int) -> Column:
    """``crc32`` of the decimal ``doc_id``, modulo ``parts``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable[[dict], Iterable[tuple]]]) -> DataFrame:
    """Apply a row function in Arrow batches.

    ``start`` runs once per task and returns a function from a row (a dict) to
    output rows.  Output goes back in batches of bounded size.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    target = _arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = start()
        rows: list[tuple] = []
        for batch in batches:
            names = batch.schema.names
            for at in range(0, batch.num_rows, SLICE):
                columns = [c.to_pylist() for c in batch.slice(at, SLICE).columns]
                for values in zip(*columns, strict=True):
                    rows.extend(one(dict(zip(names, values, strict=True))))
                    if len(rows) >= 4096:
                        yield _batch(rows, target)
                        rows = []
        finish = getattr(one, "finish", None)
        if finish is not None:
            rows.extend(finish())
        if rows:
            yield _batch(rows, target)

    return df.mapInArrow(run, fields)


def _arrow_schema(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(column, type=field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def bernoulli(df: DataFrame, n_rows: int, at_most: int, seed: int) -> DataFrame:
    """About ``at_most`` of ``n_rows`` rows, picked by a seeded hash of ``doc_id``."""
    if n_rows <= at_most:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) < (at_most << 30) // n_rows)


def labelled_ids(labels: DataFrame, column: str, learn: Column, at_most: int, seed: int = 0) -> DataFrame:
    """``(doc_id, label)`` of about ``at_most`` labelled documents to learn from.

    Null ids and null labels are left out; of several labels the largest counts.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & learn)
    ids = rows.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    return bernoulli(ids, ids.count(), at_most, seed)
