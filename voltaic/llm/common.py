"""Helpers shared by the operators of this package: table access, words, Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word after A-Z are lower-cased: digits, letters and every code point beyond ASCII.
#: On UTF-8 bytes; every byte of such a code point is 0x80 or more.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
          "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
          "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
          "array<double>": pa.list_(pa.float64())}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_starts(sizes: Column, chunk: int = 128) -> Column:
    """Where each of several stretches begins that follow one another: sums of the sizes before it.

    Appending copies a list, so lists stay short: the starts of chunks first, then those within."""
    append = lambda s, n: F.concat(s, F.array(F.element_at(s, -1) + n))

    def chunked(sizes: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / chunk).cast("int"))
        chunks = F.transform(numbers, lambda c: F.slice(sizes, c * chunk + 1, F.lit(chunk)))

        def placed(chunks: Column) -> Column:
            totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
            starts = F.aggregate(totals, F.array(F.lit(0)), append)
            inner = lambda c, at: F.aggregate(c, F.array(at), append)
            return F.flatten(F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), lambda c, at: F.slice(inner(c, at), 1, F.size(c))))
        return once(chunks, placed)

    return F.when(F.size(sizes) > 0, once(sizes, chunked)).otherwise(F.expr("cast(array() as array<int>)"))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; bytes.lower() changes A-Z only."""
    return _WORD.findall(text.lower()) if text else []


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between the ASCII white space 0x20 and 0x09-0x0D."""
    return text.split() if text else []


def ddl(spec: dict[str, str]) -> str:
    return ", ".join(f"`{k}` {v}" for k, v in spec.items())


def arrow_schema(spec: dict[str, str]) -> pa.Schema:
    return pa.schema([pa.field(k, _ARROW[v]) for k, v in spec.items()])


def record_batch(spec: dict[str, str], columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[k], type=_ARROW[v]) for k, v in spec.items()], schema=arrow_schema(spec))


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one row at a time.

    What Arrow holds of earlier batches, which are of no more use, is given back first: workers
    outlive their tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    for v in batch.column(column).cast(pa.binary()):
        yield v.as_py()


def map_rows(df: DataFrame, spec: dict[str, str], make: Callable[[], Callable[..., Iterable]],
             keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Map every text to one row: the ``keep`` columns, then what ``make()(bytes)`` returns.

    ``spec`` describes the output, ``keep`` first.  ``make`` runs once per task, so models
    are opened once.  Rows flow in Arrow batches; nothing is held beyond one batch.
    """
    def run(batches):
        f = make()
        names = list(spec)[len(keep):]
        for b in batches:
            cols: dict[str, list] = {k: [] for k in names}
            for t in texts(b, text):
                for k, v in zip(names, f(t), strict=True):
                    cols[k].append(v)
            for k in keep:
                cols[k] = b.column(k).to_pylist()
            yield record_batch(spec, cols)

    return df.select(*[F.col(k).cast(spec[k]).alias(k) for k in keep],
                     F.col(text).cast("string").alias(text)).mapInArrow(run, ddl(spec))
