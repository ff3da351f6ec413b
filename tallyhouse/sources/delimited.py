"""Typed CSV loading, in batches and as a stream: one header line, columns bound by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The two spellings of a missing value in quoted retail files.
NULL_TOKENS = ("NULL", "null")


def read_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *,
               delimiter: str = ",", quote: str = "", null_tokens: Sequence[str] = (),
               name_pattern: str | None = None, multi_line: bool = False) -> DataFrame:
    """Load CSV files into ``schema``; a malformed record stops the load, whatever columns are used.

    Header names are ignored: the first file column fills the first schema
    column. ``quote`` turns on optional field quoting, with a doubled quote
    for one inside; ``multi_line`` lets quoted fields hold line ends. A field
    that is empty or one of ``null_tokens`` is NULL.
    """
    options = _options(delimiter, quote, name_pattern, multi_line)
    return _checked(spark.read.options(**options).schema(_as_text(schema)).csv(path), schema, null_tokens)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, *, delimiter: str = ",",
                 quote: str = "", null_tokens: Sequence[str] = (), name_pattern: str | None = None,
                 multi_line: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """The files that arrive under ``path``, under the same contract as :func:`read_table`."""
    options = _options(delimiter, quote, name_pattern, multi_line)
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    return _checked(spark.readStream.options(**options).schema(_as_text(schema)).csv(path), schema, null_tokens)


def _options(delimiter: str, quote: str, name_pattern: str | None, multi_line: bool) -> dict[str, str]:
    """Column pruning is off, so that a record with too few or too many fields is always noticed."""
    options = {"header": "true", "sep": delimiter, "quote": quote, "mode": "FAILFAST",
               "columnPruning": "false", "multiLine": str(multi_line).lower()}
    if quote:
        options["escape"] = quote
    if name_pattern:
        options["pathGlobFilter"] = name_pattern
    return options


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def _checked(raw: DataFrame, schema: T.StructType, null_tokens: Sequence[str]) -> DataFrame:
    """Typed fields. One filter over all of them raises for a field that has no value of its type.

    The filter names every typed field, so no later selection can prune the check away.
    """
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    given = {f.name: _given(f.name, null_tokens) for f in schema.fields}
    if typed:
        problem = F.coalesce(*[
            F.when(given[f.name].isNotNull() & given[f.name].try_cast(f.dataType).isNull(),
                   F.concat(F.lit(f"bad value in column {f.name}: "), given[f.name])) for f in typed])
        raw = raw.filter(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))
    return raw.select(*[given[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _given(name: str, null_tokens: Sequence[str]) -> Column:
    return F.when(~F.col(name).isin(*null_tokens), F.col(name)) if null_tokens else F.col(name)
