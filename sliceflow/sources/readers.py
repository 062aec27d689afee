"""Dataset readers (S1, S2, S7) and the dataset catalog (S3).

CSV is read the way the reference's pandas reader reads it, but split across
tasks instead of downloaded whole by every task:

* ``pandas_nulls``: the text values pandas treats as missing (``NA``,
  ``N/A``, ``null``, ``NaN``, empty, ...) become null; Spark alone only maps
  the empty string.
* no timestamp inference: ``2024-01`` stays text (Spark's ``inferSchema``
  would make it a timestamp).  Types are either given or inferred by one
  distributed aggregate: a column is ``bigint`` if every value reads as an
  integer and none is missing (pandas makes an integer column with gaps
  float64), ``double`` if every present value reads as a number, ``boolean``
  if every value is a spelling of true or false and none is missing, else
  ``string``.  Numbers are what pandas takes for numbers: ``1d`` is text.
* fields may hold doubled quotes and, with ``multi_line`` (the default), line
  feeds in quotes.  A file is read in many splits either way: records are cut
  by a prefix scan over its lines (``csv_records``).  ``multi_line=False`` is Spark's
  own reader, for files that hold no such fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FILE_FORMATS, PANDAS_NA_VALUES
from .csv_records import read_csv_text


_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|[iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])\s*$"
_BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")


def _as(c: Column, kind: str) -> Column:
    """A text value as a type, null where pandas would not read it as one."""
    if kind == "bigint":
        return F.when(c.rlike(_INTEGER), F.trim(c).try_cast("bigint"))
    if kind == "double":
        return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))
    if kind == "boolean":
        return F.when(c.isin(list(_BOOLEANS)), F.lower(c) == "true")
    return c


def _null_sentinels(c: Column) -> Column:
    return F.when(c.isin(list(PANDAS_NA_VALUES)), F.lit(None)).otherwise(c)


def infer_pandas_types(df: DataFrame) -> dict[str, str]:
    """One aggregate pass: the narrowest type that pandas would give each column."""
    kinds = ("bigint", "double", "boolean")
    aggs = [F.count(F.lit(1))]
    for c in df.columns:
        v = F.col(f"`{c}`")
        aggs += [F.count(v), *[F.count(_as(v, k)) for k in kinds]]
    rows, *found = df.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)]).first()
    out = {}
    for at, c in enumerate(df.columns):
        n, i, d, b = found[4 * at: 4 * at + 4]
        whole = n == rows
        out[c] = ("bigint" if n and i == n and whole else "double" if n and d == n
                  else "boolean" if n and b == n and whole else "string")
        if n == 0:
            out[c] = "double"  # an all-missing column is float64 in pandas
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             pandas_nulls: bool = True, infer: bool = True, header: bool = True,
             multi_line: bool = True, position: str | None = None) -> DataFrame:
    """CSV with a header, pandas missing-value rules, no date inference.
    ``position`` (with ``multi_line``) names a column that numbers the rows in
    file order."""
    if multi_line:
        raw = read_csv_text(spark, path, header, position)
    elif position is not None:
        raise ValueError("position needs multi_line")
    else:
        raw = (spark.read.option("header", header).option("inferSchema", False)
               .option("quote", '"').option("escape", '"').csv(path))
    at = [F.col(f"`{position}`")] if position is not None else []
    names = [c for c in raw.columns if c != position]
    if pandas_nulls:
        raw = raw.select(*[_null_sentinels(F.col(f"`{c}`")).alias(c) for c in names], *at)
    if schema is not None:
        st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return raw.select(*[_as(F.col(f"`{f.name}`"), f.dataType.simpleString()).try_cast(f.dataType).alias(f.name)
                            for f in st.fields], *at)
    if not infer:
        return raw
    types = infer_pandas_types(raw.select(*[F.col(f"`{c}`") for c in names]))
    return raw.select(*[_as(F.col(f"`{c}`"), t).alias(c) for c, t in types.items()], *at)


def read_dataset(spark: SparkSession, path: str, file_format: str,
                 schema: T.StructType | str | None = None, **csv_opts) -> DataFrame:
    """Dispatch on the declared file format.

    ``json`` is one JSON document per file (an array of records or one
    record); ``jsonl`` is one record per line.
    """
    fmt = file_format.lower()
    if fmt not in FILE_FORMATS:
        raise ValueError(f"unknown file format {file_format!r}; expected one of {FILE_FORMATS}")
    if fmt == "csv":
        return read_csv(spark, path, schema, **csv_opts)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "parquet":
        return r.parquet(path)
    if fmt == "json":
        return r.option("multiLine", True).json(path)
    return r.json(path)


def dataset_catalog(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """S3: one row per file under ``root``: path, name, format, size, time.

    Only file metadata is selected from the ``binaryFile`` source, so file
    contents are never read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", True).load(root)
             .select("path", "length", "modificationTime"))
    base = F.regexp_extract("path", r"([^/]+)$", 1)
    fmt = F.lower(F.regexp_extract(base, r"\.([A-Za-z0-9]+)$", 1))
    # object key layout <workspace>/<dataset>/<name>.<format>: the two parents
    parent = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    grand = F.regexp_extract("path", r"([^/]+)/[^/]+/[^/]+$", 1)
    return files.select(
        F.col("path").alias("storage_path"),
        F.when(grand != "", grand).alias("workspace_id"),
        F.when(parent != "", parent).alias("dataset_id"),
        F.regexp_replace(base, r"\.[A-Za-z0-9]+$", "").alias("name"),
        F.when(fmt.isin(list(FILE_FORMATS)), fmt).alias("file_format"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        F.when(fmt.isin(list(FILE_FORMATS)), F.lit("READY")).otherwise(F.lit("FAILED"))
        .alias("state"))


def catalog_rows(spark: SparkSession, catalog: list[tuple[str, str, str]]) -> DataFrame:
    """Rows of each dataset (name, path, format): (name, n_rows).  One branch
    for each dataset, counted in one job."""
    counts = [read_dataset(spark, path, fmt).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"))
              for name, path, fmt in catalog]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def read_history(spark: SparkSession, path: str, table: str | None = None,
                 fmt: str = "parquet", jdbc: dict | None = None) -> DataFrame:
    """A platform table, from files or from a database over JDBC (give
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` in
    ``jdbc`` so the read is split across tasks).  With ``table`` the known
    schema is applied (no inference) and columns come back in its order."""
    from ..schemas import platform_schema

    schema = platform_schema(table) if table else None
    if jdbc:
        df = spark.read.format("jdbc").options(**jdbc).load()
    else:
        r = spark.read.format(fmt)
        if schema is not None and fmt != "parquet":
            r = r.schema(schema)
        df = r.load(path)
    if schema is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def split_valid(df: DataFrame, table: str, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Enum and id validity of a platform table: (valid rows, invalid rows
    with an ``error``).  An unknown enum value or an id that is not a
    canonical UUID goes to quarantine instead of failing the job."""
    from ..functions.exprs import is_uuid
    from ..schemas import ENUM_COLUMNS

    err = F.when(~is_uuid(id_col), F.lit(f"invalid {id_col}"))
    for col, allowed in ENUM_COLUMNS.get(table, {}).items():
        err = err.when(~F.coalesce(F.col(col).isin(list(allowed)), F.lit(False)),
                       F.lit(f"invalid {col}"))
    t = df.withColumn("error", err)
    return t.where(F.col("error").isNull()).drop("error"), t.where(F.col("error").isNotNull())
