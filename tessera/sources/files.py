"""Sources and sinks S1-S5."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             index_col: int | None = None, header: bool = True, **options) -> DataFrame:
    """Delimited files with a header row.

    Give ``schema`` on large inputs (inference is an extra pass over the
    files). ``index_col=0`` drops a leading unnamed index column written by
    pandas (it is a row label, not data)."""
    r = spark.read.option("header", header)
    for k, v in options.items():
        r = r.option(k, v)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    if index_col is not None:
        df = df.drop(df.columns[index_col])
    return df


MAX_LAYOUTS = 1000


def _layouts(spark: SparkSession, path: str, sep: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of files under ``path`` that share a header line;
    a file's header is its first line that is not blank. The files' names come to the
    driver, which lists them anyway."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value",
                                         F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    heads = (lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file")
             .agg(F.min_by("value", "at").alias("head")))     # the ids grow within a file's first block
    found = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").limit(MAX_LAYOUTS + 1).collect()
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} header lines under {path}")
    out = []
    for row in found:
        names = [n.strip().strip('"') for n in row["head"].lstrip("\ufeff").split(sep)]
        if len(set(names)) < len(names):
            raise ValueError(f"a header names a column twice: {row['head']!r}")
        out.append((names, row["files"]))
    return out


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, by_name: bool = True,
                     sep: str = ",", **options) -> tuple[DataFrame, DataFrame]:
    """S1 with a side table: (rows that fit ``schema``, rows that don't).

    A row doesn't fit if it has more or fewer fields than its file's header
    (``reason`` is ``fields``) or a value that isn't of the column's type
    (``reason`` is the first such column); the side table has (file, line,
    reason), so rows in = rows that fit + rows of the side table, whatever columns are
    read of either. With ``by_name`` the columns are matched by each
    file's own header: their order may differ from file to file, a column
    that a file lacks is missing there, columns not in ``schema`` are left
    out. Without it all files have the columns of ``schema`` in its order.
    Files with the same header are one scan; an empty value is missing."""
    if not isinstance(schema, T.StructType):
        schema = T.StructType.fromDDL(schema)
    want = [f.name for f in schema]
    layouts = _layouts(spark, path, sep) if by_name else [(want, [path])]
    parts = []
    for names, files in layouts:
        # every field is read, so which rows fit doesn't depend on the columns that a caller selects
        text = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("_line", T.StringType())])
        raw = (spark.read.options(**options).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).schema(text).csv(files))
        at = {n: F.col(f"_c{i}") for i, n in enumerate(names)}
        cast = {f.name: at[f.name].try_cast(f.dataType) if f.name in at else F.lit(None).cast(f.dataType) for f in schema}
        wrong = [F.when(at[n].isNotNull() & cast[n].isNull(), F.lit(n)) for n in want if n in at]
        fields = F.to_csv(F.struct(*[F.col(f"_c{i}") for i in range(len(names))]), {"sep": sep})
        parts.append(raw.select(*[cast[n].alias(n) for n in want], F.col("_metadata.file_path").alias("_file"),
                                F.coalesce("_line", fields).alias("_text"),
                                F.coalesce(F.when(F.col("_line").isNotNull(), F.lit("fields")), *wrong).alias("_reason")))
    rows = parts[0] if parts else spark.createDataFrame([], T.StructType([*schema.fields]).add("_file", "string").add("_text", "string").add("_reason", "string"))
    for p in parts[1:]:
        rows = rows.unionAll(p)
    good = rows.where(F.col("_reason").isNull()).select(*want)
    bad = rows.where(F.col("_reason").isNotNull()).select(F.col("_file").alias("file"), F.col("_text").alias("line"), F.col("_reason").alias("reason"))
    return good, bad


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


ROWS_PER_BUCKET = 500_000


def bucket_count(*tables: DataFrame, least: int = 16) -> int:
    """Buckets of tables that are saved by the same key: ``least``, doubled until
    no table has more than ``ROWS_PER_BUCKET`` rows a bucket, so that what a task
    sorts and joins does not follow the size of the tables. Of two such numbers
    one is a multiple of the other, as Spark needs to join differing buckets."""
    most = max(t.count() for t in tables)   # of Parquet files, from their footers
    n = least
    while n * ROWS_PER_BUCKET < most:
        n *= 2
    return n


class Library:
    """A named library of permanent Parquet tables under ``base``
    (a SAS ``libname``): ``table(name)`` reads ``base/name`` (or
    ``base/name.parquet``); ``save`` writes one, optionally partitioned;
    ``save_keyed`` writes one in buckets of a key, so that joins and
    groupings of tables saved with the same key need no exchange."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _entry(self, name: str) -> str:
        """The name of a keyed table in the session's catalog."""
        return f"keyed_{hashlib.sha1(self.path(name).encode()).hexdigest()[:16]}"

    def table(self, name: str) -> DataFrame:
        if self.spark.catalog.tableExists(self._entry(name)):
            return self.spark.table(self._entry(name))
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as e:   # any other fault of a table that is there is the caller's to see
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.read.parquet(self.path(name) + ".parquet")

    def save(self, df: DataFrame, name: str, mode: str = "errorifexists",
             partition_by: Sequence[str] = ()) -> DataFrame:
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))


    def save_keyed(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int, parts: int = 4,
                   mode: str = "errorifexists") -> DataFrame:
        """A table in ``buckets`` buckets of ``keys``, sorted within files. Each
        bucket is written by ``parts`` tasks of its own, dealt by the whole row, so a
        task holds 1 / ``parts`` of a hot key's different rows at most, and rows
        of one bucket only. ``bucket_count`` gives a number of buckets."""
        keys = list(keys)
        bucket = F.pmod(F.hash(*keys), F.lit(buckets))     # as Spark names a row's bucket
        part = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")
        dealt = df.repartitionById(buckets * parts, bucket * parts + part)     # by a hash, some tasks would get several buckets
        dealt.write.mode(mode).option("path", self.path(name)).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(self._entry(name))
        return self.table(name)

    def attach_keyed(self, name: str, schema: T.StructType | str, keys: Sequence[str], buckets: int) -> DataFrame:
        """A keyed table that an earlier session saved, entered in this session's
        catalog: the files stay as they are."""
        if not isinstance(schema, T.StructType):
            schema = T.StructType.fromDDL(schema)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        named = ", ".join(f"`{k}`" for k in keys)
        where = self.path(name).replace("'", "\\'")
        self.spark.sql(f"create table if not exists {self._entry(name)} ({columns}) using parquet clustered by ({named}) "
                       f"sorted by ({named}) into {buckets} buckets location '{where}'")
        return self.table(name)


def from_matrix(spark: SparkSession, matrix, row_name: str, col_name: str, value_name: str,
                row_keys: Sequence | None = None, col_keys: Sequence | None = None) -> DataFrame:
    """A matrix as a long table (row key, column key, value).

    ``matrix`` is either a wide DataFrame (first column = row key, the other
    columns = column keys) -- unpivoted on the executors -- or a small inline
    list of lists with ``row_keys`` / ``col_keys`` (e.g. a 20 x 10 cost table
    typed into a script)."""
    if isinstance(matrix, DataFrame):
        rk = matrix.columns[0]
        vals = [c for c in matrix.columns[1:]]
        return (matrix.unpivot([rk], vals, col_name, value_name).withColumnRenamed(rk, row_name))
    rows = [(r, *vals) for r, vals in zip(row_keys, matrix)]
    cols = [str(c) for c in col_keys]
    wide = spark.createDataFrame(rows, [row_name] + cols)
    return wide.unpivot([row_name], cols, col_name, value_name)


def normalise_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One missing marker: NaN -> NULL in float columns and blank text ->
    NULL in string columns (SAS '.'/blank, pandas NaN, R NA all become NULL)."""
    cols = set(cols or df.columns)
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in cols and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name)
        elif f.name in cols and isinstance(f.dataType, T.StringType):
            c = F.when(F.trim(c) != "", c).alias(f.name)
        exprs.append(c)
    return df.select(*exprs)
