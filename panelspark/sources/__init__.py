"""Tables and files: explicit schemas, tolerant scans, deterministic sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A driver table; with column names, only those are scanned."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, width: int | None = None, refuse: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, refused lines) of CSV, gzip by extension; headerless files take names by position. Lines that don't fit the schema are refused; with ``width`` and ``refuse``, a line with another number of fields fails the job.

    Rows come from one pruned scan; refused lines, a column ``line``, from a scan of the text that runs only if they are asked for. A line equal to the schema's names is a header.
    """
    rows = spark.read.csv(path, schema=f"{schema}, _bad string", header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True)
    names = [c for c in rows.columns if c != "_bad"]
    parsed = F.from_csv("value", F.lit(f"{schema}, _bad string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    lines = spark.read.text(path).select(F.col("value")).where(F.col("value") != ",".join(names) if header else F.lit(True))
    refused = lines.withColumn("parsed", parsed).where("parsed._bad IS NOT NULL").select(F.col("value").alias("line"))
    if refuse and width is not None:
        fields = F.size(F.split("_bad", r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1))
        wrong = F.col("_bad").isNotNull() & (fields != width)
        rows = rows.where(F.when(wrong, F.raise_error(F.concat(F.lit("wrong width: "), F.col("_bad"))).cast("boolean")).otherwise(True))
    return rows.where("_bad IS NULL").select(*names), refused


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; lines that don't parse are skipped."""
    return spark.read.json(path, schema=schema, mode="DROPMALFORMED")


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON per entity, keyed by the file's name."""
    return spark.read.json(path, schema=schema, multiLine=True).withColumn("key", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json", 1))


def result_set(df: DataFrame, payload: str, columns: list[str], headers: str = "headers", rows: str = "rowSet") -> DataFrame:
    """Rows of a payload with a header array and row arrays, by header name whatever its place."""
    p = F.from_json(F.col(payload), f"{headers} array<string>, {rows} array<array<string>>")
    x = df.withColumn("_p", p).withColumn("_r", F.explode(f"_p.{rows}"))
    return x.select("*", *[F.get(F.col("_r"), (F.array_position(F.col(f"_p.{headers}"), c) - 1).cast("int")).alias(c) for c in columns]).drop("_p", "_r")


def write_csv(df: DataFrame, path: str, first: str, compression: str | None = None) -> None:
    """CSV with the key first, other columns sorted, null as empty; takes effect whole, when the job commits. Gzip has no time stamp, so that equal rows in equal order give equal bytes."""
    df.select(first, *sorted(c for c in df.columns if c != first)).write.csv(path, header=True, nullValue="", emptyValue="", mode="overwrite", compression=compression)


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    df.write.partitionBy(*by).mode("overwrite").parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the one that the session names in spark.checkpoint.dir, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, gzip by extension: a file is split on line feeds within its own row, so numbers need no order across tasks."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    return whole.select("file", F.posexplode(F.split("value", "\r?\n", -1)).alias("line_no", "line")).where("line != ''")


def below_header(lines: DataFrame, header: Column, columns: list[str], separator: str = ",") -> DataFrame:
    """Fields by header name of (file, line_no, line) rows: a file's first line that satisfies ``header`` names its columns, what stands above it is no data; a column that a file lacks is null. Rows as wide as their header are kept."""
    head = lines.where(header).groupBy("file").agg(F.min(F.struct("line_no", "line")).alias("head")).select(F.col("file").alias("of"), F.col("head.line_no").alias("at"), F.transform(F.split("head.line", separator), lambda x: F.trim(x)).alias("names"))
    rows = lines.join(head, (F.col("file") == F.col("of")) & (F.col("line_no") > F.col("at"))).withColumn("cells", F.split("line", separator, -1)).where("size(cells) = size(names)")
    return rows.select("file", "line_no", *[F.trim(F.get("cells", F.nullif(F.array_position("names", c), F.lit(0)).cast("int") - 1)).alias(c) for c in columns])


def positional_arrays(df: DataFrame, payload: str, columns: list[str]) -> DataFrame:
    """A JSON array of arrays -> a row each, cells named by position; short rows end in nulls."""
    rows = F.from_json(F.col(payload), "array<array<string>>")
    x = df.withColumn("row of cells", F.explode(rows))
    return x.select(*df.columns, *[F.get("row of cells", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def pinned(spark: SparkSession, path: str, sha256: str) -> str:
    """The path, if the file's bytes have this SHA-256; else refused before anything reads it. The digest is computed where the file is read."""
    found = [r[0] for r in spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).collect()]
    if found != [sha256]:
        raise ValueError(f"{path} has changed: {found}")
    return path


def bundle(spark: SparkSession, glob: str, out: str) -> DataFrame:
    """Many small files as one table (file, with its folder; length; text), rewritten only where the set of files or their lengths changed; a write takes effect whole or not at all."""
    now = spark.read.format("binaryFile").load(glob)
    name = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file")
    names = now.select(name, F.col("length"))
    fs = spark._jvm.org.apache.hadoop.fs.Path(out)
    if fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        had = spark.read.parquet(out)
        if not had.select("file", "length").exceptAll(names).unionByName(names.exceptAll(had.select("file", "length"))).limit(1).count():
            return had
    now.select(name, "length", F.decode("content", "UTF-8").alias("text")).coalesce(1).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def append_columns(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """A table of text cells with new columns beside them: cells are never parsed, so they are written back byte for byte; rows that ``extra`` lacks get empty cells."""
    if kinds := [f.name for f in base.schema if f.dataType.simpleString() != "string"]:
        raise ValueError(f"not read as text: {kinds}")
    if both := sorted((set(base.columns) & set(extra.columns)) - {key}):
        raise ValueError(f"columns exist: {both}")
    cells = extra.select(F.col(key).cast("string").alias(key), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in extra.columns if c != key])
    return base.join(cells, key, "left").select(*base.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in cells.columns if c != key])


def missing_outputs(keys: DataFrame, key: str, out: str) -> DataFrame:
    """Keys without a finished partition ``key=...`` under ``out``: what a run that is taken up again still has to do."""
    spark = keys.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return keys
    done = spark.read.parquet(out).select(F.col(key).cast("string").alias("done")).distinct()
    return keys.join(done, F.col(key).cast("string") == F.col("done"), "left_anti")
