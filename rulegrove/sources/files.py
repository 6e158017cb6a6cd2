"""Reading and writing of texts, JSON documents and line-delimited JSON, by Spark's own readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulegrove.plans import render


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, in whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


#: Inputs below so many bytes a core are dealt out before costly expressions.
SMALL = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it is small: a file of one row group is one task, however many cores there are.

    Large inputs come in enough splits of their own and are not moved.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * SMALL else df


def _empty_files(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(path, name, empty text) of the files of no bytes under a path or glob, which Spark's scans leave out."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.globStatus(p) or [])
    found += [f for d in found if d.isDirectory() for f in fs.listStatus(d.getPath())]
    empty = [f.getPath() for f in found if f.isFile() and f.getLen() == 0]
    return [(f.toString(), f.getName(), "") for f in empty if f.getName()[0] not in "_."]


def read_texts(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(path, name, text), one row a file, empty files included. Missing files give no rows; strict: they fail, and so do blank ones."""
    schema = "path string, name string, text string"
    if not exists(spark, path):
        if strict:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    empty = _empty_files(spark, path)
    if empty:
        rows = rows.unionByName(spark.createDataFrame(empty, schema))
    if strict:
        rows = rows.withColumn("text", F.when(F.trim("text") == "", F.raise_error(F.concat(F.lit("blank file: "), "path"))).otherwise(F.col("text")))
    return rows


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """read_texts() with `json`: a VARIANT, an empty object where the file holds no JSON object."""
    parsed = "try_parse_json(text)"
    return read_texts(spark, path).withColumn("json", F.expr(f"coalesce(IF(schema_of_variant({parsed}) LIKE 'OBJECT%', {parsed}, NULL), parse_json('{{}}'))"))


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-delimited JSON; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def stream_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def sample_id(name: str = "name") -> F.Column:
    """File name less .graph.json, or else less its last extension."""
    return F.regexp_replace(name, r"(\.graph\.json|\.[^.]*)$", "")


def read_graphs(spark: SparkSession, path: str, parents_only: bool = True) -> DataFrame:
    """Decoded graphs with sample_id; parents_only leaves out variants, whose names hold two underscores."""
    rows = read_texts(spark, path).filter(F.col("name").endswith(".graph.json"))
    if parents_only:
        rows = rows.filter(~F.col("name").contains("__"))
    return render.decode(rows.select(sample_id().alias("sample_id"), F.col("text").alias("json"))).drop("json")


def select_samples(df: DataFrame, *, prefix: str | None = None, pattern: str | None = None, allowed: DataFrame | None = None, start: int = 0, limit: int = -1) -> DataFrame:
    """Samples by prefix, pattern and allow-list, then a stretch of them in order of id."""
    out = df
    if prefix:
        out = out.filter(F.col("sample_id").startswith(prefix))
    if pattern:
        out = out.filter(F.col("sample_id").rlike(pattern))
    if allowed is not None:
        out = out.join(allowed, "sample_id", "left_semi")
    if start or limit >= 0:
        out = out.orderBy("sample_id").offset(start)
        out = out.limit(limit) if limit >= 0 else out
    return out


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id a line; blank lines and # comments do not count."""
    line = F.trim("value")
    return spark.read.text(path).filter((line != "") & ~line.startswith("#")).select(line.alias("sample_id")).distinct()


def not_done(samples: DataFrame, done: DataFrame | None, key: str = "sample_id") -> DataFrame:
    """Resume: samples that the earlier output does not hold."""
    return samples if done is None else samples.join(done, key, "left_anti")


def log_succeeded(text: str = "text") -> F.Column:
    """A finished log that tells of no failure."""
    low = F.lower(text)
    return F.col(text).contains("DONE") & ~low.contains("traceback") & ~low.contains("failed") & ~low.contains("llm_error")


def write_graphs(graphs: DataFrame, path: str, mode: str = "overwrite", key: str = "sample_id") -> None:
    """Graphs as a table of (sample_id, json), which read_written_graphs reads back."""
    render.encode(graphs).select(F.col(key).cast("string").alias("sample_id"), "json").write.mode(mode).parquet(path)


def read_written_graphs(spark: SparkSession, path: str) -> DataFrame:
    return render.decode(spark.read.parquet(path)).drop("json")


def write_documents(rows: DataFrame, folder: str, *, key: str = "sample_id", suffix: str = ".json", text: str = "json") -> DataFrame:
    """One file `<key><suffix>` a row, in whatever store the folder is; gives (key, path).

    Every file ends with one line feed. Slashes of keys become underscores; rows with equal keys are
    one file. Executors write the texts; the driver only renames files, so this form is for exchange
    with readers of files: at scale the tables are the results.
    """
    top = folder.rstrip("/")
    files = rows.select(F.col(key).cast("string").alias(key), F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "\n$", "").alias("text"))
    files = files.withColumn("name", F.translate(key, "/\\", "__"))
    files.dropDuplicates(["name"]).select("text", "name").write.mode("overwrite").partitionBy("name").text(f"{top}/_staged")
    _collected(rows.sparkSession, f"{top}/_staged", top, suffix)
    return files.select(key, F.concat(F.lit(f"{top}/"), "name", F.lit(suffix)).alias("path"))


def _collected(spark: SparkSession, staged: str, folder: str, suffix: str) -> None:
    """Renames the one part file of each name=... folder to <folder>/<name><suffix>."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(staged)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for one in fs.listStatus(top):
        name = one.getPath().getName()
        if name.startswith("name="):
            part = next(f.getPath() for f in fs.listStatus(one.getPath()) if f.getPath().getName().startswith("part-"))
            target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{unescape(name[5:])}{suffix}")
            fs.delete(target, False)
            fs.rename(part, target)
    fs.delete(top, True)


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of whole-file JSON arrays."""
    return spark.read.schema(schema).json(path, multiLine=True)


def find_record(rows: DataFrame, key: str, value: str) -> DataFrame:
    """At most one of the rows whose trimmed key is value."""
    return rows.filter(F.trim(F.col(key).cast("string")) == value.strip()).limit(1)


def read_protocols(spark: SparkSession, path: str) -> DataFrame:
    """Stored evaluation protocols as scoring items; a file without one fails.

    Columns: sample_id and those of render.eval_items.
    """
    rows = read_texts(spark, path, strict=True)
    fine = F.coalesce(F.get_json_object("text", "$.eval_protocol"), F.lit("{}")) != "{}"
    whole = F.when(fine, F.col("text")).otherwise(F.raise_error(F.concat(F.lit("no evaluation protocol: "), "path")))
    named = F.coalesce(F.get_json_object("text", "$.sample_id"), F.regexp_replace("name", r"(\.eval)?\.json$", ""))
    return render.protocol_items(rows.select(named.alias("sample_id"), whole.alias("json")))


def write_table(df: DataFrame, path: str, mode: str = "append", by: str | None = None) -> None:
    """Result tables as Parquet, optionally partitioned by a column."""
    writer = df.write.mode(mode)
    (writer.partitionBy(by) if by else writer).parquet(path)
