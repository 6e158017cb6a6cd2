"""What the operators share: reading tables, cutting lineage, typed columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where intermediate tables go on a single machine that names no folder.
LOCAL_DIR = "/tmp/checkpoints"
#: Most bytes of one Arrow batch that is sent to a Python worker.
ARROW_BYTES = 4 << 20
#: Bits of the bitmap of flagged(), in pieces of PIECE_BITS, which is what Spark's bitmap functions hold.
BITMAP_BITS = 1 << 24
PIECE_BITS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a local one only in local mode where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named or LOCAL_DIR


def arrow_bounded(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ARROW_BYTES, so that rows of any length do not fill a worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if now <= 0 or now > ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def fresh(name: str, *frames: DataFrame) -> str:
    """name, or the first of name1, name2 ... that no column of the frames has, upper or lower case."""
    taken = {c.lower() for df in frames for c in df.columns}
    return next(x for x in (name, *(f"{name}{i}" for i in range(1, len(taken) + 2))) if x.lower() not in taken)


#: Paths that written() has made in this process and released() has not deleted.
_made: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: write df once to the shared folder and read it back.

    A columnar table rather than checkpoint(): it is several times smaller, and readers prune its
    columns. The files go when the session's JVM ends, or with released().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/rulegrove-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables() -> set[str]:
    """Paths that written() has made and that are still there."""
    return set(_made)


def released(docs: DataFrame, paths: set[str]) -> None:
    """Delete those of the paths, which written() has made, that docs does not read.

    For jobs of several steps, each of which writes its result before the next begins.
    """
    spark = docs.sparkSession
    read = {p for f in docs.inputFiles() for p in paths if p.rsplit("/", 1)[-1] in f} if paths else set()
    for path in paths & tables() - read:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        _made.remove(path)


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """new, which is written and takes the place of old, a table of written() that nothing reads any more."""
    released(new, {p for f in old.inputFiles()[:1] for p in _made if p.rsplit("/", 1)[-1] in f})
    return new


def flagged(df: DataFrame, name: str, keys: DataFrame, flag: str) -> DataFrame:
    """df with a boolean column `flag`: true if df's column `name` is in keys(name), and by chance for a few others.

    Both are whole numbers, none null in keys. What is broadcast is a bitmap of the keys' hashes, of
    BITMAP_BITS bits at most however many keys there are. An exact join of the flagged rows alone then
    settles them, and the others need not be moved. With very many keys most rows are flagged.
    """
    place = F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(BITMAP_BITS))
    piece, bits = fresh("_piece", df), fresh("_bits", df)
    placed = keys.select(F.floor(place / PIECE_BITS).cast("int").alias(piece), (place % PIECE_BITS).alias("at")).repartition(piece)
    pieces = placed.groupBy(piece).agg(F.bitmap_construct_agg("at").alias(bits))
    byte = F.conv(F.hex(F.substring(bits, ((place % PIECE_BITS) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    joined = df.withColumn(piece, F.floor(place / PIECE_BITS).cast("int")).join(F.broadcast(pieces), piece, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], held.alias(flag))


def crc_text(col) -> F.Column:
    """Unsigned CRC-32 of a value's decimal text."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8"))


def text_or_empty(col="text") -> F.Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


#: Plan nodes behind which a row keeps its place in its file split, whenever it is read.
_STILL = {"Project", "Filter", "LogicalRelation"}


def _plain_scan(docs: DataFrame) -> bool:
    """Whether docs is a deterministic projection or selection of files."""
    nodes = [docs._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() not in _STILL or not node.deterministic() or node.toString().startswith("Relation") and "parquet" not in node.toString().split("]")[-1]:
            return False
        below = node.children()
        nodes += [below.apply(i) for i in range(below.size())]
    return True


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """docs with a unique long per row that stays the same wherever the result is used.

    Over a plain projection or selection of Parquet files numbers follow from the files alone;
    anything else is written once.
    """
    out = docs.withColumn(name, F.monotonically_increasing_id())
    return out if _plain_scan(docs) else written(out)
