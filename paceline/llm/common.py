"""Shared helpers: where intermediate tables go, and how they are written and read again."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: bytes.split() without arguments splits on exactly these.
WORD_SPACE = "\\x20\\x09-\\x0D"


_held: dict[str, Callable[[], object]] = {}


def claim(owner: str, release: Callable[[], object]) -> None:
    """Python workers outlive a task and serve one operator after another: whoever fills a memo in a worker's process claims
    it first, and what other operators hold there is released. Large blocks that a worker frees go back to the system."""
    if not _held:
        _tidy()
    others = [n for n in _held if n != owner]
    for name in others:
        _held.pop(name)()
    _held[owner] = release
    if others:
        give_back()


def give_back() -> None:
    """What this Python process has freed goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def rest_executors(spark: SparkSession) -> None:
    """Executors' JVMs collect their garbage, all at once, and return the heap that they don't need. Without this a heap stays as
    large as it once was until the collector marks, which it may never do, and counts beside what the next operator takes. A
    task for each core: a free executor gets one at least, a busy one may be left out."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.call_function("java_method", F.lit("java.lang.System"), F.lit("gc")).alias("done")).write.format("noop").mode("overwrite").save()


def _tidy() -> None:
    """Blocks of 1 MB or more are mapped one by one (by default that threshold rises with use, and freed ones are kept), and
    Arrow takes its memory from the same place. Where the C library has no such settings nothing changes."""
    with suppress(OSError, AttributeError):
        mmap_threshold, trim_threshold = -3, -1  # fixed values of the C library's mallopt
        c = ctypes.CDLL(None)
        c.mallopt(mmap_threshold, 1 << 20)
        c.mallopt(trim_threshold, 1 << 24)
        pa.set_memory_pool(pa.system_memory_pool())


def by_bytes(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most `most` bytes together; what is larger stands alone."""
    lo = held = 0
    for i, size in enumerate(sizes):
        if held + size > most and i > lo:
            yield lo, i
            lo, held = i, 0
        held += size
    if len(sizes) > lo:
        yield lo, len(sizes)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where it is unset (tests), one of our own."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    option = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not option.isDefined():
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="paceline-"))
        option = spark.sparkContext._jsc.sc().getCheckpointDir()
    return option.get().rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, deleted when the JVM ends."""
    path = f"{shared_root(spark)}/paceline-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """Cut the lineage: write df to the shared folder as Parquet and read it again. Survives lost executors. files: rows are
    dealt evenly to so many files, in no order. On a local disk without Hadoop's native library the JVM starts a process for
    each file, its checksum and its folder, which counts with the JVM's own memory until it has begun."""
    spark = df.sparkSession
    path = workspace(spark, label)
    (df if files is None else df.repartition(files)).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_for(rows: int) -> int:
    """Files for so many rows of a few numbers each."""
    return max(1, -(-rows // 250_000))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def of_files(df: DataFrame) -> bool:
    """Whether df is a table of files as it was read, so that its rows have places in files."""
    return df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"


def file_number(path: Column) -> Column:
    """The number in a part file's name, which rises with the partitions that were written; null for other names."""
    return F.nullif(F.regexp_extract(path, ".*part-([0-9]{1,18})[^/]*$", 1), F.lit("")).cast("long")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and text, null text as the empty one; other columns go, whatever their names are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def text_partitions(docs: DataFrame, chars: int = 8_000_000) -> int:
    """How many partitions hold about `chars` characters of text each."""
    total = docs.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    return max(1, -(-int(total) // chars))


#: Ids that a broadcast join takes (some 16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def only_ids(rows: DataFrame, columns: list[str], ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """rows whose columns are (left_semi) or are not (left_anti) among ids. ids are broadcast only if they are counted and
    few; reading them again must be cheap."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, columns, how)


def hashed_sample(rows: DataFrame, key: str, n: int, total: int) -> DataFrame:
    """At most n rows, one for each key at most: those of the least hashes of the key among a share of the hashes that holds
    some 2 n of `total` rows. So what meets in one place stays near 2 n rows however many partitions there are."""
    h = F.xxhash64(key)
    if total > 4 * n:
        rows = rows.where(F.pmod(h, F.lit(1 << 40)) < (1 << 40) * 2 * n // total)
    return rows.dropDuplicates([key]).withColumn("__h", h).orderBy("__h", key).limit(n)


#: Rows of one key that a join leaves together.
TOGETHER = 1000


def spread_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """many.join(one, key, how) for keys that may hold a large part of many: such a key's rows are dealt over salts, TOGETHER
    rows to each, and one's rows of the key are repeated for each salt. The keys concerned are counted (counts: key and n, if
    they are known) and broadcast, BROADCAST_IDS of the most frequent ones at most. Rows without a key are not dealt."""
    counts = many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    often = counts.where(F.col("n") > TOGETHER).select(key, F.ceil(F.col("n") / TOGETHER).cast("int").alias("salts"), "n")
    often = materialize(often.orderBy(F.desc("n")).limit(BROADCAST_IDS).drop("n"), "often")
    if not often.limit(1).count():
        return many.join(one, key, how)
    dealt = many.withColumn("__of", F.xxhash64(*many.columns)).join(F.broadcast(often), key, "left")
    dealt = dealt.withColumn("salt", F.coalesce(F.pmod("__of", "salts"), F.lit(0)).cast("int")).drop("__of", "salts")
    repeated = one.join(F.broadcast(often), key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0))))).drop("salts")
    return dealt.join(repeated, [key, "salt"], how).drop("salt")
