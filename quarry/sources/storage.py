"""Sinks, sources and incremental builds.

Tables live under a base path in the shared filesystem (on a cluster the
folder named by ``spark.checkpoint.dir`` or any path the job is given);
writes are whole-table or whole-partition replacements, so a rerun after a
lost executor or a failed job rewrites the same files.
"""

from __future__ import annotations

from functools import partial

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from quarry.functions.sha256 import Sha256
from quarry.sources.builds import build_once


def _absent(e: AnalysisException) -> bool:
    """Whether the error says that the path does not exist (anything else is raised)."""
    return e.getCondition() == "PATH_NOT_FOUND"


TERM_MAP_SCHEMA = StructType([StructField("doc_id", LongType()),
                              StructField("terms", MapType(StringType(), LongType()))])


# ---- S6 / S5 -----------------------------------------------------------------------

def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                  sort_within: list[str] | None = None) -> None:
    """S6. ``sort_within`` orders rows inside each file so parquet min/max
    statistics let later scans skip row groups (e.g. by ``word``)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


# ---- S7 / F3 -----------------------------------------------------------------------

def write_term_maps_json(terms: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per document ``{doc_id, terms: {word: tf}}``. The
    map of one document is bounded by that document's vocabulary."""
    m = terms.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "tf"))).alias("terms"))
    m.write.mode(mode).json(path)


def read_term_maps_json(spark: SparkSession, path: str) -> DataFrame:
    """S7 + F3: read with an explicit map schema, flatten to ``doc_id, word, tf``."""
    m = spark.read.schema(TERM_MAP_SCHEMA).json(path)
    return m.select("doc_id", F.explode("terms").alias("word", "tf"))


# ---- S8 ------------------------------------------------------------------------------

def read_preferred(spark: SparkSession, base: str, json_schema: StructType | None = None) -> DataFrame:
    """``base.parquet`` if it exists, else ``base.json``."""
    try:
        return spark.read.parquet(base + ".parquet")
    except AnalysisException as e:
        if not _absent(e):
            raise
        r = spark.read
        if json_schema is not None:
            r = r.schema(json_schema)
        return r.json(base + ".json")


# ---- S9 / N2 / N4 --------------------------------------------------------------------

def save_vectors(vectors: DataFrame, path: str, mode: str = "append", partition_col: str = "file") -> None:
    """Create (overwrite), append, or replace only the partitions present
    in ``vectors`` (``mode='replace'``, dynamic partition overwrite: N2)."""
    w = vectors.write.partitionBy(partition_col)
    if mode == "replace":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.parquet(path)


def not_yet_done(entries: DataFrame, path: str, keys=("file", "entry_id")) -> DataFrame:
    """Entries whose keys are not in the table at ``path`` (if any)."""
    spark = entries.sparkSession
    try:
        done = spark.read.parquet(path)
    except AnalysisException as e:
        if not _absent(e):
            raise
        return entries
    done = done.select(*keys).distinct()
    return entries.join(done, list(keys), "left_anti")


# ---- S10 -------------------------------------------------------------------------------

def write_stats(stats: DataFrame, path: str) -> None:
    stats.coalesce(1).write.mode("overwrite").json(path)


def read_stats(spark: SparkSession, path: str, corpus_size: int = -1, avg_doc_len: float = -1.0) -> DataFrame:
    """The stored statistics, or the configured values where absent."""
    schema = "corpus_size long, avg_doc_len double"
    try:
        s = spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if not _absent(e):
            raise
        s = spark.createDataFrame([], schema)
    n = s.select(F.max("corpus_size")).scalar()     # NULL when no stats were stored
    a = s.select(F.max("avg_doc_len")).scalar()
    return spark.range(1).select(F.coalesce(n, F.lit(corpus_size)).alias("corpus_size"),
                                 F.coalesce(a, F.lit(avg_doc_len)).alias("avg_doc_len"))


# ---- S11 / N3 ---------------------------------------------------------------------------

def sorted_runs(postings: DataFrame) -> DataFrame:
    """Postings dealt so that a shard is written by one task, a large one by a few."""
    return postings.repartitionByRange("shard", "word", "doc_int").sortWithinPartitions("shard", "word", "doc_int")


def write_shards(postings: DataFrame, path: str, overwrite: bool = False) -> bool:
    """One directory per shard, rows sorted by word, read back with
    ``builds.read_build``. A complete output is kept unless ``overwrite``; what
    a killed run left is built again (N3). Rows are dealt by ranges of (shard,
    word, doc), so a large shard is written by several tasks. Returns whether
    it wrote."""
    return build_once(postings, path, "shard", overwrite, sorted_runs)


# ---- S2 / S14 ---------------------------------------------------------------------------

def list_files(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """``path, name, length`` of the files matching ``glob``, sorted."""
    f = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
              .select("path", "length"))
    return f.select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "length").orderBy("name")


#: Files above this many bytes are read in splits.
WHOLE_FILE = 64 << 20
#: Names that Spark's text reader would unpack.
PACKED = r"\.(gz|deflate|bz2|lz4|snappy|zst)$"
BOM = b"\xef\xbb\xbf"


def _blocks(batches):
    """The lines of a batch as one row: their bytes, and where their split starts."""
    import pyarrow as pa
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([b.column(0).slice(0, 1), pa.array([b"\n".join(b.column(1).to_pylist())], pa.binary())],
                                             ["start", "block"])


def _split_sizes(i, rows):
    """``(start, partition, bytes)`` of a partition with lines, a ``\\n`` counted for every line."""
    sizes = [(r.start, len(r.block) + 1) for r in rows]
    if sizes:
        yield min(sizes)[0], i, sum(n for _, n in sizes)


def _hash_on(states, later, i, rows):
    """The state after partition ``i``; a ``\\n`` parts its lines from those before."""
    digest = Sha256(states[i])
    for k, r in enumerate(rows):
        if later or k:
            digest.update(b"\n")
        digest.update(bytes(r.block))
    yield digest.state()


def _sha256_by_splits(lines: DataFrame, files: list) -> list[str]:
    """SHA-256 of each of ``files(file_path, length)`` from ``lines`` (text read
    with ``lineSep`` ``\\n``, bytes as they are).

    All splits are read at once and kept on disk as blocks of bytes. The digest is
    then taken from split to split: a round hashes the next one of every file, and
    only the digests' states pass through the driver. Whether a file ends in
    ``\\n`` and whether the reader left out a byte order mark follows from its length.
    """
    sc = lines.sparkSession.sparkContext
    rdds = [lines.filter(F.col("_metadata.file_path") == f.file_path)
                 .select(F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
                 .mapInArrow(_blocks, "start long, block binary").rdd for f in files]
    blocks = sc.union(rdds).persist(StorageLevel.DISK_ONLY)
    try:
        owner = [k for k, r in enumerate(rdds) for _ in range(r.getNumPartitions())]
        splits, size = [[] for _ in files], [0] * len(files)
        for _, i, n in sorted(blocks.mapPartitionsWithIndex(_split_sizes).collect()):
            splits[owner[i]].append(i)
            size[owner[i]] += n
        # -1: the last line has no newline; 0: it has; 3 more: a mark was left out
        left = [f.length - n for f, n in zip(files, size)]
        for f, n in zip(files, left):
            if n not in (-1, 0, 2, 3):
                raise RuntimeError(f"{f.file_path}: {f.length} bytes listed, {f.length - n} read")
        state = [Sha256().update(BOM if n > 0 else b"").state() for n in left]
        for step in range(max(map(len, splits))):
            todo = [k for k, s in enumerate(splits) if step < len(s)]
            states = {splits[k][step]: state[k] for k in todo}
            hashed = blocks.mapPartitionsWithIndex(partial(_hash_on, states, step > 0))
            for k, s in zip(todo, sc.runJob(hashed, list, list(states))):
                state[k] = s
        return [Sha256(s).update(b"\n" if n in (0, 3) and size[k] else b"").hexdigest()
                for k, (s, n) in enumerate(zip(state, left))]
    finally:
        blocks.unpersist()


def checksums(spark: SparkSession, directory: str, glob: str = "*.parquet",
              expected: DataFrame | None = None, whole: int = WHOLE_FILE) -> DataFrame:
    """``name, length, sha256`` per file; with an ``expected(name, sha256)``
    manifest, adds ``ok``. A file of up to ``whole`` bytes (or one with a packed
    file's name) is read by one task, a larger one split by split when this is called."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    name = F.regexp_extract("path", "([^/]+)$", 1).alias("name")
    # conditions on _metadata alone: Spark drops the other files before it reads any
    in_splits = (F.col("_metadata.file_size") > whole) & ~F.col("_metadata.file_name").rlike(PACKED)
    f = files.filter(~in_splits).select(name, "length", F.sha2("content", 256).alias("sha256"))
    large = files.filter(in_splits).select(name, "length", "_metadata.file_path").collect()
    if large:
        lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(directory)
        sums = [(r.name, r.length, s) for r, s in zip(large, _sha256_by_splits(lines, large))]
        f = f.unionByName(spark.createDataFrame(sums, "name string, length long, sha256 string"))
    if expected is not None:
        e = expected.select("name", F.col("sha256").alias("expected"))
        f = f.join(e, "name", "left").withColumn("ok", F.col("sha256") == F.col("expected"))
    return f


# ---- N1 -----------------------------------------------------------------------------------

def incremental_terms(docs: DataFrame, out_path: str, manifest_path: str, build,
                      restart: bool = False) -> int:
    """Process only the files not listed in the manifest.

    ``build(docs) -> DataFrame`` computes the per-document rows (with
    ``file``); they are appended to ``out_path`` (partitioned by file) and
    the files are added to the manifest. ``restart`` rebuilds from scratch.
    Returns the number of files processed in this call.
    """
    spark = docs.sparkSession
    if restart:
        todo = docs
    else:
        try:
            done = spark.read.parquet(manifest_path)
        except AnalysisException as e:
            if not _absent(e):
                raise
            done = None
        todo = docs if done is None else docs.join(done.select("file"), "file", "left_anti")
    files = todo.select("file").distinct().cache()
    n = files.count()
    if n == 0:
        files.unpersist()
        return 0
    # new files' partitions are replaced (dynamic overwrite), so a retried run
    # rewrites what a failed attempt may have left instead of duplicating it;
    # a restart replaces the whole table
    (build(todo).write.partitionBy("file").mode("overwrite")
        .option("partitionOverwriteMode", "static" if restart else "dynamic").parquet(out_path))
    files.write.mode("overwrite" if restart else "append").parquet(manifest_path)
    files.unpersist()
    return n
