"""Readers and writers of raw rows, logs, manifests and hand-off tables. Schemas are given, never inferred."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENVELOPE = (
    "source string, brand string, source_id string, raw_text string, url string, captured_at string, posted_at string, "
    "rating int, helpful_votes int, meta map<string,string>"
)
KEY = ("source", "brand", "source_id")


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path under the one that all machines share (spark.checkpoint.dir); only a local session may leave
    that unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        base = "file://" + tempfile.mkdtemp(prefix="opinara-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def read_raw(spark: SparkSession, root: str, source: str | None = None, brand: str | None = None) -> DataFrame:
    """Well-formed rows of ``root/source=*/brand=*/*.jsonl``; the folders prune by source and brand."""
    rows = spark.read.schema(f"{ENVELOPE}, _torn string").option("columnNameOfCorruptRecord", "_torn").json(root)
    rows = rows.where(F.col("_torn").isNull()).drop("_torn")
    for name, value in (("source", source), ("brand", brand)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows


def parse_jsonl(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Lines of an append-only log as ``schema`` and ``_torn``, the line itself where it does not parse; blanks go."""
    full = f"{schema}, _torn string"
    row = F.from_json(F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"})
    return lines.where(F.trim(column) != "").select(row.alias("r")).select("r.*")


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, torn lines) of the logs at ``path``: torn lines are counted, not fatal."""
    parsed = parse_jsonl(spark.read.text(path), schema)
    return parsed.where("_torn is null").drop("_torn"), parsed.where("_torn is not null").select("_torn")


def latest_report(rows: DataFrame, by: str = "stage", at: str = "at") -> DataFrame:
    """The last row of each stage."""
    last = rows.groupBy(by).agg(F.max_by(F.struct(*rows.columns), F.col(at)).alias("r"))
    return last.select("r.*")


def report_snapshot(rows: DataFrame, by: str = "stage", at: str = "at") -> DataFrame:
    """The last rows of the stages as JSON, one line for each stage."""
    last = latest_report(rows, by, at)
    return last.select(by, F.to_json(F.struct(*last.columns)).alias("report"))


def new_rows(rows: DataFrame, there: DataFrame | None, key: tuple[str, ...] = KEY) -> DataFrame:
    """``rows`` without repeats of a key and without keys that are there already."""
    once = rows.dropDuplicates(list(key))
    return once if there is None else once.join(there.select(*key), list(key), "left_anti")


def write_append_dedup(rows: DataFrame, path: str, key: tuple[str, ...] = KEY, partition: tuple[str, ...] = ("source", "brand")) -> DataFrame:
    """Append new rows to the table at ``path``; one row ``written, skipped, total``. A second run writes nothing.

    Rows are counted on their way in; what the table holds before and after is told by its files' footers, no column of
    which is read.
    """
    spark, asked = rows.sparkSession, Observation()
    try:
        there = spark.read.schema(rows.schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        there = None
    before = 0 if there is None else there.count()
    new_rows(rows.observe(asked, F.count("*").alias("n")), there, key).write.mode("append").partitionBy(*partition).parquet(path)
    total = spark.read.schema(rows.schema).parquet(path).count()
    skipped = counted(asked, rows) - (total - before)
    return spark.range(1).select(F.lit(total - before).alias("written"), F.lit(skipped).alias("skipped"), F.lit(total).alias("total"))


def counted(told: Observation, rows: DataFrame) -> int:
    """What an observation ``n`` of a finished job tells; rows are counted if the job's plan was cut short beside it."""
    try:
        return told.get["n"]
    except (Py4JJavaError, KeyError):
        return rows.count()


#: Bytes of a file up to which it is hashed as one value; larger ones are read in parts of CHUNK bytes.
WHOLE_FILE, CHUNK = 32 << 20, 4 << 20
#: Files up to which Spark's reader lists and plans them, all on the driver; more are listed and read by tasks.
LISTED = 20_000
#: Tasks for each core that list or read, and bytes and rows told at once.
TASKS_PER_CORE, TOLD_BYTES, TOLD_ROWS = 4, 8 << 20, 2_000


def _stored(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Hadoop says it, nothing escaped (scheme, maybe a host, place), and the place there."""
    scheme, host, place = re.fullmatch(r"(?:([a-z0-9+.-]+):)?(?://([^/]*))?(/.*)", path, re.S | re.I).groups()
    store, root = (fs.LocalFileSystem(), "") if scheme in (None, "file") else fs.FileSystem.from_uri(f"{scheme}://{host or ''}")
    return store, root.rstrip("/") + place


def write_each(rows: DataFrame, path: str, text: str = "text") -> int:
    """A file ``path/part/row`` for each row, its text and a line feed; how many. A task that runs again writes over its files.

    A Spark writer makes two files and starts a process for each to set its rights on a local disk, and its driver moves them
    one by one; so many small files go through the file systems that Arrow knows.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _stored(f"{path}/{TaskContext.get().partitionId()}")
        store.create_dir(place, recursive=True)
        n = 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                with store.open_output_stream(f"{place}/{n}") as out:
                    out.write(f"{value or ''}\n".encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return rows.select(text).mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _digest(path: str) -> str:
    """The hash of a file that is read in parts of CHUNK bytes."""
    store, place = _stored(path)
    digest = hashlib.sha256()
    with store.open_input_stream(place) as stream:
        while chunk := stream.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _hash_in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [_digest(path) for path in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], names=[*batch.schema.names, "sha256"])


_ENTRY = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("bytes", pa.int64()), ("at", pa.int64())])
_READ = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("at", pa.int64()), ("content", pa.large_binary()), ("sha256", pa.string())])


def _told(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes and rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("content") or b"")
        if size >= TOLD_BYTES or len(held) >= TOLD_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


def _entries(path: str) -> Iterator[dict]:
    """What is in a folder, as Hadoop would say it: milliseconds, paths with nothing escaped."""
    store, place = _stored(path)
    for x in store.get_file_info(fs.FileSelector(place)):
        yield {"path": f"{path.rstrip('/')}/{x.base_name}", "folder": x.type == fs.FileType.Directory, "bytes": x.size or 0, "at": (x.mtime_ns or 0) // 1_000_000}


def _seen(path: str) -> bool:
    """Whether Spark's readers look at an entry of this name."""
    name = path.rsplit("/", 1)[1]
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return not hidden or name.startswith(("_common_metadata", "_metadata"))


def _children(pattern: str, folders: bool):
    """Folders -> their entries of names like ``pattern``, only folders if ``folders``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like = re.compile(pattern, re.S)
        yield from _told((x for b in batches for path in b.column("path").to_pylist() for x in _entries(path) if like.fullmatch(x["path"].rsplit("/", 1)[1]) and (x["folder"] or not folders)), _ENTRY)

    return run


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files stay, folders are their files and those of folders ``key=value`` below; as Spark's readers have it, nothing hidden
    and no file without a byte."""

    def below(x: dict) -> Iterator[dict]:
        if not x["folder"]:
            if x["bytes"] and _seen(x["path"]):
                yield x
            return
        for y in _entries(x["path"]):
            if not y["folder"] or ("=" in y["path"].rsplit("/", 1)[1] and _seen(y["path"])):
                yield from below(y)

    yield from _told((y for b in batches for x in b.to_pylist() for y in below(x)), _ENTRY)


def _listing(spark: SparkSession, path: str) -> DataFrame | None:
    """``path, folder, bytes, at`` of the files that Spark's reader finds at ``path``, listed by tasks, folder by folder; none
    if Arrow does not know the file system or the pattern has escapes or alternatives with a slash."""
    jvm, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    given = jvm.Path(path)
    root = given.getFileSystem(conf).makeQualified(given).toString()
    if "\\" in path or re.search(r"\{[^}]*/", root):
        return None
    start, place = re.fullmatch(r"((?:[A-Za-z0-9+.-]+:)?(?://[^/]*)?)(/.*)", root, re.S).groups()
    names = place.strip("/").split("/")
    fixed = next((i for i, name in enumerate(names) if re.search(r"[{}\[\]*?]", name)), len(names))
    root = start + "/" + "/".join(names[:fixed])
    try:
        store, place = _stored(root)
        is_folder = (info := store.get_file_info(place)).type == fs.FileType.Directory
    except (pa.ArrowException, OSError, ImportError):
        return None
    schema, tasks = "path string, folder boolean, bytes long, at long", TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    found = spark.createDataFrame([(root, is_folder, info.size or 0, (info.mtime_ns or 0) // 1_000_000)], schema)
    for i, name in enumerate(names[fixed:], fixed + 1):
        like = jvm.GlobPattern(name).compiled().toString() if re.search(r"[{}\[\]*?]", name) else re.escape(name)
        found = found.mapInArrow(_children(like, i < len(names)), schema).repartition(tasks)
    return found.mapInArrow(_files, schema)


def _read(whole: int):
    """Files -> the contents of small ones, the hashes of large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(row: dict) -> dict:
            if row["bytes"] > whole:
                return row | {"content": None, "sha256": _digest(row["path"])}
            store, place = _stored(row["path"])
            with store.open_input_stream(place) as stream:
                return row | {"content": stream.read(), "sha256": None}

        yield from _told((each(row) for b in batches for row in b.to_pylist()), _READ)

    return run


def file_manifest(spark: SparkSession, path: str, whole: int = WHOLE_FILE, listed: int = LISTED) -> DataFrame:
    """``path, sha256, bytes, closed_at`` of each file, of any size and any number.

    A file of up to ``whole`` bytes is one value, hashed where it is read. Larger ones are only listed (their contents are
    not read), dealt over tasks, and hashed there in parts of CHUNK bytes, through the file systems that Arrow knows. Which are
    which is told by the listing, so each side has tasks for its own files only. Spark lists no file without a byte.

    Spark's reader holds the listing and the plan of all files on the driver. So more than ``listed`` files, if Arrow knows their
    file system, are listed by tasks and dealt over tasks that read them; the rows are the same.
    """
    found = _listing(spark, path)
    if found is not None and found.limit(listed + 1).count() > listed:
        dealt = found.select("path", "bytes", "at").repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, "path")
        read = dealt.mapInArrow(_read(whole), "path string, bytes long, at long, content binary, sha256 string")
        return read.select("path", F.coalesce("sha256", F.sha2("content", 256)).alias("sha256"), "bytes", F.timestamp_millis("at").alias("closed_at"))
    files, size = spark.read.format("binaryFile").load(path), F.col("_metadata.file_size")
    meta = (F.col("length").alias("bytes"), F.col("modificationTime").alias("closed_at"))
    small = files.where(size <= whole).select("path", F.sha2("content", 256).alias("sha256"), *meta)
    large = files.where(size > whole).select("path", *meta).repartition("path")
    hashed = large.mapInArrow(_hash_in_chunks, "path string, bytes long, closed_at timestamp, sha256 string")
    return small.unionByName(hashed)


def verify_manifest(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """``path, problem`` of files that are missing or have changed since their last entry."""
    last = manifest.groupBy("path").agg(F.max_by("sha256", "closed_at").alias("expected"))
    both = last.join(files.select("path", F.col("sha256").alias("found")), "path", "left")
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("expected"), "changed")
    return both.select("path", problem.alias("problem")).where("problem is not null")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_index_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header in index order; the index is an aggregate of cells, so one file holds it."""
    df.orderBy("source", "temporal_stance", F.desc_nulls_last("oi"), "opportunity_area", *(c for c in ("brand",) if c in df.columns)).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def snapshot(tables: dict[str, DataFrame], keep: tuple[str, ...], path: str) -> DataFrame:
    """Write each table's kept columns (never review bodies) and return ``table, n_rows``."""
    counts = []
    for name, df in tables.items():
        slim, told = df.select(*[c for c in keep if c in df.columns]), Observation()
        slim.observe(told, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/{name}")
        counts.append((name, counted(told, slim)))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(counts, "table string, n_rows long")


def read_gold_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def bucketed_history(spark: SparkSession, name: str, path: str, schema: str, id: str = "utterance_id", buckets: int = 512) -> DataFrame:
    """The table ``name`` at ``path``, made if it is not there yet, bucketed by id: a join on the id leaves it where it is.

    Rows are added by ``add_history``. A new session names the table again and finds the rows. ``buckets`` should be no
    less than the session's shuffle partitions, else Spark may shuffle the table all the same.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({id}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def add_history(rows: DataFrame, name: str, id: str = "utterance_id") -> None:
    """Append rows to a bucketed table, one file for each bucket that they touch."""
    spark = rows.sparkSession
    buckets = next(int(r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Num Buckets")
    columns = spark.table(name).columns
    rows.select(*columns).repartition(buckets, id).write.mode("append").format("parquet").bucketBy(buckets, id).saveAsTable(name)
