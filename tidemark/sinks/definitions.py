"""Writers of the synced set: whole versions, a table of runs, files in a shared folder."""

from __future__ import annotations

import itertools
import posixpath
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sinks.publish import current, publish, published

RUNS = f"{schemas.DEFINITIONS}, run BIGINT"


def current_files(local_files: DataFrame) -> DataFrame:
    """One row per path: the last run's where there are runs; else a repeated path is an error."""
    if "run" in local_files.columns:
        return latest_definitions(local_files)
    twice = local_files.groupBy("path").count().filter("count > 1").select("path").head()
    if twice is not None:
        raise ValueError(f"{twice['path']} is there twice: the synced set has one row per path")
    return schemas.conform(local_files, schemas.DEFINITIONS)


def write_version(local_files: DataFrame, writes: DataFrame, fetched: DataFrame, dest: str) -> DataFrame:
    """Write the next version of the definitions to ``dest`` and read it back.

    ``writes`` are the paths of ``fetched``, stored before, so the plan behind
    them has run. All files are written in one job. The version is published
    when that is complete; after a failure ``dest`` has no version and the run can
    be repeated. A version that is published is never replaced. Unchanged files
    are picked by an anti-join with the stored paths; while these are few, Spark
    sends them around and shuffles no text. ``dest`` must not be the folder that
    ``local_files`` is read from.
    """
    spark = fetched.sparkSession
    kept = schemas.conform(local_files, schemas.DEFINITIONS).join(writes.select("path"), "path", "left_anti")
    files = schemas.conform(fetched, schemas.DEFINITIONS).unionByName(schemas.conform(kept, schemas.DEFINITIONS))
    publish(spark, dest, lambda folder: files.write.partitionBy("kind").parquet(folder), once=True, alone=True)
    return read_version(spark, dest)


def read_version(spark: SparkSession, dest: str) -> DataFrame:
    """The definitions of a version; an error if none is published in ``dest``."""
    return spark.read.schema(schemas.DEFINITIONS).parquet(current(spark, dest))


def append_run(fetched: DataFrame, location: str, run: int) -> None:
    """Add the fetched files to a table of runs under the number ``run``.

    The cost is that of the change and not of the whole set. A run that failed
    is repeated under its number. It replaces only its own rows, and those of
    its last success stay until the new ones are complete.
    """
    changed = schemas.conform(fetched, schemas.DEFINITIONS).withColumn("run", F.lit(run).cast("bigint"))
    publish(fetched.sparkSession, location, lambda folder: changed.write.parquet(folder), name=str(run))


def read_runs(spark: SparkSession, location: str, before: int | None = None) -> DataFrame:
    """All rows of a table of runs, or of those before a run; none if there is no table yet.

    Several rows may have one path. As ``local_files`` of a plan they will do
    as they are, since a plan only asks which paths exist.
    """
    folders = {int(run): folder for run, folder in published(spark, location).items()}
    wanted = [folder for run, folder in sorted(folders.items()) if before is None or run < before]
    return spark.read.schema(RUNS).parquet(*wanted) if wanted else spark.createDataFrame([], RUNS)


def accepted(spark: SparkSession, location: str, run: int, at: str) -> DataFrame:
    """Commits of the paths that a run wrote, as of the time ``at`` at which it was accepted.

    With these among the ``commits``, a later run fetches a file again once its
    source has changed after that time, instead of warning about it.
    """
    written = read_runs(spark, location).filter(F.col("run") == run)
    return written.select("path", F.lit(at).cast("timestamp").alias("commit_ts"))


def latest_definitions(runs: DataFrame) -> DataFrame:
    """The synced set after the given runs: the last row of each path.

    The last run of a path is found on narrow rows; texts are only joined.
    """
    last = runs.groupBy("path").agg(F.max("run").alias("run"))
    return schemas.conform(runs.join(last, ["path", "run"]), schemas.DEFINITIONS)


# File systems by the scheme of a root; each is made inside a task, with the credentials that it finds there.
FILE_SYSTEMS: dict[str, Callable[[], fs.FileSystem]] = {
    "": lambda: fs.LocalFileSystem(),
    "file": lambda: fs.LocalFileSystem(),
    "s3": lambda: fs.S3FileSystem(),
    "s3a": lambda: fs.S3FileSystem(),
    "gs": lambda: fs.GcsFileSystem(),
    "hdfs": lambda: fs.HadoopFileSystem("default"),
}


def write_files(definitions: DataFrame, root: str, file_system: Callable[[], fs.FileSystem] | None = None) -> None:
    """Write each definition as a text file below ``root``, a folder all executors share or a place in an object store.

    Executors write their own rows, dealt to all cores where few tasks would have them. ``file_system`` makes the file system where
    that of the root's scheme won't do. A file appears whole under its name, so a
    task that runs twice does no harm: an object store shows what is closed, and
    elsewhere a file gets its name at the end.
    """
    scheme, base = _split(root)
    make = file_system or _file_system(scheme, root)

    def write(rows: Iterable[Row]) -> None:
        files, known = make(), set()
        renames = isinstance(files, (fs.LocalFileSystem, fs.HadoopFileSystem))
        for row in rows:
            own, target = _split(row["path"])
            if own != scheme or not target.startswith(base.rstrip("/") + "/"):
                raise ValueError(f"{row['path']} is not below {root}")
            partial = f"{target}.{uuid.uuid4().hex}.part" if renames else target
            folder = posixpath.dirname(target)
            if renames and folder not in known:
                files.create_dir(folder, recursive=True)
                known.add(folder)
            with files.open_output_stream(partial) as out:
                out.write(row["content"].encode())
            if renames:
                files.move(partial, target)

    files = definitions.select("path", "content")
    tasks = _file_tasks(definitions.sparkSession)
    (files if files.rdd.getNumPartitions() >= tasks else files.repartition(tasks)).foreachPartition(write)


# Files that are read at once, and names that are sent at once.
READ_FILES, LISTED_NAMES = 256, 1 << 14


def read_files(spark: SparkSession, root: str, file_system: Callable[[], fs.FileSystem] | None = None) -> DataFrame:
    """``path`` and ``content`` (binary) of every file below ``root``, empty ones too.

    Folders are listed in tasks, and names dealt to the tasks that read them; the driver
    sees neither. Folders that lie directly in ``root`` are listed side by side. Spark's own file
    sources hold all names on the driver and start a task for each few files.
    """
    scheme, base = _split(root)
    make = file_system or _file_system(scheme, root)
    tasks = _file_tasks(spark)

    def listing(folder: str, deep: bool) -> Iterator[tuple[str, bool]]:
        files, open_folders = make(), [folder]
        while open_folders:
            for info in files.get_file_info(fs.FileSelector(open_folders.pop())):
                is_folder = info.type == fs.FileType.Directory
                if is_folder and deep:
                    open_folders.append(info.path)
                else:
                    yield info.path, is_folder

    def named(found: Iterator[tuple[str, bool]]) -> Iterator[pa.RecordBatch]:
        for names in _chunks(found, LISTED_NAMES):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*names, strict=True)], ["name", "is_folder"])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                yield from named(listing(base, deep=False))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, is_folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from named(listing(name, deep=True) if is_folder else iter([(name, False)]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = make()

        def content(name: str) -> bytes:
            with files.open_input_stream(name) as data:
                return data.read()

        prefix = f"{scheme}://" if scheme else ""
        for batch in batches:
            for names in _chunks(batch.column(0).to_pylist(), READ_FILES):
                texts = pa.array(map(content, names), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([prefix + n for n in names]), texts], ["path", "content"])

    listed = "name STRING, is_folder BOOLEAN"
    names = spark.range(1, numPartitions=1).mapInArrow(top, listed).repartition(tasks, "name").mapInArrow(walk, listed)
    return names.select("name").repartition(tasks, "name").mapInArrow(read, "path STRING, content BINARY")


def _chunks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while chunk := list(itertools.islice(rows, size)):
        yield chunk


def _file_tasks(spark: SparkSession) -> int:
    """Tasks for work that is counted in files and not in bytes: a few for each core."""
    return 4 * spark.sparkContext.defaultParallelism


def _file_system(scheme: str, root: str) -> Callable[[], fs.FileSystem]:
    if scheme not in FILE_SYSTEMS:
        raise ValueError(f"no file system is known for {root}; pass one or use {', '.join(filter(None, FILE_SYSTEMS))}")
    return FILE_SYSTEMS[scheme]


def _split(uri: str) -> tuple[str, str]:
    """Scheme and normal path; a bucket is the path's first part."""
    scheme, sep, rest = uri.partition("://")
    if not sep:
        return "", posixpath.abspath(uri)
    return scheme, posixpath.normpath(rest)
