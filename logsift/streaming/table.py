"""A Parquet table behind a manifest, for streams that write all day.

Every micro-batch is written by ``foreachBatch``: its rows are rebalanced by the
partition columns, so a month that holds the whole batch is written by as many
tasks as its size asks for, and a small batch gives few files. The batch goes to
a folder of its own, and one manifest entry, put in place by a rename, commits
it. A replayed batch is found in the manifest and skipped; a half-written one has
no entry and is written anew. So every row is there exactly once.

Small files are compacted: the files of a partition are packed into bins of the
target size (first fit, largest first), each bin is passed on by one task to one
file, unsorted and so without being held, and one entry replaces all earlier ones. Readers see either the old files
or the new. Data that no entry names is removed by ``vacuum``.

The driver holds names and sizes of files, never rows. One stream writes a table
under one ``writer`` name; one compaction runs at a time, also beside the stream.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logsift.functions.clean import clean_logs
from logsift.schemas import CLEANED
from logsift.session import _file_system
from logsift.streaming.ingest import _trigger

TARGET_BYTES = 128 << 20


def _entries(spark: SparkSession, table: str) -> dict[str, dict]:
    """Manifest entries that no other one replaces."""
    fs, path = _file_system(spark, f"{table}/_manifest")
    if not fs.exists(path):
        return {}
    found = {}
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.endswith(".json"):
            stream = fs.open(status.getPath())
            try:
                found[name[:-5]] = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
    covered = {x for e in found.values() for x in e["covers"]}
    return {k: e for k, e in found.items() if k not in covered}


def _commit(spark: SparkSession, table: str, name: str, entry: dict) -> None:
    fs, final = _file_system(spark, f"{table}/_manifest/{name}.json")
    draft = _file_system(spark, f"{table}/_manifest/.{name}-{uuid.uuid4().hex}")[1]
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    if not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"manifest entry {name} could not be put in place")


def _written(spark: SparkSession, table: str, sets: list[str]) -> list[dict]:
    """Files of the given sets: path below the table's data, set and bytes."""
    out = []
    for name in sets:
        fs, folder = _file_system(spark, f"{table}/data/set={name}")
        if not fs.exists(folder):
            continue
        base = fs.getFileStatus(folder).getPath().toString()
        files = fs.listFiles(folder, True)
        while files.hasNext():
            f = files.next()
            path = f.getPath().toString()
            if path.endswith(".parquet"):
                out.append({"set": name, "path": path[len(base) + 1:], "bytes": f.getLen()})
    return sorted(out, key=lambda f: f["path"])


def append_batch(df: DataFrame, table: str, batch: int, partition_by: tuple[str, ...] = ("year", "month"),
                 writer: str = "stream") -> bool:
    """Write one batch and commit it; False if it was committed before."""
    spark = df.sparkSession
    name = f"{writer}-{batch:012d}"
    entries = _entries(spark, table)
    if name in entries or any(e["writers"].get(writer, -1) >= batch for e in entries.values()):
        return False
    rows = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    out = rows.write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(f"{table}/data/set={name}")
    _commit(spark, table, name, {"covers": [], "writers": {writer: batch}, "files": _written(spark, table, [name])})
    return True


def write_table_stream(df: DataFrame, table: str, checkpoint: str, partition_by: tuple[str, ...] = ("year", "month"),
                       trigger: str | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None,
                       writer: str = "stream") -> StreamingQuery:
    """Append a stream to the table; ``prepare`` is applied to each micro-batch as a static frame."""

    def write(batch: DataFrame, number: int) -> None:
        # The stream's own session plans without adaptive execution; rebalancing needs it.
        session = batch.sparkSession
        before = session.conf.get("spark.sql.adaptive.enabled")
        session.conf.set("spark.sql.adaptive.enabled", "true")
        try:
            append_batch(prepare(batch) if prepare else batch, table, number, partition_by, writer)
        finally:
            session.conf.set("spark.sql.adaptive.enabled", before)

    return _trigger(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), trigger).start()


def ingest_table(lines: DataFrame, ranges: DataFrame | None, table: str, checkpoint: str,
                 partition_by: tuple[str, ...] = ("year", "month"), trigger: str | None = None, **geo_options) -> StreamingQuery:
    """Raw line stream -> parse, clean, locate -> table. Micro-batches are located as
    static frames, so range tables of any size are merged and not joined on buckets."""
    return write_table_stream(lines, table, checkpoint, partition_by, trigger, lambda batch: clean_logs(batch, ranges, **geo_options))


def live_files(spark: SparkSession, table: str) -> list[dict]:
    return sorted((f for e in _entries(spark, table).values() for f in e["files"]), key=lambda f: (f["set"], f["path"]))


def _folder(file: dict) -> tuple:
    """The partition folder below a set."""
    return tuple(file["path"].split("/")[:-1])


def _frame(spark: SparkSession, table: str, files: list[dict], schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("set", T.StringType())])
    if not files:
        return spark.createDataFrame([], full)
    paths = [f"{table}/data/set={f['set']}/{f['path']}" for f in files]
    return spark.read.option("basePath", f"{table}/data").schema(full).parquet(*paths)


def read_table(spark: SparkSession, table: str, schema: T.StructType = CLEANED, months: tuple | None = None) -> DataFrame:
    """The table's committed rows. ``months``: first and last (year, month) to read;
    other folders are left out before Spark lists or opens them."""
    files = live_files(spark, table)
    if months is not None:
        def inside(file: dict) -> bool:
            values = dict(part.split("=", 1) for part in _folder(file))
            return values.get("year", "").isdigit() and months[0] <= (int(values["year"]), int(values["month"])) <= months[1]

        files = [f for f in files if inside(f)]
    return _frame(spark, table, files, schema).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def bins(sizes: list[int], target: int) -> list[list[int]]:
    """First-fit packing, largest first: indices of each bin."""
    out: list[list[int]] = []
    room: list[int] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        for b, left in enumerate(room):
            if sizes[k] <= left:
                out[b].append(k)
                room[b] -= sizes[k]
                break
        else:
            out.append([k])
            room.append(target - sizes[k])
    return out


def compact(spark: SparkSession, table: str, partition_by: tuple[str, ...] = ("year", "month"),
            schema: T.StructType = CLEANED, target_bytes: int = TARGET_BYTES) -> int:
    """Rewrite files under half the target size, packed by partition; returns how many files went."""
    entries = _entries(spark, table)
    files = [f for e in entries.values() for f in e["files"]]
    by_folder: dict[tuple, list[dict]] = {}
    for f in files:
        if f["bytes"] < target_bytes // 2:
            by_folder.setdefault(_folder(f), []).append(f)
    packed = [[small[k] for k in b] for small in by_folder.values() for b in bins([f["bytes"] for f in small], target_bytes)]
    packed = [b for b in packed if len(b) > 1]
    name = f"compact-{uuid.uuid4().hex}"
    if packed:
        # A file's place: its set, its partition and its name.
        place = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in partition_by]
        key = F.concat_ws("/", "set", *place, F.col("_metadata.file_name"))
        dealt = spark.createDataFrame([("/".join([f["set"], *_folder(f), f["path"].split("/")[-1]]), k) for k, b in enumerate(packed) for f in b],
                                      "_key string, _bin int")
        rows = _frame(spark, table, [f for b in packed for f in b], schema).withColumn("_key", key)
        rows = rows.join(F.broadcast(dealt), "_key").drop("_key")  # one short row for each small file
        # A task of its own for each bin: it has one folder and so one open file, and need not sort its rows by folder.
        rows = rows.repartitionById(len(packed), F.col("_bin")).withColumn("set", F.concat(F.lit(f"{name}-"), F.col("_bin"))).drop("_bin")
        before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "1")
        try:
            rows.write.mode("append").partitionBy("set", *partition_by).parquet(f"{table}/data")
        finally:
            spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", before)
    gone = {(f["set"], f["path"]) for b in packed for f in b}
    stay = [f for f in files if (f["set"], f["path"]) not in gone]
    fresh = _written(spark, table, [f"{name}-{k}" for k in range(len(packed))])
    if packed or len(entries) > 1:
        writers: dict[str, int] = {}
        for e in entries.values():
            for w, batch in e["writers"].items():
                writers[w] = max(batch, writers.get(w, -1))
        _commit(spark, table, name, {"covers": sorted(entries), "writers": writers, "files": stay + fresh})
    return len(gone)


def vacuum(spark: SparkSession, table: str) -> int:
    """Delete replaced manifest entries and data files that no entry names; returns
    how many data files went. Not for use while the stream or a reader of old files runs."""
    live = _entries(spark, table)
    named = {(f["set"], f["path"]) for e in live.values() for f in e["files"]}
    fs, folder = _file_system(spark, f"{table}/_manifest")
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.getPath().getName().removesuffix(".json") not in live:
            fs.delete(status.getPath(), False)
    gone = 0
    fs, data = _file_system(spark, f"{table}/data")
    for status in fs.listStatus(data) if fs.exists(data) else []:
        name = status.getPath().getName()
        if name.startswith("set="):
            for f in _written(spark, table, [name[4:]]):
                if (f["set"], f["path"]) not in named:
                    fs.delete(_file_system(spark, f"{table}/data/set={f['set']}/{f['path']}")[1], False)
                    gone += 1
    return gone
