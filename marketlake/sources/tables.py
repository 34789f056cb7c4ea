"""Tables on shared storage, all of them ordinary Parquet tables of the session catalog: keyed upsert (S13, U1
applied to storage), insert-mostly tables resolved on read (W3c), key-less append (S14), column listing (S16), the
per-event parquet cache (S11, S12) and retention (T4).

A keyed table is partitioned by a hash bucket of its key.  A batch overwrites the partitions its keys fall in, by
Spark's dynamic partition overwrite: new files are staged and take the old ones' place when the job has succeeded,
so a lost executor or a failed job leaves the table as it was.  Merging the same batch again gives the same table.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import shutil
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.incremental import trade_fetch_window
from marketlake.operators.latest import latest_per_key, merge_latest
from marketlake.operators.schema_ops import add_missing_columns
from marketlake.session import shared_dir

BUCKET, BATCH, DAY = "_bucket", "_batch", "_day"   # partition columns of keyed, key-less and delta tables
#: a table's own option: an insert replaces the partitions it has rows for, and no others
REPLACE = "OPTIONS (partitionOverwriteMode 'dynamic', compression 'zstd')"
#: what Arrow stores as Spark does
PLAIN = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.BooleanType, T.DateType, T.TimestampNTZType,
         T.DecimalType, T.BinaryType, T.StringType)
#: how many tasks list folders: one to each folder, up to 10,000, unless set
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.delete(p, True))


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """What the table's maker and its loads keep in the catalog: keys, buckets, merged_through."""
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{key}' = '{_quoted(value)}')")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def fresh_name(prefix: str) -> str:
    """A table name no other call can have."""
    return f"{prefix}_{uuid.uuid4().hex}"


def create_table(spark: SparkSession, name: str, schema: T.StructType, part: str, **props: str) -> None:
    """An empty Parquet table of the session catalog, partitioned by ``part`` (the schema's last column), with its
    files in the shared folder."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    kept = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in props.items())
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet {REPLACE} PARTITIONED BY ({part}) "
              f"LOCATION '{shared_dir(spark, name)}'" + (f" TBLPROPERTIES ({kept})" if kept else ""))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now, whichever session wrote to it."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def current(spark: SparkSession, name: str) -> DataFrame:
    """The table's own columns."""
    return read_table(spark, name).drop(BUCKET, BATCH, DAY)


def _widen(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """P25 / P26 at a load: columns the table lacks are added to it (NULL in its rows), columns the frame lacks are
    NULL in the frame; in the table's order."""
    known = read_table(spark, name).schema
    new = [f for f in df.schema.fields if f.name.lower() not in {k.name.lower() for k in known.fields}]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
        known = read_table(spark, name).schema
    return add_missing_columns(df, known).select(*known.names)


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def upsert(spark: SparkSession, batch: DataFrame, name: str, keys: list[str], order, guard: bool = False,
           buckets: int | None = None, rows_per_bucket: int = 2_000_000, progress: str | None = None,
           rows_per_task: int = 250_000, stored: bool = False) -> None:
    """U1 on a table: makes it at the first batch, then replaces the buckets the batch's keys fall in.

    The batch is written to a fresh folder, with its row count and the greatest value of ``progress`` observed on that
    very write; it is reduced to a row per key there, or with ``guard`` in the merge, which reduces the table's rows
    and the batch's alike.  The table is read through a join on the buckets of that folder, which prunes its
    partitions at run time; no bucket list comes to the driver.  The bucket count and the keys are the table's own and
    can't be changed; the count is taken from the first batch unless given.  ``progress`` (a column that later loads
    have greater values in) is kept as the table's ``merged_through``.

    A guarded merge of a ``stored`` batch (rows of files that stay as they are, a stream's micro-batch of a load table)
    reads it where it lies and writes no copy.

    A guarded merge shuffles its rows once: they are dealt by bucket, large buckets over several tasks of about
    ``rows_per_task`` rows by the key's hash, reduced where they lie and written from there."""
    seen = Observation()
    top = F.max((F.col(progress) if progress else F.lit(None)).cast("string"))
    fresh = shared_dir(spark, "upsert-batch")
    try:
        in_place = guard and stored
        if in_place:
            rows = batch
        else:
            rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"), top.alias("top"))
            rows = rows.dropna(subset=keys) if guard else latest_per_key(rows, keys, order)
            rows.write.option("compression", "zstd").parquet(fresh)
            rows = spark.read.schema(rows.schema).parquet(fresh)
        if not spark.catalog.tableExists(name):
            n = buckets or max(1, -(-rows.dropna(subset=keys).select(*keys).distinct().count() // rows_per_bucket))
            create_table(spark, name, T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())]), BUCKET,
                         keys=json.dumps(keys), buckets=str(n))
        own = properties(spark, name)
        if json.loads(own["keys"]) != list(keys) or (buckets and buckets != int(own["buckets"])):
            raise ValueError(f"{name} has {own['buckets']} buckets of {own['keys']}")
        rows = _widen(spark, rows.withColumn(BUCKET, bucket_of(keys, int(own["buckets"]))), name)
        if in_place:   # each pass over a stream's batch reads all its columns: what two plans need to know is kept
            known = F.count_if(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
            rows.groupBy(BUCKET).agg(known.alias("count"), top.alias("top")).write.parquet(fresh)
            sizes = spark.read.parquet(fresh)
            through, rows = sizes.agg(F.max("top")).first()[0], rows.dropna(subset=keys)
            touched = sizes.where(F.col("count") > 0).select(BUCKET)
        else:
            sizes, through = rows.groupBy(BUCKET).count(), seen.get["top"]
            touched = rows.select(BUCKET).where(F.col(BUCKET) >= 0).distinct()
        # as many rows as there are buckets at most, so their broadcast has a bound; it is what prunes the scan
        old = read_table(spark, name).join(F.broadcast(touched), BUCKET, "left_semi")
        if guard:
            both = old.groupBy(BUCKET).count().unionByName(sizes.select(BUCKET, "count"))
            largest = both.groupBy(BUCKET).agg(F.sum("count").alias("count")).agg(F.max("count")).first()[0] or 0
            task = F.pmod(F.xxhash64(F.lit(BUCKET), *[F.col(k) for k in keys]), F.lit(max(1, -(-largest // rows_per_task))))
            dealt = old.unionByName(rows).withColumn("_task", task).repartition(BUCKET, "_task")
            new = latest_per_key(dealt, [BUCKET, "_task", *keys], order, dealt=True)
        else:
            new = merge_latest(old, rows, keys, order, reduced=True).repartition(BUCKET)
        new.select(*rows.columns).write.insertInto(name, overwrite=True)
        if through is not None and through > own.get("merged_through", ""):
            set_property(spark, name, "merged_through", through)
    finally:
        delete(spark, fresh)


def append_batch(spark: SparkSession, df: DataFrame, name: str, batch: str) -> None:
    """A key-less load: the batch's rows are a partition named by ``batch``, so the same batch again replaces its
    own rows and nothing else."""
    df = df.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(name):
        create_table(spark, name, df.schema, BATCH)
    _widen(spark, df, name).write.insertInto(name, overwrite=True)


def _clean(df: DataFrame) -> DataFrame:
    """'' -> NULL for text; nested values -> JSON text."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t == "string":
            cols.append(F.nullif(F.col(f.name), F.lit("")).alias(f.name))
        elif t.startswith(("struct", "array", "map")):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def keyed_load(spark: SparkSession, df: DataFrame, name: str, keys: list[str] | None, order, batch: str,
               guard: bool = False, buckets: int | None = None, progress: str | None = None, stored: bool = False) -> None:
    """Create the table ``name`` on the first batch; upsert by key (U1) when keys are given, else append.
    ``batch`` names the batch of a key-less load (a stream's id and batch number, a file, a run)."""
    if keys:
        upsert(spark, _clean(df), name, keys, order, guard=guard, buckets=buckets, progress=progress, stored=stored)
    else:
        append_batch(spark, _clean(df), name, batch)


# ---- insert-mostly tables: rows by id that hardly ever change (trades) ----

def append_delta(spark: SparkSession, df: DataFrame, name: str, keys: list[str], time_col) -> None:
    """Adds a batch's rows to the folders of their days and rewrites nothing.  ``time_col`` (a column or expression)
    is a time that an id's rows all share, as a print's does: it is latest per (day, id) that is resolved."""
    rows = df.withColumn(DAY, F.to_date(F.col(time_col) if isinstance(time_col, str) else time_col))
    if not spark.catalog.tableExists(name):
        create_table(spark, name, rows.schema, DAY, keys=json.dumps(keys))
    _widen(spark, rows, name).repartition(DAY).write.insertInto(name, overwrite=False)


def resolve_delta(spark: SparkSession, name: str, order, days: tuple[str, str] | None = None) -> DataFrame:
    """W3c on read: the latest row of every id, from the days' appended versions; ``days`` prunes folders.  One
    aggregate by (day, id)."""
    rows = read_table(spark, name)
    if days:
        rows = rows.where(F.col(DAY).between(*[F.lit(x).cast("date") for x in days]))
    keys = json.loads(properties(spark, name)["keys"])
    day = F.coalesce(F.col(DAY), F.lit("0001-01-01").cast("date"))   # rows without a time are a day of their own
    return latest_per_key(rows.withColumn(DAY, day), [DAY, *keys], order).drop(DAY)


def fetch_delta(spark: SparkSession, name: str, windows: DataFrame, time_sec, order, key: str = "market_ticker") -> DataFrame:
    """J13 on a delta table: the latest version of every print inside its market's window (``windows``: key, min_ts,
    max_ts in seconds, from ``plan_trade_windows``), reading only the days that some window reaches.

    The days of all bounded windows are joined to the table's folders, which prunes them at run time; they are
    broadcast, as there are no more of them than days in the calendar between the first bound and the last.  Markets
    whose window is open on a side read all days."""
    rows = read_table(spark, name)
    bounded = windows.where(F.col("min_ts") <= F.col("max_ts"))
    day = lambda c: F.to_date(F.timestamp_seconds(F.col(c)).cast("timestamp_ntz"))
    # windows that span the same days are one row before any day is made
    days = (bounded.select(day("min_ts").alias("a"), day("max_ts").alias("z")).distinct()
            .select(F.explode(F.sequence("a", "z")).alias(DAY)).where(F.col(DAY) >= F.lit("0001-01-01").cast("date")).distinct())
    found = trade_fetch_window(rows.join(F.broadcast(days), DAY, "left_semi"), bounded, time_sec, key)
    unbounded = windows.where(F.col("min_ts").isNull() | F.col("max_ts").isNull())
    if not unbounded.isEmpty():   # else the other branch would read all days to find nothing
        found = found.unionByName(trade_fetch_window(rows, unbounded, time_sec, key))
    keys = json.loads(properties(spark, name)["keys"])
    return latest_per_key(found.drop(DAY), keys, order)


def compact_delta(spark: SparkSession, name: str, order, files: int = 2) -> list[str]:
    """Rewrites the days that lie in ``files`` files or more as one resolved version each, by dynamic partition
    overwrite; other days stay as they are.  Returns the days, of which there are as many as partitions changed."""
    rows = read_table(spark, name)
    keys = json.loads(properties(spark, name)["keys"])
    # file names are metadata: the scan reads no column
    many = (rows.select(DAY, F.input_file_name().alias("f")).where(F.col(DAY).isNotNull()).distinct()
            .groupBy(DAY).count().where(F.col("count") >= files))
    days = sorted(r[0] for r in many.select(DAY).collect())
    if days:
        due = rows.where(F.col(DAY).isin(days))
        latest_per_key(due, [DAY, *keys], order).select(*rows.columns).repartition(DAY).write.insertInto(name, overwrite=True)
    return [str(x) for x in days]


def keyless_dump(df: DataFrame, path: str) -> None:
    """Append rows to an unkeyed table, columns sorted by name."""
    df.select(*sorted(df.columns)).write.mode("append").parquet(path)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """(column, type, whether it is a key, rows that fill it) of a table of the session catalog, in the
    table's order; no rows when there is no such table.  Names and types come from the catalog, counts from one
    aggregate."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], "column_name string, data_type string, is_key boolean, filled_rows long")
    keys = json.loads(properties(spark, name).get("keys", "[]"))
    columns = [c for c in spark.catalog.listColumns(name) if not c.isPartition]
    cells = [F.struct(F.lit(c.name).alias("column_name"), F.lit(c.dataType).alias("data_type"),
                      F.lit(c.name in keys).alias("is_key"), F.col(f"n{i}").alias("filled_rows")) for i, c in enumerate(columns)]
    return read_table(spark, name).agg(*[F.count(f"`{c.name}`").alias(f"n{i}") for i, c in enumerate(columns)]).select(F.inline(F.array(*cells)))


def schema_tables(spark: SparkSession, schema: str = "default", like: str = "*") -> DataFrame:
    """S16 over a schema: (table_name, column_name, data_type, is_key) of its tables; from the catalog alone."""
    rows = []
    for t in spark.catalog.listTables(schema, like):
        if t.tableType == "TEMPORARY":
            continue
        name = f"{schema}.{t.name}"
        keys = json.loads(properties(spark, name).get("keys", "[]"))
        rows += [(t.name, c.name, c.dataType, c.name in keys) for c in spark.catalog.listColumns(name) if not c.isPartition]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, is_key boolean")


def cache_write(df: DataFrame, path: str, key: str, rows_per_file: int = 1_000_000, files_per_task: int = 100) -> None:
    """One parquet partition per event; rewriting an event replaces only that event's folder (dynamic partition
    overwrite, for this write alone).

    An event is written by as many tasks as its rows need: sizes are counted, and each event's number of salts is
    joined to its rows, so the game that holds a third of all rows is spread while every other has one file.  A row's
    salt hangs on its values, so a task that runs again deals alike.

    What a task costs is the files it opens as much as the bytes it writes, and small events are many files of few
    bytes: the number of tasks is given, from the counted files and rows, so that no task is packed by bytes alone.

    On a mounted folder (``file:``) the tasks write plain columns by ``_write_folders``: Hadoop's local file system
    starts a ``chmod`` process for every folder, file and checksum it makes, three to a small event, which is nearly
    all that an event costs there.  Other stores and other types go through Spark's writer."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_salts", F.ceil(F.col("_rows") / rows_per_file).cast("int"))
    all_ = sizes.agg(F.sum("_salts").alias("files"), F.sum("_rows").alias("rows")).first()
    tasks = max(1, -(-(all_.files or 0) // files_per_task), -(-2 * (all_.rows or 0) // rows_per_file))
    salted = df.join(sizes.select(F.col(key).alias("_event"), "_salts"), F.col(key).eqNullSafe(F.col("_event"))).drop("_event")
    salt = F.pmod(F.xxhash64(*df.columns), F.col("_salts").cast("long"))
    dealt = salted.withColumn("_salt", salt).repartition(tasks, F.col(key), F.col("_salt")).select(*df.columns)
    fs, p, _ = _fs(df.sparkSession, path)
    rest = [f for f in df.schema.fields if f.name != key]
    if fs.getUri().getScheme() == "file" and rest and all(isinstance(f.dataType, PLAIN) for f in rest):
        _write_folders(dealt, fs.makeQualified(p).toUri().getPath(), key)
    else:
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def _write_folders(df: DataFrame, path: str, key: str, rows_per_group: int = 131_072) -> None:
    """Writes ``df``'s partitions as they are dealt: a Parquet file per task and value of ``key``, in Spark's folders
    (``key=value``, its escapes, its name for NULL), and replaces the folders that get rows, no others.

    Files are written to a hidden folder beside the others, each under its task's name when it is whole, so a task that
    runs again replaces its own; folders are moved to their place when all tasks have succeeded.  A task holds one
    file's rows, ``rows_per_group`` at most."""
    spark = df.sparkSession
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    escapes = {c: f"%{c:02X}" for c in range(128) if names.needsEscaping(chr(c))}
    head, stored, token = f"{names.escapePathName(key)}=", df.drop(key).schema, uuid.uuid4().hex
    codec = spark.conf.get("spark.sql.parquet.compression.codec").lower()
    codec = codec if codec in ("gzip", "zstd") else "snappy"
    staged = f"{path}/.staged-{token}"

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        task = TaskContext.get()
        file = f"part-{task.partitionId():05d}-{token}.{codec}.parquet"
        begun, about = f"{staged}/.begun/{task.taskAttemptId()}", {"org.apache.spark.sql.parquet.row.metadata": stored.json()}
        os.makedirs(os.path.dirname(begun), exist_ok=True)
        event, part, held, files = None, None, [], 0

        def flush():
            part.write_table(pa.Table.from_batches(held))
            held.clear()

        def close():
            flush()
            part.close()
            folder = f"{staged}/{head}{event.translate(escapes)}"
            os.makedirs(folder, exist_ok=True)
            os.replace(begun, f"{folder}/{file}")

        for batch in batches:
            runs, at = pc.run_end_encode(batch.column(0)), 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                rows = batch.slice(at, end - at).select(stored.names).replace_schema_metadata(about)
                if name != event:
                    if part:
                        close()
                    event, files = name, files + 1
                    part = pq.ParquetWriter(begun, rows.schema, compression=codec, store_schema=False)
                elif sum(len(x) for x in held) + len(rows) > rows_per_group:
                    flush()
                held.append(rows)
                at = end
        if part:
            close()
        yield pa.RecordBatch.from_pydict({"files": [files]})

    event = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit(names.DEFAULT_PARTITION_NAME()))
    rows = df.select(event.alias("_event"), *stored.names).sortWithinPartitions("_event")
    try:
        os.makedirs(staged)
        rows.mapInArrow(write, "files long").agg(F.sum("files")).collect()
        for folder in (x for x in os.listdir(staged) if x.startswith(head)):
            if os.path.exists(f"{path}/{folder}"):
                os.rename(f"{path}/{folder}", f"{staged}/.was-{folder}")
            os.rename(f"{staged}/{folder}", f"{path}/{folder}")
        with open(f"{path}/_SUCCESS", "w"):
            pass
    finally:
        shutil.rmtree(staged, ignore_errors=True)
    spark.catalog.refreshByPath(path)


def cache_read(spark: SparkSession, path: str, key: str, keys: list | None = None) -> DataFrame:
    """Read the cache back with the folder name as a column; a key
    list becomes a partition filter (pruned at listing time).  Folders are
    listed here, many by each task."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 8 * spark.sparkContext.defaultParallelism)))
    try:
        df = spark.read.parquet(path)
    finally:
        spark.conf.set(LISTING, before)
    return df.filter(F.col(key).isin(keys)) if keys is not None else df


def cache_missing(expected: DataFrame, present: DataFrame, cols: list[str]) -> DataFrame:
    """Expected (event, entity) pairs with no cached partition."""
    return expected.select(*cols).distinct().join(present.select(*cols).distinct(), cols, "left_anti")


def pending_rows(load: DataFrame, name: str, progress: str) -> int:
    """T4: load rows that the merge into ``name`` has still to take: those past its ``merged_through`` in
    ``progress``, a filter that reaches the scan (and prunes folders where the column is the partition); all of them
    while there is no such table.  Loads must be given greater values than all before them."""
    spark = load.sparkSession
    through = properties(spark, name).get("merged_through") if spark.catalog.tableExists(name) else None
    if through is None:
        return load.count()
    return load.where(F.col(progress) > F.lit(through).cast(load.schema[progress].dataType)).count()


def retention_cutoff(now: dt.datetime, days: int = 2) -> str:
    """The first day that stays: the run's time less ``days`` days, a day that lies partly before it stays."""
    return (now - dt.timedelta(days=days)).date().isoformat()


def retention_cleanup(spark: SparkSession, path: str, cutoff: str, pending: int,
                      part_col: str = "ingested_date") -> list[str]:
    """T4: drop load partitions older than ``cutoff`` (YYYY-MM-DD), only when
    the merge has left nothing ``pending``.  Returns the folders removed."""
    if pending:
        return []
    gone = []
    for name in list_dirs(spark, path):
        if name.startswith(f"{part_col}=") and name.split("=", 1)[1] < cutoff:
            delete(spark, f"{path.rstrip('/')}/{name}")
            gone.append(name)
    return gone


def clean_loads(spark: SparkSession, loads: dict[str, tuple[str, str]], progress: str, now: dt.datetime, days: int = 2) -> dict[str, list[str]]:
    """T4 for every load table: {entity: (load folder, current table)} -> {entity: folders removed}.  Each table is
    held back by its own backlog only."""
    cutoff = retention_cutoff(now, days)
    out = {}
    for entity, (path, name) in loads.items():
        load = spark.read.parquet(path)
        out[entity] = retention_cleanup(spark, path, cutoff, pending_rows(load.withColumn(progress, F.col(progress).cast("string")), name, progress))
    return out
