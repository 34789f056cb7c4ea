"""JSON Lines landing and scanning.

Landing writes newline-delimited JSON under ``<path>/<entity>/ingested_date=YYYY-MM-DD``
with Spark's writer (one file per task, or several compressed ones; no driver-side serialisation).
Scanning reads text, parses each line to VARIANT with ``try_parse_json``
and pulls the typed columns with ``try_variant_get``, as one struct;
unparseable lines come back as a separate frame instead of failing the load.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# full microsecond precision for timestamps written to JSON
JSON_TIME_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# (json path, output column, Spark type)
Spec = list[tuple[str, str, str]]


def envelope(df: DataFrame, ingested_at: dt.datetime, keep_micros: bool = False) -> DataFrame:
    """Add ``raw_payload`` (the row as JSON text) and ``ingested_at``
    (UTC, whole seconds unless ``keep_micros``)."""
    ts = ingested_at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if not keep_micros:
        ts = ts.replace(microsecond=0)
    return df.select("*", F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("raw_payload"),
                     F.lit(ts).cast("timestamp_ntz").alias("ingested_at"))


def landing_path(prefix: str, source: str, entity: str, run_ts: dt.datetime) -> str:
    """The folder a run lands in: prefix/source/entity/ingested_date=YYYY-MM-DD."""
    d = run_ts.astimezone(dt.timezone.utc).strftime("%Y-%m-%d")
    return f"{prefix.rstrip('/')}/{source}/{entity}/ingested_date={d}"


def land(df: DataFrame, prefix: str, entity: str, run_ts: dt.datetime, source: str = "exchange",
         compression: str | None = None, rows_per_file: int = 10_000) -> str:
    """Write the rows as JSON Lines under the run's date folder, in a
    folder named by the run's stamp: landing a run again replaces what it
    landed, other runs of the day stay.  Keys are written in column order
    (sort the columns first for sorted keys); an empty frame still commits
    (a _SUCCESS marker, no data file).

    JSON repeats its keys in every line: ``compression`` (``gzip``, which
    every reader knows) makes .json.gz files of a tenth of the size or less.
    No reader can split those, so a task begins a new one after
    ``rows_per_file`` lines: small ones, since a scan packs up to 128 MB of
    files, at 4 MB each beside their size, in a task.  They are packed at
    gzip's fastest level, as most of the time of a write would be packing."""
    path = landing_path(prefix, source, entity, run_ts)
    stamp = run_ts.astimezone(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    # the JSON writer gives the files their .json ending
    out = df.select(*sorted(df.columns)).write.mode("overwrite").options(**JSON_TIME_OPTIONS).option("ignoreNullFields", "true")
    if compression:
        out = out.option("compression", compression).option("maxRecordsPerFile", rows_per_file).option("zlib.compress.level", "BEST_SPEED")
    out.json(f"{path}/{entity}_{stamp}")
    return path


def land_run(frames: dict[str, DataFrame], prefix: str, run_ts: dt.datetime, source: str = "exchange",
             compression: str | None = None) -> DataFrame:
    """S1 and Q13 for a whole run: lands every entity and returns (entity, rows_written).  The counts are observed on
    the landing writes themselves, so no row is read again, and are kept beside the run's folders; a run that lands
    again replaces them with its files."""
    counts = []
    for entity, df in frames.items():
        seen = Observation()
        land(df.observe(seen, F.count(F.lit(1)).alias("rows")), prefix, entity, run_ts, source, compression)
        counts.append((entity, seen.get["rows"]))
    spark = next(iter(frames.values())).sparkSession
    stamp = run_ts.astimezone(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    path = f"{prefix.rstrip('/')}/{source}/_runs/{stamp}"
    spark.createDataFrame(counts, "entity string, rows_written long").coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema("entity string, rows_written long").json(path)


# Spark lists every file that is not hidden (_ or . in front): landing files end in .json, .jsonl or .txt
ANY_FILE = "*"


def scan_lines(spark: SparkSession, path: str, glob: str = ANY_FILE) -> DataFrame:
    """Raw lines with file path and 1-based per-file row number."""
    return number_lines(spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
                        .select("value", F.col("_metadata.file_path").alias("source_file"),
                                F.col("_metadata.file_block_start").alias("_blk")))


def number_lines(lines: DataFrame) -> DataFrame:
    """Numbers the lines (value, source_file, _blk: where the line's split
    starts) of each file from 1.

    A line's number is the count of lines in earlier splits of its file plus
    its position within its own split.  The split counts are one row per
    (file, split), and a window over a file's splits turns them into
    offsets, so a huge file is numbered by as many tasks as it has splits
    instead of being sorted in one.  A split's lines are consecutive in the
    task that reads them, so ``monotonically_increasing_id`` minus the
    split's smallest id is the position; the split-to-task layout is fixed
    by the file listing, so a recomputed task yields the same ids.

    The offsets are broadcast, so no line is shuffled: they have a row per
    split, as many as the driver plans the scan from."""
    lines = lines.withColumn("_pos", F.monotonically_increasing_id())
    splits = lines.groupBy("source_file", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0"))
    earlier = Window.partitionBy("source_file").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("source_file", "_blk", "_p0",
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(F.broadcast(offsets), ["source_file", "_blk"], "inner").select(
        "value", "source_file",
        (F.col("_before") + F.col("_pos") - F.col("_p0") + 1).cast("bigint").alias("source_row_number"))


# how a kind of value is pulled from the payload where it is no Spark type itself
PULLED = {"number": "string", "time": "string", "json": "variant"}


def _value(v: Column, kind: str) -> Column:
    """A payload value as it was pulled: a Spark type as it is (``variant``:
    any value, stored as VARIANT and read by path), ``number`` and ``time``
    from text (bad text is NULL), ``json`` any value as JSON text."""
    return {"number": lambda: v.try_cast("decimal(38,0)"), "time": lambda: v.try_cast("timestamp_ntz"),
            "json": lambda: F.to_json(v)}.get(kind, lambda: v)()


def _pulled(doc: Column, wanted: list[tuple[str, str]]) -> tuple[Column, list[Column]]:
    """(the payload's values as one struct column, named ``_s`` by the caller;
    the wanted values) for (path, Spark type) pairs.

    Top-level keys are fields of a single ``try_variant_get``, which walks the
    payload once.  Other paths, and a key that is wanted as two types or that
    differs from another in case alone, are pulled one by one beside it."""
    fields: dict[str, tuple[str, str]] = {}
    single: dict[tuple[str, str], str] = {}
    values = []
    for path, kind in wanted:
        key = path.removeprefix("$.")
        if re.fullmatch(r"[A-Za-z_]\w*", key) and path.startswith("$.") and fields.setdefault(key.lower(), (key, kind)) == (key, kind):
            values.append(F.col("_s").getField("top").getField(key))
        else:
            values.append(F.col("_s").getField(single.setdefault((path, kind), f"p{len(single)}")))
    top = F.try_variant_get(doc, "$", f"struct<{', '.join(f'`{k}`: {t}' for k, t in fields.values())}>")
    return F.struct(top.alias("top"), *[F.try_variant_get(doc, p, t).alias(n) for (p, t), n in single.items()]), values


def parse_lines(lines: DataFrame, spec: Spec, key_alias: tuple[str, str, str] | None = None,
                seen: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of raw lines, for batch and stream alike.

    A line is good when it is a JSON object; everything else (broken text,
    arrays, bare values) is a bad line and keeps its text and place.
    ``raw_payload`` is the payload's own when present, else the whole line.
    ``key_alias`` (out, path1, path2) coalesces two key spellings (S6).  A
    payload's own ``source_file`` or ``source_row_number`` keeps its name;
    the landing file's are then ``landing_file`` and ``landing_row_number``.

    A line is parsed once: the values hang on a row id, so that no filter on
    them is pushed below them as a second parse.  ``seen`` observes the number
    of ``bad`` lines on the good rows' own pass."""
    doc = F.try_parse_json(F.col("value"))
    # what parses and begins with a brace is an object (JSON's own white space may precede it)
    brace = F.ltrim(F.col("value"), F.lit(" \t\r\n")).startswith("{")
    audit = [c for c in ("source_file", "source_row_number") if c in lines.columns]
    names = {out for _, out, _ in spec}
    paths = [(p, PULLED.get(kind, kind)) for p, _, kind in spec] + [("$.raw_payload", "string")]
    struct, values = _pulled(doc, paths + [(p, "string") for p in (key_alias or ())[1:]])
    cols: list[Column] = [_value(v, kind).alias(out) for v, (_, out, kind) in zip(values, spec)]
    if key_alias is not None:
        cols.append(F.coalesce(*values[-2:]).alias(key_alias[0]))
    payload = F.coalesce(values[len(spec)], F.col("value"))
    place = [F.col(c).alias(c.replace("source", "landing") if c in names else c) for c in audit]
    parsed = lines.select("value", *audit, F.when(brace & (F.monotonically_increasing_id() >= 0), struct).alias("_s"))
    is_object = F.col("_s").getField("top").isNotNull()
    if seen is not None:
        parsed = parsed.observe(seen, F.count_if(F.coalesce(~is_object, F.lit(True))).alias("bad"))
    good = parsed.filter(is_object).select(*cols, payload.alias("raw_payload"), *place,
                                           F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"))
    return good, lines.filter(~F.coalesce(brace & doc.isNotNull(), F.lit(False))).select(*audit, "value")


def scan_jsonl(spark: SparkSession, path: str, spec: Spec, glob: str = ANY_FILE,
               key_alias: tuple[str, str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """JSONL -> typed load columns + audit columns (S10), and the bad lines."""
    return parse_lines(scan_lines(spark, path, glob), spec, key_alias)


def flatten_records(df: DataFrame, json_col: str) -> DataFrame:
    """A JSON array of records (objects, or arrays of objects one level
    down) -> one VARIANT object per row; other items are dropped."""
    spark = df.sparkSession
    docs = df.select(F.try_parse_json(F.col(json_col)).alias("_doc"))
    top = docs.lateralJoin(spark.tvf.variant_explode(F.col("_doc").outer())).select(F.col("value").alias("v"))
    obj = F.expr("schema_of_variant(v)").startswith("OBJECT")
    arr = F.expr("schema_of_variant(v)").startswith("ARRAY")
    direct = top.filter(obj)
    inner = top.filter(arr).lateralJoin(spark.tvf.variant_explode(F.col("v").outer())) \
               .select(F.col("value").alias("v2"))
    nested = inner.filter(F.expr("schema_of_variant(v2)").startswith("OBJECT")).select(F.col("v2").alias("v"))
    return direct.unionByName(nested).withColumnRenamed("v", "record")


def flatten_team(df: DataFrame, json_col: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """S3: nested sport / league / division / venue {id, name} -> 18 flat
    columns; a non-object parent gives NULLs.  ``keep`` carries other
    columns of the row (audit columns) through the same projection."""
    v = F.expr(f"try_parse_json({json_col})")
    g = lambda p, t: F.try_variant_get(v, p, t)
    cols = [g("$.id", "bigint").alias("team_id"), g("$.name", "string").alias("name"),
            g("$.teamCode", "string").alias("team_code"), g("$.abbreviation", "string").alias("abbreviation"),
            g("$.teamName", "string").alias("team_name"), g("$.locationName", "string").alias("location_name"),
            g("$.firstYearOfPlay", "string").alias("first_year_of_play"), g("$.active", "boolean").alias("active")]
    for parent in ("sport", "league", "division", "venue"):
        cols.append(g(f"$.{parent}.id", "bigint").alias(f"{parent}_id"))
        cols.append(g(f"$.{parent}.name", "string").alias(f"{parent}_name"))
    return df.select(*cols, F.col(json_col).alias("raw_payload"), *keep)
