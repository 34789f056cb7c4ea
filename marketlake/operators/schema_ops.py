"""Schema inference and evolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.latest import column_set_diff


# The type a column gets whose values are all of one kind.
TYPE_OF_KIND = {"str": "VARCHAR", "float": "FLOAT", "bool": "BOOLEAN", "dict": "VARIANT", "list": "VARIANT", "datetime": "TIMESTAMP_NTZ",
                "date": "DATE", "time": "TIME", "bytes": "BINARY", "uuid": "VARCHAR(36)"}
# how a JSON text spells a value that is no JSON kind of its own: the pattern says that it looks like one, the cast
# (None: no cast needed) that it is one
_DATE, _TIME = r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?"
_SPELT = [("datetime", f"^{_DATE}[T ]{_TIME}(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?$", "timestamp"), ("date", f"^{_DATE}$", "date"),
          ("time", f"^{_TIME}$", "time"), ("uuid", "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", None)]


def _kind(v: str, temporal: bool):
    s = F.expr(f"schema_of_variant({v})")
    text = F.expr(f"try_variant_get({v}, '$', 'string')")
    spelt = F.lit("str")
    for kind, pattern, cast in reversed(_SPELT if temporal else []):
        looks = text.rlike(pattern)
        if cast == "time":   # TIME is not a type of every session: a time is what makes a timestamp behind a day
            looks = looks & F.concat(F.lit("2000-01-01 "), text).try_cast("timestamp").isNotNull()
        elif cast:
            looks = looks & text.try_cast(cast).isNotNull()
        spelt = F.when(looks, F.lit(kind)).otherwise(spelt)
    # a decimal without a fraction that BIGINT can't hold is an integer of more than 64 bits
    wide = s.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$") & F.expr(f"try_variant_get({v}, '$', 'bigint')").isNull()
    return (F.when((s == "BIGINT") | wide, F.lit("int")).when(s.startswith("DECIMAL") | (s == "DOUBLE") | (s == "FLOAT"), F.lit("float"))
            .when(s == "STRING", spelt).when(s == "BOOLEAN", F.lit("bool"))
            .when(s.startswith("OBJECT"), F.lit("dict")).when(s.startswith("ARRAY"), F.lit("list"))
            .when(s.startswith("TIMESTAMP"), F.lit("datetime")).when(s == "DATE", F.lit("date")).when(s == "BINARY", F.lit("bytes"))
            .when(s == "UUID", F.lit("uuid")).when(s == "VOID", F.lit(None)).otherwise(F.lit("str")))


def infer_column_types(df: DataFrame, json_col: str, temporal: bool = True) -> DataFrame:
    """Warehouse type per key over every JSON object of ``json_col``.

    Each object is exploded to (key, value); one aggregate per key gathers the set of value kinds (bounded: there are
    eleven) and the integer range; the type is then a CASE over those facts: no value -> VARCHAR; integers alone ->
    SMALLINT / INTEGER / BIGINT by range; one other kind -> its type; integers and floats -> FLOAT; texts beside
    numbers -> VARCHAR; texts beside one temporal kind -> that kind's type; other mixes -> VARCHAR.

    JSON has no temporal kinds: with ``temporal`` a text that spells a day, a time, an instant or a UUID, and is a
    valid one, is of that kind.  Integers of up to 38 digits are told from floats; longer ones count as floats."""
    docs = df.select(F.try_parse_json(F.col(json_col)).alias("_doc"))
    kv = docs.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_doc").outer())) \
             .select("key", F.col("value").alias("v")) \
             .select("key", _kind("v", temporal).alias("kind"), F.try_variant_get("v", "$", "decimal(38,0)").alias("iv"))
    return column_types(kv, "key")


def column_types(kinds: DataFrame, key: str) -> DataFrame:
    """The lattice of P23 over rows (key, kind, iv): iv is the value where the kind is int."""
    agg = kinds.groupBy(key).agg(F.collect_set("kind").alias("kinds"),
                                 F.min(F.when(F.col("kind") == "int", F.col("iv"))).alias("lo"),
                                 F.max(F.when(F.col("kind") == "int", F.col("iv"))).alias("hi"))
    k = F.col("kinds")
    within = lambda n: (F.col("lo") >= -(1 << n)) & (F.col("hi") < (1 << n))
    subset = lambda *xs: F.forall(k, lambda e: e.isin(list(xs)))
    typ = F.when(F.size(k) == 0, F.lit("VARCHAR"))
    typ = typ.when(subset("int"), F.when(within(15), F.lit("SMALLINT")).when(within(31), F.lit("INTEGER")).otherwise(F.lit("BIGINT")))
    for kind, name in TYPE_OF_KIND.items():
        typ = typ.when(subset(kind), F.lit(name))
    typ = typ.when(subset("int", "float"), F.lit("FLOAT")).when(subset("str", "int", "float"), F.lit("VARCHAR"))
    for kind in ("datetime", "date", "time"):
        typ = typ.when(subset(kind, "str"), F.lit(TYPE_OF_KIND[kind]))
    return agg.select(F.col(key).alias("column_name"), typ.otherwise(F.lit("VARCHAR")).alias("data_type"))


def union_columns(frames: list[DataFrame]) -> DataFrame:
    """Union of all columns, absent -> NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def schema_drift(df: DataFrame, known: list[str]) -> list[tuple[str, str]]:
    """P25: (column, 'added' | 'removed') between a frame and a table's
    column list (case-insensitive).  Schema only."""
    added, removed = column_set_diff([c.lower() for c in df.columns], [c.lower() for c in known])
    return sorted([(c, "added") for c in added] + [(c, "removed") for c in removed])


def drift_report(df: DataFrame, known: list[str]) -> DataFrame:
    """P25 with the number of rows that fill each added column (0 for a
    removed one), from one aggregate."""
    drift = schema_drift(df, known)
    if not drift:
        return df.sparkSession.createDataFrame([], "column_name string, change string, filled_rows long")
    counts = [F.count(c) if change == "added" else F.lit(0).cast("long") for c, change in drift]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"f{i}") for i, c in enumerate(counts)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit(change).alias("change"), F.col(f"f{i}").alias("filled_rows"))
             for i, (c, change) in enumerate(drift)]
    return one.select(F.inline(F.array(*cells)))


def apply_drift_policy(df: DataFrame, known_schema: T.StructType, policy: str = "evolve") -> tuple[str, DataFrame]:
    """P25 policy: ``rebuild`` (reference behaviour: any difference drops and
    recreates the table) or ``evolve`` (add the new columns, keep history)."""
    drift = schema_drift(df, [f.name for f in known_schema.fields])
    if not drift:
        return "unchanged", df
    if policy == "rebuild":
        return "rebuild", df
    return "evolve", add_missing_columns(df, known_schema)


def add_missing_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """Declared columns the frame lacks become typed NULLs; extra
    frame columns are kept after them (additive evolution)."""
    cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields]
    extra = [c for c in df.columns if c not in {f.name for f in target.fields}]
    return df.select(*cols, *extra)
