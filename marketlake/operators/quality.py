"""Data-quality checks (Q1-Q13).  Each returns the failing rows (or a
count); an empty result means the check passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q1."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Q2: non-NULL values that occur more than once."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q3: child rows whose key is missing from the parent; NULL keys pass."""
    p = parent.select(F.col(parent_col).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(p, col, "left_anti")


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Q4: NULL passes."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(values))


def accepted_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Q5: inclusive bounds; NULL passes."""
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (F.col(col) < lo)
    if hi is not None:
        cond = cond | (F.col(col) > hi)
    return df.filter(cond)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q6: key groups with more than one row, with the count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def load_freshness(tables: dict[str, DataFrame], loaded_col: str) -> DataFrame:
    """Q7: row count and latest load time per table (one aggregate each)."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.max(loaded_col).alias("latest_loaded_at")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """Q8: number of rows with a NULL key."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def column_contract(df: DataFrame, expected: list[str]) -> list[str]:
    """Q9: differences between the frame's columns and the contract (in
    order); empty when they match.  Schema only, no job runs."""
    got = list(df.columns)
    if got == list(expected):
        return []
    missing = [c for c in expected if c not in got]
    extra = [c for c in got if c not in expected]
    out = [f"missing {c}" for c in missing] + [f"unexpected {c}" for c in extra]
    if not out:
        out.append("order differs")
    return out


def contract_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """Q9: the findings of ``column_contract`` with the number of rows each
    concerns: all rows for a missing column or the order, the rows with a
    value for an unexpected one.  One aggregate."""
    found = column_contract(df, expected)
    if not found:
        return df.sparkSession.createDataFrame([], "problem string, affected_rows long")
    n = [F.count(p.split(" ", 1)[1]) if p.startswith("unexpected ") else F.count(F.lit(1)) for p in found]
    cells = [F.struct(F.lit(p).alias("problem"), F.col(f"n{i}").alias("affected_rows")) for i, p in enumerate(found)]
    return df.agg(*[c.alias(f"n{i}") for i, c in enumerate(n)]).select(F.inline(F.array(*cells)))


def single_row(df: DataFrame, key: str) -> DataFrame:
    """Q10: keys whose scoped lookup does not return exactly one row."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") != 1)


def window_bounds(t: DataFrame, key: str = "market_id", start: str = "game_start",
                  time_col: str = "trade_time") -> DataFrame:
    """Q11: markets whose start is not strictly inside the observed range."""
    s = t.groupBy(key).agg(F.min(time_col).alias("first_trade_time"), F.max(time_col).alias("last_trade_time"),
                           F.min(start).alias(start))
    return s.filter(~((F.col("first_trade_time") < F.col(start)) & (F.col(start) < F.col("last_trade_time"))))


def price_complement(t: DataFrame, yes: str, no: str, tol: float = 0.01) -> DataFrame:
    """Q12: prints where YES + NO is off 1 by more than ``tol``."""
    return t.filter(F.abs(F.col(yes) + F.col(no) - 1) > tol)


def run_row_counts(df: DataFrame, entity_col: str) -> DataFrame:
    """Q13: rows written per entity in a run."""
    return df.groupBy(entity_col).agg(F.count(F.lit(1)).alias("rows_written"))


# ---- suites: all rules of a table in one scan ----

@dataclass(frozen=True)
class Rule:
    """A rule of a table.  ``kind`` and its arguments: not_null (columns), accepted_values (columns[0], values),
    accepted_range (columns[0], lo, hi), holds (condition: a SQL expression that fails where it is false),
    unique (columns: no combination without NULL twice), relationship (columns[0] is in ``parent``'s column ``parent_column``)."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    lo: object = None
    hi: object = None
    condition: str = ""
    parent: str = ""
    parent_column: str = ""

    @property
    def name(self) -> str:
        return f"{self.table}.{self.kind}({self.condition or ', '.join(self.columns)})"

    def fails(self) -> Column:
        """Whether a row breaks a rule on rows; NULL passes all but not_null."""
        c = F.col(self.columns[0]) if self.columns else None
        bad = {"not_null": lambda: reduce(lambda x, y: x | y, [F.col(n).isNull() for n in self.columns]),
               "accepted_values": lambda: ~c.isin(list(self.values)),
               "accepted_range": lambda: reduce(lambda x, y: x | y, [*([c < self.lo] if self.lo is not None else []), *([c > self.hi] if self.hi is not None else []), F.lit(False)]),
               "holds": lambda: ~F.expr(self.condition)}[self.kind]()
        return F.coalesce(bad, F.lit(False))


KEYED = ("unique", "relationship")


def _key(columns: tuple[str, ...]) -> Column:
    """A key as text; NULL if a part is."""
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)])) if len(columns) > 1 else F.col(columns[0]).cast("string")
    return F.when(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns]), text)


def scan_rules(df: DataFrame, rules: list[Rule], referred: set[tuple[str, ...]] = frozenset()) -> DataFrame:
    """(slot, key, n, f0, f1, ...): what one scan of a table tells of its rules.

    Slot -1 has the failing rows of each rule on rows; other slots have a row per distinct key of a keyed rule, or of
    a column set that another table refers to.  A row of the table becomes a small row per slot, and the aggregate
    reduces them before the shuffle: slot -1 and frequent keys are a row per task."""
    own = [r for r in rules if r.kind not in KEYED]
    sets = key_sets(rules, referred)
    flags = [r.fails().cast("int") for r in own]
    cells = [F.struct(F.lit(-1).alias("slot"), F.lit(None).cast("string").alias("key"), *[x.alias(f"f{i}") for i, x in enumerate(flags)])]
    cells += [F.struct(F.lit(i).alias("slot"), _key(c).alias("key"), *[F.lit(None).cast("int").alias(f"f{j}") for j in range(len(flags))])
              for i, c in enumerate(sets)]
    rows = df.select(F.inline(F.array(*cells)))
    return rows.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"f{i}").alias(f"f{i}") for i in range(len(flags))])


def key_sets(rules: list[Rule], referred: set[tuple[str, ...]]) -> list[tuple[str, ...]]:
    return sorted({r.columns for r in rules if r.kind in KEYED} | set(referred))


def run_suite(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(rule, checked_rows, failing): every rule over its table, each table scanned once.

    failing counts rows, for unique the key combinations that occur more than once.  The scans' results are stored
    (a row per distinct key) and read by all rules of the table and by the relationships that refer to it."""
    by_table = {t: [r for r in rules if r.table == t] for t in tables}
    referred = {t: {(r.parent_column,) for r in rules if r.kind == "relationship" and r.parent == t} for t in tables}
    facts = {t: materialize(scan_rules(df, by_table[t], referred[t])) for t, df in tables.items() if by_table[t] or referred[t]}
    out = []
    for t, own in by_table.items():
        if not own:
            continue
        sets, f = key_sets(own, referred[t]), facts[t]
        on_rows = [r for r in own if r.kind not in KEYED]
        doubled = {r: F.count_if((F.col("slot") == sets.index(r.columns)) & F.col("key").isNotNull() & (F.col("n") > 1)) for r in own if r.kind == "unique"}
        sums = {r: F.coalesce(F.sum(F.when(F.col("slot") == -1, F.col(f"f{i}"))), F.lit(0)) for i, r in enumerate(on_rows)}
        total = F.coalesce(F.sum(F.when(F.col("slot") == -1, F.col("n"))), F.lit(0))
        found = {**sums, **doubled}
        cells = [F.struct(F.lit(r.name).alias("rule"), total.cast("long").alias("checked_rows"), c.cast("long").alias("failing")) for r, c in found.items()]
        if cells:
            out.append(f.agg(F.array(*cells).alias("c")).select(F.inline("c")))
        for r in own:
            if r.kind == "relationship":
                parent = facts[r.parent]
                known = parent.where(F.col("slot") == key_sets(by_table[r.parent], referred[r.parent]).index((r.parent_column,))).select(F.col("key").alias("known"))
                keys = f.where((F.col("slot") == sets.index(r.columns)) | (F.col("slot") == -1))
                lost = (F.col("slot") >= 0) & F.col("key").isNotNull() & F.col("known").isNull()
                out.append(keys.join(known, F.col("key") == F.col("known"), "left")
                           .agg(total.cast("long").alias("checked_rows"), F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("failing"))
                           .select(F.lit(r.name).alias("rule"), "checked_rows", "failing"))
    return reduce(DataFrame.unionByName, out)


def failing_rows(tables: dict[str, DataFrame], rule: Rule) -> DataFrame:
    """The rows (for unique the keys and their count) that break a rule: fetched for rules that failed only."""
    df = tables[rule.table]
    if rule.kind == "unique":
        return duplicate_keys(df.dropna(subset=list(rule.columns)), list(rule.columns))
    if rule.kind == "relationship":
        return relationship(df, rule.columns[0], tables[rule.parent], rule.parent_column)
    return df.filter(rule.fails())
