"""Scope selection and ticker parsing.

Argument rules are checked on the driver (they concern parameters, not
data); every row-level step is a filter or column expression that Catalyst
pushes toward the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timecols import EASTERN, to_utc


def scope_filter(df: DataFrame, market=None, event=None, series=None, market_col="market_ticker",
                 event_col="event_ticker", series_col="series_ticker", require_one: bool = True) -> DataFrame:
    """Keep one market, event or series (a value or a list).  Exactly one
    scope may be given when ``require_one``."""
    given = [(v, c) for v, c in ((market, market_col), (event, event_col), (series, series_col)) if v is not None]
    if require_one and len(given) != 1:
        raise ValueError("exactly one of market, event or series must be given")
    for v, c in given:
        df = df.filter(F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return df


def status_filter(df: DataFrame, status: str | None = "open", scoped: bool = False,
                  col: str = "status") -> DataFrame:
    """P10: default ``open``; ``all`` or empty removes the filter, and then a
    scope must have been applied."""
    if status is None or status.strip().lower() in ("", "all"):
        if not scoped:
            raise ValueError("status 'all' needs an event, series or market scope")
        return df
    return df.filter(F.col(col) == status)


def series_scope(series: DataFrame, category: str, tag: str, like: str, titles: list[str]) -> DataFrame:
    """Category equality, exact tag membership, ticker LIKE and title IN
    (all must hold).  Tag membership here is case-sensitive, as in the SQL."""
    return series.filter((F.col("category") == category) & F.array_contains(F.col("tags"), tag)
                         & F.col("ticker").like(like) & F.col("title").isin(titles))


def tags_match_all(series: DataFrame, tags: list[str], col: str = "tags") -> DataFrame:
    """Every wanted tag appears in the row's tags, case-folded; a NULL
    (non-list) tag value never matches."""
    wanted = F.array(*[F.lit(t.lower()) for t in tags])
    have = F.transform(F.col(col), lambda t: F.lower(t))
    ok = F.forall(wanted, lambda w: F.exists(have, lambda h: h == w))
    return series.filter(F.col(col).isNotNull() & ok)


def ticker_date(ticker: Column) -> Column:
    """yyMMMdd date encoded after the first '-' (NULL when it does not parse)."""
    code = F.upper(F.substring(F.split_part(ticker, F.lit("-"), F.lit(2)), 1, 7))
    return F.try_to_timestamp(code, F.lit("yyMMMdd")).cast("date")


def active_slate(events: DataFrame, series: list[str], day, col: str = "event_ticker",
                 series_col: str = "series_ticker") -> DataFrame:
    """Events of the given series whose ticker encodes ``day`` (a date
    string or Column; pass 'today in Eastern' from the caller)."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    return (events.filter(F.col(series_col).isin(series))
                  .filter(ticker_date(F.col(col)) == d).select(col))


def scope_keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-empty keys (ordered by key when collected)."""
    return df.filter(F.col(col).isNotNull() & (F.trim(F.col(col)) != "")).select(col).distinct()


def parse_event_ticker(df: DataFrame, col: str = "event_ticker") -> DataFrame:
    """P15 + P17: series, yyMMMdd date code, HHmm start (Eastern), team codes,
    and the start instant as UTC wall clock."""
    k = F.col(col)
    body = F.split_part(k, F.lit("-"), F.lit(2))
    local = F.try_to_timestamp(F.upper(F.substring(body, 1, 11)), F.lit("yyMMMddHHmm")).cast("timestamp_ntz")
    return df.select(
        "*",
        F.split_part(k, F.lit("-"), F.lit(1)).alias("series_code"),
        F.substring(body, 1, 7).alias("date_code"),
        F.substring(body, 8, 4).alias("start_hhmm"),
        F.expr(f"substr(split_part({col}, '-', 2), 12)").alias("team_codes"),
        local.alias("game_start_et"),
        to_utc(local, EASTERN).alias("game_start_utc"))


def contract_team_code(col: str = "market_ticker") -> Column:
    """Text after the last '-'."""
    return F.substring_index(F.col(col), "-", -1)


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text -> double (bad text -> NULL); absent columns are skipped."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, F.expr(f"try_cast(`{c}` as double)"))
    return df


def market_spec(markets: DataFrame, trades: DataFrame, market: str, side: str | None = None,
                key: str = "market_ticker") -> tuple[DataFrame, DataFrame]:
    """The static row and the full print list of one market, optionally
    one taker side."""
    t = trades.filter(F.col(key) == market)
    if side is not None:
        t = t.filter(F.col("taker_side") == side)
    return markets.filter(F.col(key) == market), t
