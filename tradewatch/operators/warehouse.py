"""Star-schema warehouse tables.

The surveyed loader pulled each day through pandas into MySQL. Here the
warehouse is a set of day-partitioned tables written by Spark (see
:mod:`tradewatch.sources.layers`); the functions below build their rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.functions import date_id, day_of_week, round_to_second
from tradewatch.schemas import (
    DIM_DATE,
    DIM_TIME_WINDOW,
    FACT_PUMP_DUMP_CONTRACT,
    FACT_TRADES_CONTRACT,
    FACT_WASH_CONTRACT,
    SEVERITIES,
    project_to,
    symbol_keys,
)

# First day and length of the surveyed dim_date seed (400 days,
# 2026-01-01 .. 2027-02-04).
SEED_START = date(2026, 1, 1)
SEED_DAYS = 400
SEED_END = date(2029, 12, 31)


def _dim_rows(days: DataFrame, col: str = "full_date") -> DataFrame:
    d = F.col(col)
    out = days.select(
        date_id(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week(d).alias("day_of_week"),
        (day_of_week(d) >= 5).alias("is_weekend"),
    )
    return project_to(out, DIM_DATE)


def dim_date(
    spark: SparkSession, start: date = SEED_START, n_days: int = SEED_DAYS, end: date | None = SEED_END
) -> DataFrame:
    """``n_days`` consecutive days from ``start``, none after ``end``."""
    days = spark.range(0, n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    if end is not None:
        days = days.where(F.col("full_date") <= F.lit(end))
    return _dim_rows(days)


def dim_date_for(df: DataFrame, day_col: str) -> DataFrame:
    """dim_date rows of the days present in ``df`` (one aggregate, one row per day)."""
    return _dim_rows(df.select(F.col(day_col).cast("date").alias("full_date")).where("full_date IS NOT NULL").distinct())


def dim_date_span(df: DataFrame, day_col: str) -> DataFrame:
    """dim_date rows of every day from the first to the last day of ``df``."""
    span = df.agg(F.min(F.col(day_col).cast("date")).alias("lo"), F.max(F.col(day_col).cast("date")).alias("hi"))
    days = span.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    return _dim_rows(days)


def dim_date_upsert(existing: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Rows of ``new_rows`` whose date_id is not yet in ``existing`` (INSERT IGNORE).

    dim_date has one row per calendar day, so ``existing`` is small by
    construction; Spark broadcasts it when its measured size is under the
    threshold and sort-merges otherwise.
    """
    return new_rows.join(existing.select("date_id"), "date_id", "left_anti")


SEED_BLOCK = "seed"


def calendar_blocks(days: DataFrame) -> DataFrame:
    """dim_date rows of ``days`` (dim_date's schema) with the ``block`` that stores them: the seed's, else the day's own.

    A date's block and the block's whole contents are functions of the date alone, whatever is
    stored already. So a load never has to add to what another load writes: blocks are written
    whole, and two loads that start from the same state write the same blocks with the same rows.
    """
    last = SEED_START + timedelta(days=SEED_DAYS - 1)
    seeded = F.col("full_date").between(F.lit(SEED_START), F.lit(min(last, SEED_END)))
    own = F.concat(F.lit("d"), F.col("date_id").cast("string"))
    return days.withColumn("block", F.when(seeded, F.lit(SEED_BLOCK)).otherwise(own))


def dim_time_window(days: DataFrame, day_col: str = "trade_date", minutes: int = 5) -> DataFrame:
    """Every window of ``minutes`` of the given days (declared, never filled upstream).

    ``window_id`` is ``date_id * 1000 + slot of the day``: unique and stable
    across re-runs, unlike an auto-increment.
    """
    per_day = 24 * 60 // minutes
    d = days.select(F.col(day_col).cast("date").alias("d")).where("d IS NOT NULL").distinct()
    slots = d.select("d", F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("slot"))
    start = F.timestamp_add("MINUTE", F.col("slot") * minutes, F.col("d").cast("timestamp_ntz"))
    out = slots.select(
        (date_id("d").cast("long") * 1000 + F.col("slot")).alias("window_id"),
        start.alias("window_start"),
        F.timestamp_add("MINUTE", F.lit(minutes), start).alias("window_end"),
        F.lit(minutes).alias("window_size_minutes"),
        F.hour(start).alias("hour_of_day"),
    )
    return project_to(out, DIM_TIME_WINDOW)


def _contract(df: DataFrame, contract) -> DataFrame:
    """The contract's columns; a value that its decimal type cannot hold (too large, NaN) becomes NULL,
    which :func:`contract_violations` counts. A ``symbol`` stays, as the table's last column."""
    cols: list[Column] = [F.col(c).try_cast(t).alias(c) if t is not None else F.col(c) for c, t in contract]
    return df.select(*cols, *symbol_keys(df))


def fact_trades(silver: DataFrame, round_datetime: bool = False) -> DataFrame:
    """The 11 fact_trades columns with warehouse decimals.

    ``round_datetime`` stores ``trade_time`` as a DATETIME without fraction
    would (half-up to the second, T16); by default microseconds are kept.
    """
    df = silver.withColumn("date_id", date_id("processed_date"))
    if round_datetime:
        df = df.withColumn("trade_time", round_to_second("trade_time"))
    return _contract(df, FACT_TRADES_CONTRACT)


def fact_pump_dump(events: DataFrame) -> DataFrame:
    return _contract(events, FACT_PUMP_DUMP_CONTRACT)


def fact_wash_pairs(pairs: DataFrame) -> DataFrame:
    return _contract(pairs, FACT_WASH_CONTRACT)


def contract_violations(fact: DataFrame, day_col: str, key: str | None = None) -> DataFrame:
    """Per day: rows, rows with a NULL in any column (NOT NULL contract), bad severities, and
    ``duplicate_keys``, the surplus rows of keys found more than once on any days, counted on
    the last of them (NULL keys are NULL violations only). ``nulls`` maps a column to its NULLs.
    With a ``symbol`` column days and keys are one symbol's.
    """
    own = symbol_keys(fact)
    any_null = F.lit(False)
    for c in fact.columns:
        any_null = any_null | F.col(c).isNull()
    counts = F.create_map(*[x for c in fact.columns for x in (F.lit(c), F.count_if(F.col(c).isNull()))])
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("null_violations"), counts.alias("nulls")]
    if "severity" in fact.columns:
        aggs.append(F.count_if(~F.col("severity").isin(*SEVERITIES)).alias("enum_violations"))
    per_day = fact.groupBy(day_col, *own).agg(*aggs)
    if key is None:
        return per_day
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key, *own).agg(F.count(F.lit(1)).alias("n"), F.max(day_col).alias("__day"))
    surplus = per_key.groupBy("__day", *[F.col(c).alias(f"__{c}") for c in own]).agg(F.sum(F.col("n") - 1).alias("duplicate_keys"))
    same = per_day[day_col].eqNullSafe(surplus["__day"])
    for c in own:
        same = same & per_day[c].eqNullSafe(surplus[f"__{c}"])
    return per_day.join(surplus, same, "left").drop("__day", *[f"__{c}" for c in own]).fillna(0, ["duplicate_keys"])


def key_words(fact: DataFrame, day_col: str, key: str) -> DataFrame:
    """Registry of a fact's keys: per (symbol, day) and run of 64 keys, ``word`` = key div 64 and the bits of those present.

    Exact, and small where keys are dense: the ids of one day's trades mostly follow one another, so
    64 of them share a row. Bits are combined map-side; sorted by ``word`` once written, Parquet's
    statistics narrow later reads. NULL keys are left out.
    """
    k = F.col(key)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    rows = fact.where(k.isNotNull()).select(*symbol_keys(fact), day_col, F.shiftright(k, 6).alias("word"), bit.alias("bit"))
    return rows.groupBy(*symbol_keys(fact), day_col, "word").agg(F.bit_or("bit").alias("bits"))


def key_ranges(words: DataFrame, day_col: str) -> DataFrame:
    """Per (symbol, day) of a registry: the number of keys, and the least and greatest word."""
    return words.groupBy(*symbol_keys(words), day_col).agg(
        F.sum(F.bit_count("bits")).alias("n"), F.min("word").alias("least"), F.max("word").alias("greatest")
    )


def loaded_keys(words: DataFrame, known: DataFrame, day_col: str) -> DataFrame:
    """Per (symbol, day) of ``words``: the keys that ``known``, the registry of other days, already has. Days without any are left out."""
    own = symbol_keys(words)
    others = known.groupBy(*own, "word").agg(F.bit_or("bits").alias("theirs"))
    both = F.bit_count(F.col("bits").bitwiseAND(F.col("theirs")))
    met = words.join(others, [*own, "word"]).groupBy(*own, day_col).agg(F.sum(both).alias("loaded_keys"))
    return met.where("loaded_keys > 0")


class ContractError(ValueError):
    pass


def _named(row, day_col: str) -> str:
    return f"{row['symbol']} {row[day_col]}" if "symbol" in row else str(row[day_col])


def enforce_contract(name: str, fact: DataFrame, day_col: str, key: str | None = None, loaded: DataFrame | None = None) -> None:
    """Raises a :class:`ContractError` that names table, day, column and count of every violation (one row per day
    and symbol). ``loaded`` are the rows of :func:`loaded_keys`."""
    bad = []
    for r in contract_violations(fact, day_col, key).orderBy(day_col, *symbol_keys(fact)).collect():
        day = _named(r, day_col)
        bad += [f"{name} {day}: {n} rows without a valid {c}" for c, n in sorted(r["nulls"].items()) if n]
        for what in ("enum_violations", "duplicate_keys"):
            if what in r and r[what]:
                bad.append(f"{name} {day}: {r[what]} {what.replace('_', ' ')}")
    if loaded is not None:
        bad += [f"{name} {_named(r, day_col)}: {r.loaded_keys} keys are loaded already" for r in loaded.collect()]
    if bad:
        raise ContractError("; ".join(bad))


def orphan_dates(fact: DataFrame, dim: DataFrame, day_col: str = "processed_date") -> DataFrame:
    """Per day, fact rows and those whose date_id has no dim_date row.

    The fact is counted per (day, date_id) first, so the join sees a row per
    calendar day and Spark picks its form by the measured sizes.
    """
    per_id = fact.groupBy(day_col, "date_id").agg(F.count(F.lit(1)).alias("n"))
    ids = dim.select("date_id").distinct().withColumn("_in_dim", F.lit(True))
    joined = per_id.join(ids, "date_id", "left")
    return joined.groupBy(day_col).agg(
        F.sum("n").alias("fact_rows"),
        F.sum(F.when(F.col("_in_dim").isNull(), F.col("n")).otherwise(0)).alias("orphan_rows"),
    )


def dw_counts(trades: DataFrame, pumps: DataFrame, washes: DataFrame, days: DataFrame) -> DataFrame:
    """Q7: per expected day, the row count of each fact table; ``ok`` unless fact_trades is empty.

    ``days`` has a column ``trade_date`` and may have ``symbol``: then a row is expected per day and
    symbol. Each count is an aggregate to one row per day before the joins, so the joins only see
    per-day rows.
    """
    on = ["trade_date", *symbol_keys(days)]

    def counted(fact: DataFrame, day_col: str, name: str) -> DataFrame:
        return fact.groupBy(F.col(day_col).alias("trade_date"), *on[1:]).agg(F.count(F.lit(1)).alias(name))

    out = days
    for fact, day_col, name in ((trades, "processed_date", "fact_trades"), (pumps, "trade_date", "fact_pump_dump_events"),
                                (washes, "trade_date", "fact_wash_trade_pairs")):
        out = out.join(counted(fact, day_col, name), on, "left").fillna(0, [name])
    return out.withColumn("ok", F.col("fact_trades") > 0)


def validate_counts(counts: DataFrame) -> list[dict]:
    """Raise if any day (and symbol) has no fact_trades rows; collects one row per day."""
    rows = [r.asDict() for r in counts.orderBy("trade_date", *symbol_keys(counts)).collect()]
    bad = [_named(r, "trade_date") for r in rows if not r["ok"]]
    if bad:
        raise ValueError("fact_trades has 0 rows for: " + ", ".join(bad))
    return rows
