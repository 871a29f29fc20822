"""Grouped records per key (W11): order, keep the first n; nest many lists at once.

Record order within a key: the date column descending (or ``events``
descending when there is no date), then every other column ascending by name,
nulls last throughout. The rank is a ``row_number`` over that order and the
head-n filter is ``rn <= n``; Catalyst turns the pair into a partial
``WindowGroupLimit`` before the shuffle and a final one after, so even a key
holding a third of the rows ships at most n rows per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accounthealth.functions.cache import per_context


def record_order(columns: list[str], key: str, date_column: str | None) -> list[Column]:
    order: list[Column] = []
    used = {key}
    if date_column and date_column in columns:
        order.append(F.col(date_column).desc_nulls_last())
        used.add(date_column)
    elif not date_column and "events" in columns:
        order.append(F.col("events").desc_nulls_last())
        used.add("events")
    order += [F.col(c).asc_nulls_last() for c in sorted(c for c in columns if c not in used)]
    return order


def ranked_records(df: DataFrame, key: str = "account_id", date_column: str | None = None,
                   limit: int | None = None) -> DataFrame:
    """Rows with a 1-based ``rn`` per key; only the first ``limit`` if set."""
    window = Window.partitionBy(key).orderBy(*record_order(df.columns, key, date_column))
    ranked = df.withColumn("rn", F.row_number().over(window))
    return ranked.filter(F.col("rn") <= limit) if limit else ranked


def nest_records(ranked: DataFrame, key: str = "account_id", name: str = "records") -> DataFrame:
    """One row per key with ``name`` = records in rank order. Each record keeps
    every source column, the key included (``rn`` dropped).

    Lists are bounded by the limit (or by one row per month for trends), so
    each collected group is small."""
    cols = tuple(c for c in ranked.columns if c != "rn")
    return ranked.groupBy(key).agg(_packed_records(cols).alias(name))


@per_context
def _packed_records(cols: tuple[str, ...]) -> Column:
    """Rows of a group as an array of structs, in ``rn`` order."""
    packed = F.sort_array(F.collect_list(F.struct(F.col("rn"), *[F.col(c) for c in cols])))
    return F.transform(packed, lambda r: F.struct(*[r[c].alias(c) for c in cols]))


# ---- many lists in one grouping

def _falling(field: T.StructField) -> Column:
    """A number that grows as a date, time or count falls."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        return -F.unix_date(c)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    return -c


def _first(df: DataFrame, date_column: str | None) -> str | None:
    wanted = date_column or "events"
    return wanted if wanted in df.columns else None


def _falls_as_text(df: DataFrame, date_column: str | None) -> bool:
    first = _first(df, date_column)
    return first is not None and isinstance(df.schema[first].dataType, T.StringType)


def _sort_struct(df: DataFrame, key: str, date_column: str | None) -> Column:
    """The record as one struct that sorts like ``record_order``: a flag for null before every
    column, as structs sort nulls first. A text date comes first as it is, for a falling sort."""
    first, parts, last = _first(df, date_column), [], []
    if _falls_as_text(df, date_column):
        parts = [F.col(first).alias(f"v_{first}")]
    elif first:
        parts = [F.col(first).isNull().alias("no_first"),
                 _falling(df.schema[first]).alias("fall")]
        last = [F.col(first).alias(f"v_{first}")]
    for c in sorted(c for c in df.columns if c not in (key, first)):
        parts += [F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(f"v_{c}")]
    return F.struct(*parts, *last, F.col(key).alias(f"v_{key}"))


def nested_lists(lists: dict[str, tuple[DataFrame, str | None, int | None]],
                 key: str = "account_id") -> DataFrame:
    """One row per non-null ``key`` with every list of ``lists`` (source, date column, limit) as
    an array of its records, ordered and cut as ``ranked_records`` does.

    All sources are rows of one union, tagged by list, and one aggregate per key nests them.
    The limited lists share one ranking window, whose limit also cuts before its exchange, so
    a hot key ships a few rows a task. Lists without a limit must be bounded by themselves (a
    row a month); only they may have a text as their date, with one row per key and text.
    """
    sources = {name: df.filter(F.col(key).isNotNull()) for name, (df, _, _) in lists.items()}
    structs = {name: _sort_struct(df, key, lists[name][1]) for name, df in sources.items()}
    kinds = {name: df.select(structs[name].alias("r")).schema["r"].dataType
             for name, df in sources.items()}

    def tagged(name: str, names: list[str]) -> DataFrame:
        return sources[name].select(
            key, F.lit(names.index(name)).alias("_list"),
            *[(structs[n] if n == name else F.lit(None).cast(kinds[n])).alias(n) for n in names])

    def union(names: list[str]) -> DataFrame:
        return reduce(DataFrame.unionAll, [tagged(n, names) for n in names])

    limited = [n for n in lists if lists[n][2]]
    whole = [n for n in lists if not lists[n][2]]
    parts = []
    if limited:
        most = max(lists[n][2] for n in limited)
        order = Window.partitionBy(key, "_list").orderBy(*limited)
        ranked = union(limited).withColumn("_rn", F.row_number().over(order)).filter(
            F.col("_rn") <= most)
        own = F.element_at(F.array(*[F.lit(lists[n][2]) for n in limited]), F.col("_list") + 1)
        parts.append(ranked.filter(F.col("_rn") <= own).drop("_rn", "_list"))
    if whole:
        parts.append(union(whole).drop("_list"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(
        parts[1], allowMissingColumns=True)

    def records(name: str) -> Column:
        # the struct sorts in rank order; its values come back under their names
        names, rising = sources[name].columns, not _falls_as_text(sources[name], lists[name][1])
        return F.transform(F.sort_array(F.collect_list(name), asc=rising), lambda r: F.struct(
            *[r[f"v_{c}"].alias(c) for c in names])).alias(name)

    return rows.groupBy(key).agg(*[records(n) for n in lists])
