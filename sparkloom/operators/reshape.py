"""Projection and reshaping of programme tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import append_line, split_list


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """df itself; a KeyError names the columns it lacks."""
    if missing := sorted(set(names) - set(df.columns)):
        raise KeyError(f"missing columns: {', '.join(missing)}")
    return df


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that df has."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def drop_twins(df: DataFrame, twins: Mapping[str, str]) -> DataFrame:
    """Drop each column whose preferred twin is there too."""
    return df.drop(*[c for c, twin in twins.items() if c in df.columns and twin in df.columns])


def ensure_columns(df: DataFrame, names: Iterable[str], default: object = "") -> DataFrame:
    """Add the columns that df lacks, with a constant."""
    return df.withColumns({c: F.lit(default) for c in names if c not in df.columns})


def columns_through(df: DataFrame, last: str) -> DataFrame:
    """Columns up to and with the one named."""
    return df.select(df.columns[: df.columns.index(last) + 1])


def columns_from(df: DataFrame, first: str) -> DataFrame:
    """Columns from the one named on."""
    return df.select(df.columns[df.columns.index(first) :])


def nested(df: DataFrame, name: str, fields: Mapping[str, str]) -> DataFrame:
    """Fold columns (new name: old name; those that df lacks are left out) into one struct column."""
    have = {new: old for new, old in fields.items() if old in df.columns}
    return df.withColumn(name, F.struct(*[F.col(old).alias(new) for new, old in have.items()])).drop(*have.values())


def split_targets(df: DataFrame, targets: Mapping[str, Mapping[str, str]]) -> dict[str, DataFrame]:
    """One projection for each target table, by its map of new name to old name."""
    return {t: df.select(*[F.col(old).alias(new) for new, old in fields.items() if old in df.columns]) for t, fields in targets.items()}


def slice_rows(df: DataFrame, row_id: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows whose id is from start up to, without, end; all from start on if end is None."""
    out = df.where(F.col(row_id) >= start)
    return out if end is None else out.where(F.col(row_id) < end)


def head(df: DataFrame, row_id: str, n: int) -> DataFrame:
    """The first n rows by row_id."""
    return df.orderBy(row_id).limit(n)


def sample_rows(df: DataFrame, key: Column | str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), drawn by a hash of a key, so that a rerun draws the same."""
    key = F.col(key) if isinstance(key, str) else key
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return df.withColumn("_draw", drawn).orderBy("_draw").limit(n).drop("_draw")


def explode_terms(df: DataFrame, terms: str = "terms_start", deadlines: str = "deadline") -> DataFrame:
    """Split multi-valued terms into rows.

    Several terms and as many deadlines pair up; several terms and another number of deadlines keep the
    deadline text in each row; one term or none leaves the row as it is."""
    t, d = split_list(terms), split_list(deadlines)
    pair = lambda term, deadline: F.struct(term.alias("t"), deadline.alias("d"))
    several = F.size(t) > 1
    rows = (
        F.when(several & (F.size(t) == F.size(d)), F.zip_with(t, d, pair))
        .when(several, F.transform(t, lambda x: pair(x, F.col(deadlines))))
        .otherwise(F.array(pair(F.col(terms), F.col(deadlines))))
    )
    return df.withColumn("_row", F.explode(rows)).withColumns({terms: F.col("_row.t"), deadlines: F.col("_row.d")}).drop("_row")


def explode_terms_only(df: DataFrame, terms: str = "terms_start") -> DataFrame:
    """A row for each term; rows without a term stay."""
    t = split_list(terms)
    return df.withColumn(terms, F.explode(F.when(F.size(t) > 0, t).otherwise(F.array(F.col(terms)))))


def keep_first_deadline(df: DataFrame, deadline: str = "deadline", more: str = "more_info") -> DataFrame:
    """Keep the first of several deadlines and note the others in ``more``."""
    parts = split_list(deadline)
    extra = F.concat(F.lit("- Additional deadlines: "), F.array_join(F.slice(parts, 2, 1 << 30), "; "))
    several = F.size(parts) > 1
    return df.withColumns({deadline: F.when(several, F.get(parts, F.lit(0))).otherwise(F.col(deadline)), more: F.when(several, append_line(more, extra)).otherwise(F.col(more))})


def zip_explode(df: DataFrame, left: Column, right: Column, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """A row for each position of two arrays; the shorter one is filled up with nulls."""
    zipped = F.posexplode(F.arrays_zip(left.alias("l"), right.alias("r"))).alias("position", "_z")
    return df.select("*", zipped).withColumns({names[0]: F.col("_z.l"), names[1]: F.col("_z.r")}).drop("_z")


def flatten_nested(df: DataFrame, array: str, keep: Iterable[str]) -> DataFrame:
    """A row for each struct of an array column, its fields as columns; rows with an empty array stay."""
    return df.select(*keep, F.inline_outer(array))


def nest(df: DataFrame, keys: list[str], name: str, order: list[str], fields: list[str]) -> DataFrame:
    """Fold rows into one array of structs for each key, in the order given.  A key's rows must fit one row."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))).alias(name))


def drop_sentinels(df: DataFrame, marker: str = "completion_rate") -> DataFrame:
    """Without the header records that carry the marker field."""
    return df.where(F.col(marker).isNull()).drop(marker) if marker in df.columns else df


def column_files(df: DataFrame, core: list[str], columns: list[str] | None = None) -> dict[str, DataFrame]:
    """For each further column, the core columns with it."""
    return {c: df.select(*core, c) for c in (columns or [c for c in df.columns if c not in core])}
