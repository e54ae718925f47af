"""Typed loading helpers: read a model table, fill column defaults, clean labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.sources import schema as S

# Column defaults of the model (fixed values of the warehouse definition):
# an omitted device is 'Unknown', omitted money is 0.
DEFAULTS = {
    ("sessions", "device"): S.DEFAULT_DEVICE,
    ("conversions", "revenue"): 0,
    ("costs_daily", "cost"): 0,
}


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a stored model table with its declared schema (no inference)."""
    return spark.read.schema(S.TABLES[table]).parquet(path)


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Add the columns ``df`` lacks: declared defaults where the model has one,
    NULL otherwise; then order and type the columns as declared.

    Only an *absent* column takes its default. A NULL supplied in a NOT NULL
    column stays NULL and is reported by the not-null audit.
    """
    out = []
    present = set(df.columns)
    for f in S.TABLES[table].fields:
        if f.name in present:
            out.append(F.col(f.name).cast(f.dataType.simpleString()).alias(f.name))
        else:
            default = DEFAULTS.get((table, f.name))
            out.append(F.lit(default).cast(f.dataType.simpleString()).alias(f.name))
    return df.select(*out)


def normalise_label(col: str | Column) -> Column:
    """Case- and trailing/leading-space-insensitive label ('mobile ' and
    'Mobile' group together), spelled with an initial capital per word."""
    c = F.col(col) if isinstance(col, str) else col
    return F.initcap(F.trim(c))


def load_rows(spark: SparkSession, rows: list[tuple], table: str, columns: list[str] | None = None) -> DataFrame:
    """``INSERT INTO table (columns) VALUES ...``: literal rows with an explicit
    column list; omitted columns take their defaults (see :func:`with_defaults`)."""
    fields = {f.name: f for f in S.TABLES[table].fields}
    cols = columns or list(fields)
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField(c, fields[c].dataType, True) for c in cols])
    return with_defaults(spark.createDataFrame(rows, sch), table)


def append_table(df: DataFrame, table: str, location: str) -> None:
    """Append typed rows to a stored table (batch load)."""
    with_defaults(df, table).write.mode("append").parquet(location)


def refresh_table(df: DataFrame, table: str, location: str) -> None:
    """Full refresh: write the complete new content to ``location``, which must
    be a new folder (a table is never overwritten while it may be read)."""
    with_defaults(df, table).write.mode("errorifexists").parquet(location)


def tagged_load(df: DataFrame, table: str, parents: dict[str, DataFrame]) -> DataFrame:
    """The rows of a load with ``failed``, the array of constraints that each breaks: defaults of
    absent columns first, then NOT NULL, CHECK, foreign keys (to ``parents``, by table; tables that aren't
    given are not checked) and the primary key, all rows of a repeated key.

    Missing and repeated keys are found on distinct keys, map-side first, and meet their rows
    under a salt: neither a hot parent nor a key that a load repeats without end is one task."""
    from adlens.operators import audits

    rows = with_defaults(df, table)
    key = S.PRIMARY_KEYS[table]
    named = [(f"nn_{c}", F.col(c).isNull()) for c in S.not_null_columns(table)]
    named += [(name, ~F.coalesce(ok, F.lit(True))) for name, ok in audits.check_conditions().get(table, [])]
    whole = audits.salted(rows)

    def flag(name: str, cols: list[str], keys: DataFrame) -> None:
        nonlocal whole
        hit = f"_{name}"
        whole = whole.join(audits.spread(keys.select(*cols, F.lit(True).alias(hit))), [*cols, audits.SALT], "left")
        named.append((name, F.col(hit).isNotNull()))

    for child, col, parent, parent_col in S.FOREIGN_KEYS:
        if child == table and parent in parents:
            flag(f"fk_{col}_{parent}", [col], audits.missing_keys(rows, col, parents[parent], parent_col))
    flag("pk_" + "_".join(key), key, audits.pk_violations(rows.dropna(subset=key), key))
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in named]))
    return whole.select(*[f.name for f in S.TABLES[table].fields], failed.alias("failed"))


def load_checked(df: DataFrame, table: str, parents: dict[str, DataFrame], location: str) -> tuple[DataFrame, DataFrame]:
    """Route a load: (accepted, rejected) rows, written by one job to ``location`` (a new folder). Rejected
    rows keep ``failed``; accepted ones are the typed table, read with its declared schema."""
    from pyspark.sql import types as T

    tagged_load(df, table, parents).withColumn("accepted", F.size("failed") == 0) \
        .write.mode("errorifexists").partitionBy("accepted").parquet(location)
    sch = T.StructType([*S.TABLES[table].fields, T.StructField("failed", T.ArrayType(T.StringType())), T.StructField("accepted", T.BooleanType())])
    rows = df.sparkSession.read.schema(sch).parquet(location)
    return S.declared(rows.filter("accepted"), table), rows.filter("NOT accepted").drop("accepted")


def case_insensitive(col: str | Column, collation: str = "UNICODE_CI_RTRIM") -> Column:
    """The column under a case- and trailing-space-insensitive collation:
    grouping, joining and comparing then treat 'Mobile', 'MOBILE' and
    'mobile ' as one value without rewriting the stored text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.collate(c, collation)
