"""Running counts within a key, safe against hot keys, in one exchange of the rows.

``ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts)`` puts every row of a user
into one task. A bot account holding a third of all sessions would turn that
task into the whole job, so a key is cut into slices by the order itself and the
count is put together from three levels:

1. rows are counted inside their ``(key, fine slice)``, e.g. the minute of ``ts``.
   This is the only exchange of rows; a bot's month is 43,200 slices.
2. fine slices are summed (map-side first) and counted inside their
   ``(key, coarser slice)``, e.g. the day.
3. the coarsest slices are counted inside the key; a calendar (or, for whole
   numbers, 2**23 slices of 2**40 values) bounds them.

A row's result is its count plus the sums of the slices before its own. Slices
are a function of the row alone, so nothing is sampled, no step needs to be
written to agree with another, and defining a frame runs no job. Lost executors
cost their tasks.

Several 0/1 flag columns can be summed in the same pass, which lets one sort of
a mixed event stream answer "how many views / clicks came before this row".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER_BITS = (0, 12, 26, 40)     # slices of whole numbers: single values, 4,096 of them, ...


def order_slices(df: DataFrame, name: str) -> list[Column]:
    """Slices of an order column, finest first: numbers or text that never
    decrease along it, NULL first. Times: minute and day; whole numbers: ranges of
    ``_NUMBER_BITS`` bits; dates: day and 32 days; text: its first 8 and first 2 characters."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        # the clock's own fields: no time zone is involved
        day = F.unix_date(c.cast("date")).cast("long")
        found = [day * 1_440 + F.hour(c) * 60 + F.minute(c), day]
    elif isinstance(kind, T.DateType):
        day = F.unix_date(c).cast("long")
        found = [day, F.shiftright(day, 5)]
    elif isinstance(kind, T.IntegralType):
        found = [F.shiftright(c.cast("long"), bits) for bits in _NUMBER_BITS]
    elif isinstance(kind, T.StringType):
        return [F.coalesce(F.substring(c, 1, n), F.lit("")) for n in (8, 2)]
    else:
        raise TypeError(f"no slices for {name} of type {kind.simpleString()}: pass slices=[fine, ..., coarse]")
    return [F.coalesce(x, F.lit(-(1 << 63) + 1)) for x in found]


def running_sums(df: DataFrame, key: str, order: Sequence[str], flags: dict[str, str | None],
                 slices: Sequence[Column] | None = None) -> DataFrame:
    """Add, for each ``out -> flag`` in ``flags``, the inclusive running sum of
    ``flag`` (a 0/1 column; ``None`` means count every row) over rows with the
    same ``key`` ordered by ``order``. ``order`` must be a total order within a
    key (end it with a unique column) for the result to be deterministic.
    ``slices``: columns that never decrease along ``order`` and don't split a slice of the
    one before, finest first (default: :func:`order_slices` of its first column). NULL keys are one
    key, as in a SQL window.
    """
    order = list(order)
    cuts = list(slices or order_slices(df, order[0]))
    at = [f"_s{k}" for k in range(len(cuts))]
    weights = {f"_w_{o}": (F.lit(1) if f is None else F.col(f)).cast("long") for o, f in flags.items()}
    # A struct is never NULL, so NULL keys join by plain equality on the exchange of the windows.
    rows = df.select("*", F.struct(F.col(key).alias("k")).alias("_k"), *[c.alias(n) for n, c in zip(at, cuts, strict=True)],
                     *[w.alias(c) for c, w in weights.items()])

    # from the coarsest to the finest: what lies before each slice in its key
    ahead = None
    for k in reversed(range(len(at))):
        outer = at[k + 1:k + 2]
        sums = rows.groupBy("_k", *outer, at[k]).agg(*[F.sum(c).alias(c) for c in weights])
        w = Window.partitionBy("_k", *outer).orderBy(at[k]).rowsBetween(Window.unboundedPreceding, -1)
        own = {c: F.coalesce(F.sum(c).over(w), F.lit(0)) for c in weights}
        here = sums.select("_k", *outer, at[k], *[v.alias(f"_b{c}") for c, v in own.items()])
        if ahead is not None:
            here = here.join(ahead, ["_k", *outer])
        ahead = here.select("_k", at[k], *[(F.col(f"_b{c}") + F.col(f"_a{c}") if outer else F.col(f"_b{c}")).alias(f"_a{c}")
                                           for c in weights])

    inside = Window.partitionBy("_k", at[0]).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.select("*", *[F.sum(c).over(inside).alias(f"_n{c}") for c in weights])
    # every slice has its row; rows are keyed and sorted as the windows left them
    met = counted.join(ahead, ["_k", at[0]])
    return met.select(*[F.col(c) for c in df.columns], *[(F.col(f"_n_w_{o}") + F.col(f"_a_w_{o}")).alias(o) for o in flags])


def sequence_number(df: DataFrame, key: str, order: Sequence[str], out: str = "seq",
                    slices: Sequence[Column] | None = None) -> DataFrame:
    """1-based position of each row within ``key`` in ``order`` (ROW_NUMBER)."""
    return running_sums(df, key, order, {out: None}, slices)
