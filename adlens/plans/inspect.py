"""Plan inspection helpers (used by tests and when reviewing a query's plan)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def operators(df: DataFrame) -> list[str]:
    """Physical operator names of the (initial) plan, in tree order."""
    text = plan_text(df, "formatted").split("\n\n")[0]
    return re.findall(r"(?:\+-|:-|^)\s*([A-Za-z]+)", text, flags=re.M)


def scans_of(df: DataFrame, table_path_part: str) -> int:
    """How many parquet scans read a location containing ``table_path_part``."""
    text = plan_text(df, "formatted")
    blocks = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*", text)
    return sum(1 for b in blocks if table_path_part in b.split("Location:")[1])


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\n]*)\]", plan_text(df, "formatted"))
