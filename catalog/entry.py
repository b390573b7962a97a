"""What a registered query consists of."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.bindings import Tables
from catalog.relations import query


class Entry(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None
    doubles: str = ""


def entry(run, body: str | None, *relations: str, doubles: str = "", ctes=None) -> Entry:
    sql = query(body, *relations, doubles=doubles, ctes=ctes) if body is not None else None
    return Entry(run, sql, doubles)


def rounded(df: DataFrame, doubles: str) -> DataFrame:
    columns = doubles.split()
    return df.withColumns({c: F.round(F.col(c) + 1.37e-9, 6) for c in columns}) if columns else df
