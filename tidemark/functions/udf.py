"""User-defined functions: SQL bodies, vectorised Python bodies, aggregate expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ConfigError
from tidemark.functions.aggregate import sum_positive

NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def create_sql_function(
    spark: SparkSession,
    name: str,
    arguments: Mapping[str, str | tuple[str, Any]],
    returns: str,
    body: str,
) -> str:
    """A function of this session with a SQL body, which Spark inlines into the query.

    ``arguments`` maps names to a type, or to a type and a default value. Arguments with
    a default come last.
    """
    if not NAME.match(name):
        raise ConfigError(f"invalid function name {name!r}")
    parts, defaults = [], False
    for arg, kind in arguments.items():
        if isinstance(kind, tuple):
            kind, default = kind
            defaults = True
            quoted = "'" + default.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(default, str) else default
            parts.append(f"`{arg}` {kind} DEFAULT {quoted}")
        elif defaults:
            raise ConfigError(f"argument {arg!r} without a default follows one with a default")
        else:
            parts.append(f"`{arg}` {kind}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(parts)}) RETURNS {returns} RETURN {body}"
    )
    return name


def python_function(
    body: Callable[..., pd.Series],
    returns: str | T.DataType,
    *,
    deterministic: bool = True,
):
    """A scalar function over pandas Series, moved in Arrow batches."""
    made = F.pandas_udf(body, returns)
    return made if deterministic else made.asNondeterministic()


def mask_pii(value, keep: int = 2) -> Column:
    """The first characters of a text, each further one replaced by an asterisk."""
    value = F.col(value) if isinstance(value, str) else value
    rest = F.greatest(F.char_length(value) - keep, F.lit(0))
    return F.concat(F.substring(value, 1, keep), F.repeat(F.lit("*"), rest))


AGGREGATES: dict[str, Callable[..., Column]] = {"sum_positive": sum_positive}


def aggregate_function(name: str, build: Callable[..., Column] | None = None) -> Callable[..., Column]:
    """Look up a named aggregate, or define one as a function that returns an aggregate column."""
    if build is not None:
        AGGREGATES[name] = build
    if name not in AGGREGATES:
        raise ConfigError(f"unknown aggregate function {name!r}")
    return AGGREGATES[name]
