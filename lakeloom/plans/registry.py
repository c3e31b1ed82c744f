"""Query name -> Spark plan, and the equivalent ANSI SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from lakeloom.plans.star import STAR_SQL, Star
from lakeloom.session import apply_defaults

_PLANS: dict[str, Callable[[Star], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, star: bool = True):
    """Register a plan. ``sql`` is the check query; with ``star`` it may use the
    star tables (`sales`, `item`, ...) as defined in `STAR_SQL` and may start
    with further CTEs."""

    def add(build: Callable[[Star], DataFrame]):
        if name in _PLANS:
            raise ValueError(f"duplicate query name {name}")
        _PLANS[name] = build
        if sql is not None:
            text = sql.strip()
            if star:
                text = STAR_SQL + (",\n" + text[5:].lstrip() if text[:5].upper() == "WITH " else "\n" + text)
            _SQL[name] = text
        return build

    return add


_MODULES = ("layers", "stars", "bands", "thresholds", "membership", "channels", "growth", "movement", "rollups",
            "windows", "waypoints", "kept")


def _load() -> None:
    for module in _MODULES:
        import_module(f"lakeloom.plans.{module}")


def plans() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(name: str):
        return lambda spark, folder: plan(name, Star(spark, folder))

    return {name: bind(name) for name in _PLANS}


def plan(name: str, star: Star) -> DataFrame:
    """One plan over given star tables, such as published catalog tables."""
    _load()
    apply_defaults(star.spark)
    return _PLANS[name](star)


def check_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
