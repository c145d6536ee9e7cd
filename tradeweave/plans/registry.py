"""All registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tradeweave.sources.mart import Mart

SECTIONS = ["contract", "relational", "aggregates", "series", "scores", "evaluation", "network", "learning", "model_checks",
            "streams"]


class Section:
    """Collects `name -> query` and `name -> SQL` pairs of one plan module."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None):
        def register(build: Callable[[Mart], DataFrame]):
            self.queries[name] = lambda spark, folder: build(Mart(spark, folder))
            if oracle is not None:
                self.oracles[name] = oracle
            return build
        return register


def registered() -> tuple[dict, dict]:
    queries, oracles = {}, {}
    for section in SECTIONS:
        module = import_module(f"tradeweave.plans.{section}")
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    return queries, oracles
