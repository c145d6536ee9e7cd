"""Shared derived tables of one data folder, each computed at most once per session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeweave.session import stage
from tradeweave.sources import contract
from tradeweave.sources.tables import Tables

_STAGED: dict[tuple[str, str, int, str], DataFrame] = {}


def file_state(spark: SparkSession, folder: str) -> int:
    """Changes when a file of the folder's tables is added, removed or rewritten (names, sizes, times)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for depth in ("*.parquet", "*.parquet/*"):
        for f in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, depth)) or []:
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


def forget_staged() -> None:
    """Drop the session's shared copies, so the next query computes everything again (benchmarks)."""
    _STAGED.clear()


class Mart(Tables):
    """Input tables plus the contract tables. Small-relative-to-lines tables are staged, line-grained ones are not."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self._app = spark.sparkContext.applicationId
        self._state = file_state(spark, self.folder)

    def staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self._app, self.folder, self._state, name)
        if key not in _STAGED:
            _STAGED[key] = stage(build())
        return _STAGED[key]

    def at_hand(self, name: str) -> bool:
        return (self._app, self.folder, self._state, name) in _STAGED

    @property
    def joined_lines(self) -> DataFrame:
        return self.staged("joined_lines", lambda: contract.joined_lines(self))

    @property
    def nodes(self) -> DataFrame:
        return self.staged("nodes", lambda: contract.entity_nodes(self, self.joined_lines))

    @property
    def node_types(self) -> DataFrame:
        return self.staged("node_types", lambda: contract.node_types(self))

    @property
    def edges(self) -> DataFrame:
        return self.staged("edges", lambda: contract.all_edges(self, self.joined_lines if self.at_hand("joined_lines") else None))

    @property
    def flows(self) -> DataFrame:
        """Material-flow edges (src, dst, edge_type, value), for queries that read no other edges."""
        wanted = lambda: self.edges.filter("edge_type = 'material_flow'").select("src", "dst", "edge_type", "value")
        return wanted() if self.at_hand("edges") else self.staged("flows", lambda: contract.known_flows(self))

    @property
    def series(self) -> DataFrame:
        return self.staged("series", lambda: contract.port_series(self))

    @property
    def shocks(self) -> DataFrame:
        return self.staged("shocks", lambda: contract.working_capital_shocks(self))

    @property
    def shipments(self) -> DataFrame:
        return contract.shipments(self, self.series)

    @property
    def lc(self) -> DataFrame:
        return self.staged("lc", lambda: contract.lc_transactions(self, self.nodes, self.series))

    @property
    def party_nodes(self) -> DataFrame:
        """What letters of credit need of entities; without the flows of entities, their lines are read once and not written."""
        needed = ["node_id", "country", "debt_to_equity", "current_ratio", "reliability_score", "country_risk_score", "otif_rate"]
        return self.nodes if self.at_hand("nodes") else self.staged(
            "party_nodes", lambda: contract.entity_nodes(self, flows=False).select(*needed))

    @property
    def lc_alone(self) -> DataFrame:
        """The letters, for queries that read no other column of entities."""
        return self.staged("lc", lambda: contract.lc_transactions(self, self.party_nodes, self.series))

    @property
    def lc_default_scores(self) -> DataFrame:
        """`default_probability_true` and `is_default` of every letter: what they need of entities and lines, nothing else."""
        def build():
            return contract.lc_transactions(self, self.party_nodes, self.series).select("default_probability_true", "is_default")
        columns = ["default_probability_true", "is_default"]
        return self.lc.select(*columns) if self.at_hand("lc") else self.staged("lc_default_scores", build)

    @property
    def network_nodes(self) -> DataFrame:
        from tradeweave.operators.graph import with_network_position
        return self.staged("network_nodes", lambda: with_network_position(self.nodes, self.edges))
