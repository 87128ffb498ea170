"""A lookback feature table that is kept up to date by cells.

Anchors and facts are added in batches. All three tables are partitioned by cell:
a hash bucket of the entity and a block of days. A new anchor changes its own cell;
a new fact changes the cells of its bucket that hold the days up to the longest window
after it. Only these cells are computed again, from the anchors in them and the facts
that reach them (partition pruning reads nothing else), and only their folders are
replaced (dynamic partition overwrite). The result equals a full rebuild.

A batch has a name; adding it again replaces its rows, so a call that failed half way
is simply repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import partitioned_joins, sized_shuffles, written
from ..sources.manifest import path_exists
from ..sources.readers import existing_paths
from .lookback import lookback_aggregate, time_units

CELL = ["cell_bucket", "cell_block"]


@dataclass(frozen=True)
class FeatureStore:
    """Where the tables lie, and what the features are. ``finish`` adds columns that depend
    on a row alone (rates, categories) to each rewritten cell."""

    path: str
    entity: str = "player_id"
    anchor_time: str = "date"
    fact_time: str = "date"
    measures: Mapping[str, str] = field(default_factory=dict)
    windows: Mapping[str, int] = field(default_factory=lambda: {"w180": 180, "w365": 365})
    count_name: str = "games_played"
    finish: Callable[[DataFrame], DataFrame] | None = None
    entity_buckets: int = 64
    block_days: int = 90
    version: str = "v1"

    @property
    def feature_path(self) -> str:
        return f"{self.path}/features/version={self.version}"

    def _celled(self, df: DataFrame, time: str) -> DataFrame:
        """Rows with an entity and a time, with their cell."""
        known = df.where(F.col(self.entity).isNotNull() & F.col(time).isNotNull())
        return known.withColumns(self._cell(F.col(self.entity), time_units(df, time, "day")))

    def _cell(self, entity: Column, day: Column) -> dict[str, Column]:
        return {CELL[0]: F.pmod(F.xxhash64(entity), F.lit(self.entity_buckets)).cast("int"),
                CELL[1]: F.floor(day / F.lit(self.block_days)).cast("int")}

    def _put(self, df: DataFrame, kind: str, time: str, batch: str) -> DataFrame:
        path = f"{self.path}/{kind}/batch={batch}"
        celled = self._celled(df, time)
        if kind == "facts":     # as many files as the cells fill, not one per task and cell
            celled = celled.hint("rebalance", *CELL)
        with sized_shuffles(df):
            celled.write.mode("overwrite").partitionBy(*CELL).parquet(path)
        return self._read(df.sparkSession, kind, [path])

    def _read(self, spark: SparkSession, kind: str, paths: list[str] | None = None) -> DataFrame | None:
        if paths is None:
            if not path_exists(spark, f"{self.path}/{kind}"):
                return None
            paths = existing_paths(spark, f"{self.path}/{kind}", "batch=")
        found = None
        for p in paths:     # a batch without rows has no files
            if existing_paths(spark, p, CELL[0]):
                one = spark.read.parquet(p)
                found = one if found is None else found.unionByName(one, allowMissingColumns=True)
        return found

    def reached(self, anchors: DataFrame | None, facts: DataFrame | None) -> DataFrame | None:
        """The cells that new anchors and facts change."""
        cells = []
        if anchors is not None:
            cells.append(anchors.select(*CELL))
        if facts is not None:
            day, longest = time_units(facts, self.fact_time, "day"), max(self.windows.values())
            block = lambda d: F.floor(d / F.lit(self.block_days)).cast("int")
            span = F.sequence(block(day + 1), block(day + longest))
            cells.append(facts.select(CELL[0], F.explode(span).alias(CELL[1])).distinct())
        if not cells:
            return None
        return (cells[0] if len(cells) == 1 else cells[0].unionByName(cells[1])).distinct()

    def add(self, spark: SparkSession, batch: str, anchors: DataFrame | None = None, facts: DataFrame | None = None) -> DataFrame | None:
        """Add a batch and rewrite the cells it reaches; returns these cells (None: nothing to do)."""
        new_anchors = None if anchors is None else self._put(anchors, "anchors", self.anchor_time, batch)
        new_facts = None if facts is None else self._put(facts, "facts", self.fact_time, batch)
        cells = self.reached(new_anchors, new_facts)
        if cells is None:
            return None
        cells = written(cells, "cells")
        all_anchors, all_facts = self._read(spark, "anchors"), self._read(spark, "facts")
        if all_anchors is None:
            return cells
        # at most a row for each bucket and block of days
        here = all_anchors.join(F.broadcast(cells), CELL, "left_semi")
        if all_facts is None:
            raise ValueError("add facts first: without any their columns aren't known")
        back = -(-max(self.windows.values()) // self.block_days)
        sources = cells.select(CELL[0], F.explode(F.sequence(F.col(CELL[1]) - back, F.col(CELL[1]))).alias(CELL[1])).distinct()
        near = all_facts.join(F.broadcast(sources), CELL, "left_semi").drop(*CELL)
        with sized_shuffles(near), partitioned_joins(spark):
            # a cell's rows come out of few tasks, and so in few files: of more than one as partitions outnumber cells
            slices = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, cells.count()))
            out = lookback_aggregate(here, near, entity=self.entity, anchor_time=self.anchor_time, fact_time=self.fact_time,
                                     measures=dict(self.measures), windows=dict(self.windows), count_name=self.count_name,
                                     by=lambda e, day: {**self._cell(e, day), "__slice": F.pmod(day, F.lit(slices))})
            out = self.finish(out) if self.finish else out
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*CELL).parquet(self.feature_path)
        return cells

    def features(self, spark: SparkSession, columns: list[str | Column] | None = None) -> DataFrame:
        found = spark.read.parquet(self.feature_path)
        return found.select(*columns) if columns else found.drop(*CELL)
