"""Folder layout of one data product: a layer per folder, ``k=v`` folders below it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    root: str
    dataset: str
    version: str = "v1"

    def _layer(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{self.dataset}"

    @property
    def bronze(self) -> str:
        return self._layer("bronze")

    @property
    def silver(self) -> str:
        return self._layer("silver")

    @property
    def gold(self) -> str:
        return f"{self._layer('gold')}/{self.version}"

    @property
    def quarantine(self) -> str:
        return self._layer("quarantine")

    @property
    def quarantine_log(self) -> str:
        return self._layer("_quarantine")

    @property
    def landings(self) -> str:
        return self._layer("_landings")

    @property
    def runs(self) -> str:
        return self._layer("_runs")

    def landing(self, run_id: str, ingest_date: str, attempt: str) -> str:
        return f"{self.bronze}/ingest_date={ingest_date}/run_id={run_id}/attempt={attempt}"

    def quarantine_run(self, run_id: str) -> str:
        return f"{self.quarantine}/ingest_run_id={run_id}"
