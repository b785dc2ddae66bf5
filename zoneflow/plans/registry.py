"""Model bundles by run, one of which is promoted.

A run's bundle is written to a folder of its own and, once registered, never changed; promoting names it in a new numbered document, so a forecast
that loads the promoted bundle always gets a whole one, and going back is promoting again what was before. A run's metrics lie with it and
are compared with those of the run before.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators.prep import metric_drift
from zoneflow.plans.training import ModelBundle, load_bundle, metric_history, save_bundle
from zoneflow.schemas import METRIC_SCHEMA
from zoneflow.sources.manifests import Manifests

HISTORY_SCHEMA = "number int, run_id string, action string, degraded boolean"


class DegradedModel(RuntimeError):
    """A run that is not to be promoted because its metrics fell."""


@dataclass
class ModelRegistry:
    spark: SparkSession
    base: str

    @property
    def _promotions(self) -> Manifests:
        return Manifests(self.spark, f"{self.base.rstrip('/')}/promotions")

    def _run(self, run_id: str) -> str:
        if not run_id or "/" in run_id or run_id.startswith((".", "_")):
            raise ValueError(f"{run_id!r} does not name a run")
        return f"{self.base.rstrip('/')}/runs/{run_id}"

    def _runs(self) -> Manifests:
        return Manifests(self.spark, f"{self.base.rstrip('/')}/registered")

    def runs(self) -> list[str]:
        """Registered runs, oldest first. A run whose writer failed is not among them."""
        found = self._runs()
        return [found.read(n)["run_id"] for n in found.numbers()]

    def register(self, bundle: ModelBundle, metrics: DataFrame, run_id: str, run_ts: dt.datetime) -> DataFrame:
        """Keep a run's bundle and metrics; returns its drift rows against the run before. A run id is used once."""
        if run_id in self.runs():
            raise ValueError(f"run {run_id} is registered already")
        save_bundle(bundle, self._run(run_id))
        # A run that failed before it was registered may come again, so its files are replaced.
        metric_history(metrics, run_id, run_ts).write.mode("overwrite").parquet(f"{self._run(run_id)}/metrics")
        while not self._runs().publish(([0, *self._runs().numbers()])[-1] + 1, {"run_id": run_id}):
            pass
        return metric_drift(self.metrics()).filter(F.col("run_id") == run_id)

    def metrics(self) -> DataFrame:
        """Metrics of the registered runs."""
        paths = [f"{self._run(r)}/metrics" for r in self.runs()]
        return self.spark.read.schema(METRIC_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], METRIC_SCHEMA)

    def promote(self, run_id: str, drift: DataFrame | None = None, refuse_degraded: bool = False, action: str = "promote") -> int:
        """Make a registered run the one that forecasts load. A degraded run is promoted and marked, or refused if so asked."""
        if run_id not in self.runs():
            raise LookupError(f"no run {run_id}")
        degraded = drift is not None and not drift.filter("status = 'DEGRADED'").isEmpty()
        if degraded and refuse_degraded:
            raise DegradedModel(f"run {run_id} is degraded")
        while True:
            number = ([0, *self._promotions.numbers()])[-1] + 1
            if self._promotions.publish(number, {"run_id": run_id, "action": action, "degraded": degraded}):
                return number

    def promoted(self) -> str:
        """The run that forecasts load."""
        numbers = self._promotions.numbers()
        if not numbers:
            raise LookupError("no run is promoted")
        return self._promotions.read(numbers[-1])["run_id"]

    def load(self, run_id: str | None = None) -> ModelBundle:
        """The promoted bundle, or that of a run."""
        run_id = self.promoted() if run_id is None else run_id
        if run_id not in self.runs():
            raise LookupError(f"no run {run_id}")
        return load_bundle(self.spark, self._run(run_id))

    def roll_back(self) -> str:
        """Promote again the newest run that was promoted before the present one and was not left by going back."""
        current, left = self.promoted(), set()
        numbers = self._promotions.numbers()
        for number in reversed(numbers):
            entry = self._promotions.read(number)
            if entry["action"] == "roll back":
                left.add(self._promotions.read(number - 1)["run_id"])
            elif entry["run_id"] != current and entry["run_id"] not in left:
                self.promote(entry["run_id"], action="roll back")
                return entry["run_id"]
        raise LookupError(f"no run was promoted before {current}")

    def history(self) -> DataFrame:
        """Every promotion: number, run_id, action, degraded."""
        rows = [(n, e["run_id"], e["action"], e["degraded"]) for n in self._promotions.numbers() for e in [self._promotions.read(n)]]
        return self.spark.createDataFrame(rows, HISTORY_SCHEMA)
