"""Publishing a model in two phases.

A registry is a folder ``root/name`` with the staged models (``models/<run>``)
and a log of one small record per decision (``log/<number>.json``). A model is
published if and only if the log holds an accepted record of its run, and the
champion is the accepted record with the largest number, so readers never see
half a publish:

1. stage: train and write the model; its manifest is written last.
2. gate: the staged model and the champion are scored on one frame of the same
   rows; a model below the minimum R² is refused, one that doesn't improve on
   the champion is rejected.
3. commit: the record is written aside and renamed to the number after the last
   record that the comparison has seen, which fails if another run has taken
   that number; then the gate is passed again, against the new champion.

A run that breaks off leaves no record; the same call with the same run id goes
on after the last finished phase, and one that is decided returns its record.
The commit needs a file system whose rename refuses an existing target in one
step (HDFS; locally it is a check and a rename).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.operators import model as M
from kiln.operators.split import hash_split
from kiln.plans.pipeline import TARGET, run_training
from kiln.sources.hadoop import Folder
from kiln.sources.sinks import load_model, save_model

RECORD = ("seq long, run_id string, outcome string, r2_new double, r2_old double, champion_before string, "
          "path string, decided_at string")


class Registry:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.files = spark, Folder(spark, f"{root.rstrip('/')}/{name}")
        self.folder = self.files.path

    def records(self) -> DataFrame:
        """All decisions, one row each."""
        if not any(n.endswith(".json") for n in self.files.children("log")):
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).json(f"{self.folder}/log/*.json")

    def model_path(self, run_id: str) -> str:
        return f"{self.folder}/models/{run_id}"

    def staged(self, run_id: str) -> bool:
        return self.files.exists(f"models/{run_id}/manifest/_SUCCESS")

    def stage(self, run_id: str, model) -> None:
        save_model(model, self.model_path(run_id), self.spark)

    def unfinished(self) -> list[str]:
        """Runs with a staged model and no record."""
        decided = {r["run_id"] for r in self.records().select("run_id").collect()}
        return [r for r in self.files.children("models") if r not in decided]

    def commit(self, record: dict) -> bool:
        """Write the record under its number; False if the number is taken."""
        return self.files.create_once(f"log/{record['seq']:020d}.json", json.dumps(record).encode() + b"\n")


def decide(registry: Registry, run_id: str, test: DataFrame, label: str, min_r2: float, min_improvement: float) -> dict:
    """Phases 2 and 3 for a staged model."""
    spark = registry.spark
    model = load_model(registry.model_path(run_id), spark)
    while True:
        log = {r["seq"]: r for r in registry.records().collect()}  # one row per decision ever taken
        accepted = [s for s in log if log[s]["outcome"] == "accepted"]
        champion = log[max(accepted)] if accepted else None
        frame = model.beside(test, "_new")
        if champion is not None:
            frame = load_model(champion["path"], spark).beside(frame, "_old")
        versus = M.champion_challenger(frame, label, "_new", "_old" if champion is not None else None, min_improvement).first()
        try:
            M.require_quality(M.quality_gate(M.regression_metrics(frame, label, "_new", run_id), min_r2))
            outcome = "accepted" if versus["accepted"] else "rejected"
        except M.QualityGateError:
            outcome = "refused"
        record = {"seq": max(log, default=-1) + 1, "run_id": run_id, "outcome": outcome, "r2_new": versus["r2_new"], "r2_old": versus["r2_old"],
                  "champion_before": champion["run_id"] if champion is not None else None, "path": registry.model_path(run_id),
                  "decided_at": datetime.now(timezone.utc).isoformat()}
        if registry.commit(record):
            return record


def publish(registry: Registry, run_id: str, train: Callable[[], object], test: DataFrame, label: str,
            min_r2: float = R.MIN_R2, min_improvement: float = 0.0) -> dict:
    """Stage what ``train`` returns (unless this run has staged already), pass the gate, commit; the run's record."""
    known = registry.records().filter(F.col("run_id") == run_id).first()
    if known is not None:
        return known.asDict()
    if not registry.staged(run_id):
        registry.stage(run_id, train())
    return decide(registry, run_id, test, label, min_r2, min_improvement)


def run_publish(raw: DataFrame, registry: Registry, run_id: str, key: str = "listing_id", test_ratio: float = R.TEST_RATIO,
                min_r2: float = R.MIN_R2, min_improvement: float = 0.0) -> dict:
    """The whole preparation and training on raw rows, then the publish; the test rows are the training flow's own."""
    def train():
        result = run_training(raw, key, test_ratio, min_r2=min_r2)
        result.release()
        return result.bundle

    test = hash_split(raw, key, test_ratio, "_split").filter("_split = 'test'").drop("_split")
    return publish(registry, run_id, train, test, TARGET, min_r2, min_improvement)
