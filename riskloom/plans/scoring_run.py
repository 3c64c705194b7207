"""The scheduled scoring job: extract, validate, features, score, persist, alert, drift."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.models.ensemble import EnsembleScorer
from riskloom.monitoring import quality
from riskloom.monitoring.audit import AuditLog
from riskloom.monitoring.drift import detect_drift
from riskloom.operators.features import feature_matrix_columns, with_features, with_features_after
from riskloom.operators.relational import alerts, batch_statistics, extract_unscored_batch
from riskloom.schema import SCORING_RESULTS
from riskloom.sources import tables


@dataclass
class RunResult:
    batch_id: str
    rows: int
    validation: dict
    statistics: dict
    persisted: int
    alerts: int
    drift: dict


@dataclass
class ScoringRun:
    """One folder holds the job's tables: stages, scores, alerts, audit log, model, reference.

    Steps hand over written tables, so a step that loses executors repeats its own work only.
    """

    spark: SparkSession
    folder: str
    batch_size: int = 10_000
    data_source: str | None = None
    alert_threshold: float = 0.8
    forest_options: dict = field(default_factory=dict)

    def _at(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def _scores(self) -> DataFrame:
        if tables.path_exists(self.spark, self._at("scores")):
            return tables.read_scores(self.spark, self._at("scores"))
        return tables.empty(self.spark, SCORING_RESULTS)

    def _model(self, matrix: DataFrame) -> EnsembleScorer:
        """The stored model, or one fitted on this batch and stored."""
        path = self._at("model")
        if tables.path_exists(self.spark, f"{path}/config"):
            return EnsembleScorer.load(self.spark, path)
        scorer = EnsembleScorer().fit(matrix, feature_matrix_columns(matrix), **self.forest_options)
        scorer.save(self.spark, path)
        return scorer

    def run(self, txns: DataFrame, *, past: DataFrame | None = None, batch_id: str | None = None) -> RunResult:
        """Score the oldest unscored rows.

        History features look at the batch itself; with ``past`` also at what came before it.
        """
        batch_id = batch_id or tables.new_batch_id()
        audit = AuditLog(self.spark, self._at("audit_log"))
        stages = self._at("stages")

        with audit.step(batch_id, "EXTRACT") as facts:
            wanted = extract_unscored_batch(txns, self._scores(), self.batch_size, self.data_source)
            batch = tables.stage(wanted, stages, "batch", batch_id)
            rows = facts["records_processed"] = batch.count()
        if rows == 0:
            return RunResult(batch_id, 0, {}, {}, 0, 0, {})

        with audit.step(batch_id, "VALIDATE") as facts:
            outcome = quality.validate(batch, batch_id)
            quality.save_result(self.spark, outcome, self._at("validation"))
            facts["metadata"] = {"success": outcome["success"]}

        with audit.step(batch_id, "TRANSFORM") as facts:
            features = with_features(batch) if past is None else with_features_after(batch, past)
            matrix = tables.stage(features, stages, "features", batch_id)
            facts["records_processed"] = rows

        with audit.step(batch_id, "SCORE") as facts:
            scorer = self._model(matrix)
            scored = tables.stage(scorer.results(scorer.score(matrix)), stages, "scored", batch_id)
            statistics = batch_statistics(scored).first().asDict()
            facts |= {"records_processed": rows, "records_flagged": statistics["flagged"]}

        with audit.step(batch_id, "PERSIST") as facts:
            final = tables.as_scoring_results(scored, batch_id, flag_threshold=scorer.flag_threshold)
            persisted = tables.persist_scores(self.spark, final, self._at("scores"), batch_id=batch_id)
            facts["records_processed"] = persisted

        with audit.step(batch_id, "ALERT") as facts:
            raised = alerts(scored, self.alert_threshold).withColumn("batch_id", F.lit(batch_id))
            raised = tables.stage(raised, self._at("alerts"), "raised", batch_id)
            n_alerts = facts["records_flagged"] = raised.count()

        drift = detect_drift(self.spark, matrix, batch_id, self._at("drift_reference"))
        return RunResult(batch_id, rows, outcome, statistics, persisted, n_alerts, drift)
