"""The whole lake, stage by stage, on generated messages."""

from caseloom.plans import pipeline
from caseloom.sources import landing
from caseloom.sources.landing import Lake


def test_stages(spark, tmp_path):
    lake = Lake(str(tmp_path))
    pipeline.generate_stage(spark, lake, days=90, facilities=4)
    assert pipeline.bronze_stage(spark, lake)["rows"] > 500 and pipeline.bronze_stage(spark, lake)["rows"] == 0
    silver = pipeline.silver_stage(spark, lake)
    assert silver["bronze"] == silver["silver"] + silver["rejected"] + silver["deduplicated"]
    built = pipeline.gold_stage(spark, lake, ("2026-04-02", "2026-06-30"))
    assert built["fact_rows"] == 90 * 4 * 6 and built["failed_checks"] == {}
    assert pipeline.features_stage(spark, lake)["row_count"] == 90 * 4 * 6
    assert landing.read_sidecar(spark, lake.uri("feature", "outbreak_features_contract.json"))["row_count"] == 90 * 4 * 6
    trained = pipeline.train_stage(spark, lake, test_days=30, iterations=3, repeats=1)
    report = landing.read_sidecar(spark, lake.uri("ml", "train_report.json"))
    assert report["threshold"] == trained["threshold"] and len(report["permutation_importance"]) == 14 and report["caveat"]
    assert trained["version"] == 1 and trained["model"]["roc_auc"] > 0.5
    out = pipeline.score_stage(spark, lake)  # by the report's threshold
    assert out.count() == 14 * 4 * 6 and out.where("is_signal = 1").count() == out.where(f"signal_score >= {trained['threshold']}").count()
