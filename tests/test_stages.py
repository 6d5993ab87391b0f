import random

from lamina import domain
from lamina.operators import features
from lamina.plans import stages
from lamina.sources import layers


def write_inputs(folder):
    """Small incident files with gaps, bad numbers and text in quotes."""
    rng = random.Random(3)
    incidents = ["incident_id,company_name,company_revenue_usd,employee_count,is_public_company,industry_primary,attack_vector_primary,data_type,confidence_tier,quality_score,country_hq,notes"]
    financial = ["incident_id,direct_loss_usd,total_loss_usd"]
    market = ["incident_id,abnormal_return"]
    for i in range(400):
        revenue = rng.lognormvariate(3, 1)
        loss = revenue * rng.lognormvariate(0, 0.5)
        shown = "" if i % 30 == 0 else ("$1" if i % 41 == 0 else f"{revenue:.3f}")
        incidents.append(
            f'I{i:04d},"Firm, {i}",{shown},{rng.randint(1, 999)},{rng.choice(["true", "false"])},'
            f'{rng.choice(["31-33", "51", "62"])},{rng.choice(["phishing", "ransomware", ""])},'
            f'{rng.choice(["pii", "mixed", ""])},{rng.randint(1, 4)},{rng.random() * 10:.2f},'
            f'{rng.choice(["US", "BR"])},note'
        )
        if i % 12:
            financial.append(f"I{i:04d},1,{loss:.3f}")
        if i % 3 == 0:
            market.append(f"I{i:04d},{rng.random():.3f}")
    paths = []
    for name, lines in zip(domain.SOURCE_TABLES, (financial, incidents, market)):
        path = folder / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n")
        paths.append(str(path))
    return paths


def test_all_stages(spark, tmp_path):
    reports = stages.run(spark, write_inputs(tmp_path), str(tmp_path / "run"))
    inventory = {r["table_name"]: r["rows"] for r in reports["raw_inventory"].collect()}
    assert inventory == {"financial_impact": 366, "incidents_master": 400, "market_impact": 134}
    refined = layers.read_layer(spark, f"{tmp_path}/run/refined/dataset_ml.parquet")
    assert refined.count() == 366
    assert not set(domain.LEAKING_COLUMNS) & set(refined.columns)
    assert "is_public_company" in features.detect_features(refined)
    assert refined.filter("attack_vector_primary = 'Desconhecido'").count() > 0
    table = layers.read_layer(spark, f"{tmp_path}/run/feature/dataset_ml_ready.parquet")
    assert table.filter("split = 'train'").count() == 292
    stored = layers.read_layer(spark, f"{tmp_path}/run/feature/fit_params.parquet")
    assert len(features.read_params(stored).vocabulary["industry_primary"]) == 3
    assert all(r["passed"] for r in reports["leakage_audit"].collect())
    assert {r["model"] for r in reports["metrics"].collect()} == {"modelo1_gini", "modelo2_entropy"}
    assert reports["comparacao_modelos"].count() == 74
    assert reports["layer_verdict"].count() == 2
    assert reports["summary_modelo1_gini"].first()["n_teste"] == 74
    csv = spark.read.option("header", True).csv(f"{tmp_path}/run/reports/previsoes_modelo1_gini")
    assert csv.columns == ["id", "real", "previsto", "acertou?", "total_loss_usd", "threshold"]
    assert csv.count() == 74
