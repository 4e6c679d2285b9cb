"""Features of clusters are made once."""

from shelfmark.operators import clustering
from shelfmark.plans.specs import Feature


def test_candidates_do_not_make_features_again(spark, tmp_path):
    """Scores and labelled rows read the written features, not what these were made from."""
    points = [(f"c{i % 2}", f"s{i:02d}", float(i % 3) * 100 + i / 50) for i in range(40)]
    spark.createDataFrame(points, "channel string, store_code string, x double").write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    for df in clustering.candidate_grid(clustering.vectors(rows, ["x"]), [2, 3], ("kmeans", "bisecting", "mixture")).values():
        assert df.count() == 40 and all("/features-" in f for f in df.inputFiles())
    out = clustering.store_clusters(rows, ["channel"], [Feature("x", "max(x)")], [2, 3])
    assert out.count() == 40 and not any(f"{tmp_path}/in" in f for f in out.inputFiles())
