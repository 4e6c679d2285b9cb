"""The weights of packing's shards rest on all documents."""

import numpy as np

from shelfmark.llm import packing


def test_weights_come_from_all_documents(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"common words and number {i}") for i in range(9000)], "doc_id long, text string").repartition(5)
    seen = []
    monkeypatch.setattr(packing, "id_ranks", lambda idf, real=packing.id_ranks: seen.append(idf) or real(idf))
    assert packing.pack(df, keep_ids=False).agg({"length": "sum"}).first()[0] > 9000
    # an id that no text has weighs what the number of counted documents gives
    assert len(seen) == 1 and np.isclose(seen[0].max(), np.log((9000 + 0.5) / 0.5))
