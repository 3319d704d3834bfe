import numpy as np
from pyspark.sql import functions as F

from quarterlens.operators.scoring import PandasModelScorer


def _factory(log, winner):
    def load():
        import os

        class Model:
            def logits(self, texts):
                return np.tile(np.eye(3)[winner] * 9, (len(texts), 1))

        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")
        return Model()

    return load


def _winners(df):
    return {max(r.asDict(), key=lambda k: r[k])
            for r in df.select("positive", "negative", "neutral").collect()}


def test_model_loads_once_per_worker_over_runs(spark, tmp_path):
    log = str(tmp_path / "loads")
    par = spark.range(200).select(F.col("id").cast("string").alias("paragraph")).repartition(16)
    for _ in range(2):
        scorer = PandasModelScorer(_factory(log, 0))
        assert _winners(scorer.score(par)) == {"positive"}
    loads = open(log).read().split()
    assert len(loads) == len(set(loads))                     # no worker loaded it twice


def test_redefined_factory_gives_the_new_model(spark, tmp_path):
    par = spark.range(8).select(F.col("id").cast("string").alias("paragraph")).repartition(4)
    got = [_winners(PandasModelScorer(_factory(str(tmp_path / "l"), k)).score(par)) for k in (0, 1, 2)]
    assert got == [{"positive"}, {"negative"}, {"neutral"}]
