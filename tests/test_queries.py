import numpy as np
import pytest

import __spark_entry__ as entry
from corvane import catalogue

Q, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, same_as_sql):
    same_as_sql(Q[name], SQL[name])


def test_all_queries_have_sql_but_the_projection():
    assert set(Q) - set(SQL) == {"pca_2d"}


def test_projection_equals_singular_vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    _, _, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    # Components of the rows as they are; signs by the largest loading.
    want = x @ np.stack([p * np.sign(p[np.abs(p).argmax()]) for p in v[:2]]).T
    got = {r["vec_id"]: (r["pc1"], r["pc2"]) for r in Q["pca_2d"](spark, sf_dir).collect()}
    assert len(got) == len(rows) and np.allclose([got[r["vec_id"]] for r in rows], want, atol=1e-4)


def test_model_answers_equal_a_direct_run(spark):
    from corvane.functions import signal
    from corvane.plans import models

    model, names = models.StandIn(), [f"species_{i}" for i in range(200)]
    want = {}
    for r in catalogue.generated(spark, broken=False).collect():
        for i, part in enumerate(signal.frames(signal.load(bytes(r["content"])))):
            _, logits = model(signal.prepared(part)[None])
            want[r["path"], i] = [names[j] for j in np.lexsort((-np.arange(200), -logits[0]))[:10]]  # of equals the later first
    got = {(r["file_path"], r["chunk_idx"]): [t["species"] for t in r["topk"]] for r in models.infer(catalogue.generated(spark, broken=False), models.StandIn, names, key="direct").collect()}
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
