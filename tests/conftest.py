import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wideloom.session import local_session

    s = local_session(8, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def emb(spark):
    from wideloom.plans.registry import embeddings

    df = embeddings(lambda t: spark.read.parquet(f"{SF}/{t}.parquet")).persist()
    df.count()
    return df


@pytest.fixture(scope="session")
def x(emb):
    return np.array([r["v"] for r in emb.orderBy("vec_id").collect()])


@pytest.fixture(scope="session")
def y(emb):
    return np.array([r["label"] for r in emb.orderBy("vec_id").collect()])


def rows(df, key, *cols):
    """Column values in key order."""
    got = df.orderBy(key).select(*cols).collect()
    return np.array([r[0] for r in got]) if len(cols) == 1 else np.array([tuple(r) for r in got])
