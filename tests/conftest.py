import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mensura.session import local_session

    session = local_session(app="tests", memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def green(spark):
    import rows

    return rows.sources(spark, rows.GREEN)


@pytest.fixture(scope="session")
def layers(spark, green):
    """All tables over the sound rows."""
    from mensura.plans.models import MODELS

    tables = dict(green)
    for name, model in MODELS.items():
        tables[name] = model.build(tables).cache()
    return tables
