import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tessera.session import local_session

    # TESSERA_TEST_ANSI=false runs the suite as on a Spark 3.x-style session.
    # TESSERA_TEST_AQE=false runs it without adaptive execution.
    s = local_session(cores="*", shuffle_partitions=8,
                      extra={"spark.sql.ansi.enabled": os.environ.get("TESSERA_TEST_ANSI", "true"),
                             "spark.sql.adaptive.enabled": os.environ.get("TESSERA_TEST_AQE", "true")})
    # Tests own their session, so they may set the checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return SF["0.001"]
