import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pitchstar.session import get_session
    work = tempfile.mkdtemp(prefix="pitchstar-test-")
    s = get_session("local[4]", app="pitchstar-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": f"{work}/wh",
                           "spark.checkpoint.dir": f"{work}/ck"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star(spark):
    from pitchstar.registry import star_of
    return star_of(spark, SF0001)
