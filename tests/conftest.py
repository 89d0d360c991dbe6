import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir is left as the environment has it; when it is
    # unset, tidemark.session.shared_dir gives a local session a temporary one.
    extra = {"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-test-warehouse-")}
    s = build_session("local[*]", app_name="tidemark-tests", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from tidemark.session import scratch_path

    return scratch_path(spark, request.node.name.replace("[", "_").replace("]", "_"))
