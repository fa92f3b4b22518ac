import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def spark_home():
    """A local-cluster master keeps its workers' folders in <Spark home>/work and ends
    the JVM if it can't.  For a home that can't be written there: one of links,
    with a work folder of its own."""
    import pyspark
    home = os.environ.get("SPARK_HOME") or os.path.dirname(os.path.abspath(pyspark.__file__))
    work = os.path.join(home, "work")
    if not os.access(work if os.path.lexists(work) else home, os.W_OK):
        own = tempfile.mkdtemp(prefix="runway-spark-home-")
        for name in os.listdir(home):
            if name != "work":
                os.symlink(os.path.join(home, name), os.path.join(own, name))
        os.environ["SPARK_HOME"] = own


@pytest.fixture(scope="session")
def spark():
    from runway.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", app="runway-tests", shuffle_partitions=8)
    # The session's own checkpoint folder wins; a fresh one only if unset.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="runway-ckpt-"))
    yield s
