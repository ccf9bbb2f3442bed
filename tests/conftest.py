import os
import sys
import tempfile

import pytest

from support import FIXTURES, ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from patchlens.session import checkpoint_dir, get_session
    s = get_session("local[4]", 8)
    # tests run locally: only here is a checkpoint folder installed by us
    checkpoint_dir(s, tempfile.mkdtemp(prefix="patchlens-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="patchlens-test-", dir="/tmp")


@pytest.fixture(scope="session")
def bulletins(spark):
    from patchlens.sources.xml_bulletins import read_bulletins
    return read_bulletins(spark, os.path.join(FIXTURES, "bulletins", "*.xml"))


@pytest.fixture(scope="session")
def staging(bulletins):
    from patchlens.plans.shred import shred
    return shred(bulletins)


@pytest.fixture(scope="session")
def host_tables(spark):
    from patchlens import schemas
    patches = spark.read.schema(schemas.HOST_PATCHES).json(os.path.join(FIXTURES, "hosts", "patches.jsonl"))
    osv = spark.read.schema(schemas.HOST_OS).json(os.path.join(FIXTURES, "hosts", "os_versions.jsonl"))
    return patches, osv
