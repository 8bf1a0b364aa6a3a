import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="feedspark-tests")
    yield s


def write_doc(folder, name, doc, *, raw=False):
    """One feed document per file (the landing format of the feed provider)."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(doc if raw else json.dumps(doc, ensure_ascii=False, indent=2))
    return path


def envelope(tenant="T1", ts="2018-01-02-10-00-00", feed="ADVERTISER", **extra):
    doc = {"moSystem": "OO", "tenant": tenant, "system": "NATIONAL", "feedType": feed, "filename": "f", "extractdatetime": ts}
    doc.update(extra)
    return doc
