import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from litscreen.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "litscreen-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return SMALL


ARTICLE = (
    '<article><front><abstract><sec><title>Aims</title><p>The "first" &amp; <i>only</i> part.</p></sec>\n'
    "<p>Second\n   line.</p></abstract></front><body><p>Text</p></body></article>"
)


@pytest.fixture()
def corpus(tmp_path):
    """Landed articles: good, without elements, copied, not UTF-8, and out of place."""
    contents = {
        "qA/101.xml": ARTICLE,
        "qA/102.xml": "<article><front/></article>",
        "qB/101.xml": ARTICLE.replace("Second", "Other"),
        "qB/103.xml": "<article><abstract><title>none</title></abstract></article>",
        "qB/104.xml": b"<abstract><p>\xff\xfe</p></abstract>",
        "qB/105.XML": ARTICLE,
        "stray.xml": ARTICLE,
        "qB/deep/106.xml": ARTICLE,
        "(a Mü [x]/107.xml": ARTICLE,
    }
    for name, content in contents.items():
        path = tmp_path / "landed" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(tmp_path / "landed")
