import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from instrel.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


def package_frame(spark, *packages, instruction="i"):
    """Nested packages from lists of (label, confidence) or response dictionaries."""
    from instrel.schemas import PACKAGES

    fields = ("id", "label", "neg_type", "title", "passage", "explanation", "why_relevant", "confidence", "evidence")
    rows = []
    for n, items in enumerate(packages):
        responses = []
        for i, item in enumerate(items):
            if not isinstance(item, dict):
                item = {"label": item[0], "confidence": item[1]}
            item = {"id": i, "passage": f"p{i}", "evidence": [], **item}
            if item.get("confidence") is not None:
                item["confidence"] = float(item["confidence"])
            responses.append(tuple(item.get(f) for f in fields))
        rows.append((n, 0, f"q{n}", f"a{n}", instruction, "persona", "short", responses))
    return spark.createDataFrame(rows, PACKAGES)


def score_frame(spark, scores, label="positive"):
    return spark.createDataFrame([(label, float(x)) for x in scores], "label string, confidence double")


def text_frame(spark, *texts):
    return spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "id bigint, choice_index int, response string")
