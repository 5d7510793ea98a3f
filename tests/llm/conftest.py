from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from rainloom.llm import common  # noqa: E402
from rainloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    common.tune_arrow(session)
    yield session


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names operators use inside."""
    def make(pairs):
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        frame = spark.createDataFrame(rows, DOCUMENT)
        from pyspark.sql import functions as F

        for name in ("fp", "root", "size", "kept", "word", "label", "n_words", "key", "shard", "_key", "_at", "_kept", "t", "row", "id", "block", "_found", "rank", "stack", "items", "held_out"):
            frame = frame.withColumn(name, F.lit("extra"))
        return frame

    return make


HARD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, "A b\x0bc\x85d é f"),
    (7, "word " * 30000), (8, "same line\nsame line\n\nsame line "), (8, "same line\nsame line\n\nsame line "),
    (9, "éa " * 50 + "##$"), (None, "no id here at all"), (10, "tail\n"), (11, "\n\n"), (12, "x" * 70000),
]
