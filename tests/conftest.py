from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

from corpus_rows import DOCS

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("passagerank-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.createDataFrame(DOCS, "doc_id BIGINT, text STRING")


@pytest.fixture(scope="session")
def index(spark, corpus, tmp_path_factory):
    from passagerank.operators.index import build_index

    path = str(tmp_path_factory.mktemp("index") / "plain")
    return build_index(corpus, path, stemmer=None, shards=3, term_slots=4)


@pytest.fixture(scope="session")
def topics(spark):
    rows = [(1, "red car"), (2, "cat cat mat"), (3, ""), (4, "the of"), (5, "zebra"), (6, "The cat's bus")]
    return spark.createDataFrame(rows, "qid BIGINT, query STRING")
