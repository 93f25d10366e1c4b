import json

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfwise import tune
from shelfwise.operators import bronze_events, parse_lines
from tests.fixtures import EDGE_LINES, SAMPLE_EVENTS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        # Tests read filters from plans; numbers of columns grow in a long session, and long texts are cut.
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def make_bronze(spark):
    """Bronze rows from lines of text, or from events as dicts."""

    def make(lines):
        texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
        return bronze_events(parse_lines(spark.createDataFrame([(t,) for t in texts], "value string")))

    return make


@pytest.fixture
def sample(make_bronze):
    return make_bronze(SAMPLE_EVENTS)


@pytest.fixture
def edges(make_bronze):
    return make_bronze(EDGE_LINES)


@pytest.fixture
def stored(spark, tmp_path):
    """The same rows read back from Parquet, all of them in one file."""

    def store(df, name="stored"):
        path = str(tmp_path / name)
        df.coalesce(1).write.parquet(path)
        return spark.read.parquet(path)

    return store


def rows(df):
    """The rows as plain tuples, with decimals as int, in a stable order."""
    out = []
    for row in df.collect():
        out.append(tuple(int(v) if type(v).__name__ == "Decimal" else v for v in row))
    return sorted(out, key=repr)


@pytest.fixture
def write_lines(spark):
    """Write lines as one raw file."""

    def write(path, lines):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")

    return write


def column(df, name):
    return [row[0] for row in df.select(F.col(name)).collect()]
