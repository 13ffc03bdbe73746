import datetime as dt
import json
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)


def schema(stream, properties, keys=()):
    return {"type": "SCHEMA", "stream": stream, "schema": {"properties": properties}, "key_properties": list(keys)}


def record(stream, body, extracted=None, **more):
    message = {"type": "RECORD", "stream": stream, "record": body, **more}
    return {**message, "time_extracted": extracted} if extracted else message


def state(value):
    return {"type": "STATE", "value": value}


def text(messages):
    return [m if isinstance(m, str) else json.dumps(m) for m in messages]


def lines(spark, messages):
    """Messages as a one-partition frame, so that their order is the given one."""
    return spark.createDataFrame([(line,) for line in text(messages)], "payload STRING").coalesce(1)


def write_log(path, messages):
    Path(path).mkdir(parents=True, exist_ok=True)
    (Path(path) / "part.jsonl").write_text("\n".join(text(messages)) + "\n")
    return str(path)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
