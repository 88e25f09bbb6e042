import os
import re
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from threadlens.scale import IN_PLACE_SETTINGS


def exchanged_columns(df):
    """Names of the columns that the plan of a DataFrame, once run, sends through an Exchange."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree = plan.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    final = set(re.findall(r"\((\d+)\)", tree))
    nodes = re.findall(r"\n\((\d+)\) (\w*Exchange)\b[^\n]*\n(?:Output[^\n]*\n)?Input \[\d+\]: \[([^\n]*)\]", plan)
    return [{re.sub(r"#\d+L?$", "", column.strip()) for column in columns.split(",")} for number, _, columns in nodes if number in final], plan


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config(map=IN_PLACE_SETTINGS)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
