import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wavemeter.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def facts(spark):
    """Make metric facts from (time, overrides) pairs."""
    from pyspark.sql import functions as F

    from wavemeter.model import METRICS

    defaults = {
        "dn": "dn-1", "additionalDn": "dev-1", "metricId": "m-1", "formulaId": "f-1",
        "pollingRuleId": "p-1", "functionId": "fn-1", "managedObjectId": "mo-1",
        "equipmentId": "eq-1", "equipmentTypeId": "et-1", "locationId": "loc-1",
        "vendorId": "v-1", "sourceVendor": "sv-1", "sourceSystem": "SYS", "elementType": "CELL",
        "managerIp": "192.0.2.1", "managerFilename": "file", "category": "c",
        "networkGroups": ["g-1"], "enrichment": '{"location":{"CITY":"x"}}', "isRate": False,
        "reportInterval": 300, "granularityInterval": "PT300S", "value": 1.0, "numerator": None,
        "denominator": None,
    }

    def make(rows):
        from datetime import datetime

        data = []
        for stamp, overrides in rows:
            record = {"__time": datetime.fromisoformat(stamp), **defaults, **overrides}
            data.append(tuple(record[f.name] for f in METRICS.fields))
        return spark.createDataFrame(data, METRICS).withColumn(
            "enrichment", F.coalesce("enrichment", F.lit("{}"))
        )

    return make
