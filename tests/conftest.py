from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def make_session():
    from tidewatch.plans.local import ensure_shared_folder
    from tidewatch.session import build_session

    spark = build_session(
        "tidewatch-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_folder(spark)
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
