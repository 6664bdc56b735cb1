import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from statloom.session import build_session  # noqa: E402

# The worked regression example: x1, x2, yield.
WORKED = [(41.9, 29.1, 251.3), (43.4, 29.3, 251.3), (43.9, 29.5, 248.3), (44.5, 29.7, 267.5), (47.3, 29.9, 273.0),
          (47.5, 30.3, 276.5), (47.9, 30.5, 270.3), (50.2, 30.7, 274.9), (52.8, 30.8, 285.0), (53.2, 30.9, 290.0),
          (56.7, 31.5, 297.0), (57.0, 31.7, 302.5), (63.5, 31.9, 304.5), (65.3, 32.0, 309.3), (71.1, 32.1, 321.7),
          (77.0, 32.5, 330.7), (77.8, 32.9, 349.0)]


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def worked(spark):
    return spark.createDataFrame(WORKED, "x1 double, x2 double, yield double")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
