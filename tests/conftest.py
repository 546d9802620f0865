from __future__ import annotations

import pytest

from starmart import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def named(spark):
    """Small lookups: ports, countries and modes."""
    from starmart import schemas
    from starmart.sources import lookups

    rows = {
        schemas.PORT: [("P1", "HARBOR, AA"), ("P2", "INLAND"), ("P3", "PASS, OLD ROAD, BB")],
        schemas.COUNTRY: [("101", "AVALON"), ("102", "BRASIL"), ("0", "INVALID: NONE")],
        schemas.MODE: [("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not reported")],
    }
    return {name: lookups.from_rows(spark, table) for name, table in rows.items()}


ARRIVAL = {
    "cicid": 1.0,
    "i94cit": 101.0,
    "i94res": 102.0,
    "i94port": "P1",
    "arrdate": 20573.0,
    "depdate": 20580.0,
    "i94mode": 1.0,
    "i94bir": 30.0,
    "biryear": 1986.0,
    "gender": "F",
    "visatype": "B1",
    "visapost": "POST",
    "i94visa": 1.0,
}


@pytest.fixture
def arrivals(spark):
    """Builds arrivals from changes to one valid row; `without` leaves columns out."""
    from starmart import schemas

    def build(*changes: dict, without: tuple[str, ...] = ()):
        rows = [tuple({**ARRIVAL, **change}[f.name] for f in schemas.ARRIVALS.fields) for change in changes]
        return spark.createDataFrame(rows, schemas.ARRIVALS).drop(*without)

    return build
