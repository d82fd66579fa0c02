import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from dayfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def warehouse(spark, tmp_path):
    """A warehouse with the parameter tables of the seed: three countries, two sources."""
    from dayfold import schemas
    from dayfold.sources.warehouse import Warehouse

    house = Warehouse(spark, str(tmp_path / "warehouse"))
    countries = spark.createDataFrame(
        [(1, "USA", "United States of America", "38.8951", "-77.0364"), (2, "DEU", "Germany", "52.52", "13.405"),
         (3, "JPN", "Japan", "35.6895", "139.6917")],
        "id bigint, code string, name string, latitude string, longitude string",
    )
    house.overwrite("country", countries.selectExpr(
        "id", "code", "name", "cast(latitude as decimal(9,6)) latitude", "cast(longitude as decimal(9,6)) longitude"
    ))
    house.overwrite("api_info", spark.createDataFrame(
        [(1, "Weather API", "https://weather.example/v1"), (2, "COVID API", "https://covid.example/total")],
        schemas.API_INFO.schema,
    ))
    return house


@pytest.fixture(scope="session")
def codebook_path(tmp_path_factory):
    """A small codebook with quoted commas."""
    path = tmp_path_factory.mktemp("book") / "codes.csv"
    path.write_text('Weather Code,Description\n0,Clear\n3,"Clouds, growing"\n61,"Rain, ""light"", steady"\n99,\n')
    return str(path)


def rows(frame, *columns):
    """Rows as sorted tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
