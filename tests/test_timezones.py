from datetime import datetime

import pytest

from tidewright.functions import timezones as tz
from test_merge import rows

NY = "America/New_York"


@pytest.fixture
def frame(spark):
    return spark.sql(
        """SELECT * FROM VALUES
        (1, TIMESTAMP_NTZ'2025-01-15 12:00:00', TIMESTAMP'2025-01-01 00:00:00'),
        (2, TIMESTAMP_NTZ'2025-03-09 02:30:00', NULL),
        (3, TIMESTAMP_NTZ'2025-11-02 01:30:00', NULL),
        (4, NULL, NULL) AS t(id, x, z)"""
    )


EXPECTED = [
    (1, datetime(2025, 1, 15, 17)),
    (2, datetime(2025, 3, 9, 7, 30)),
    (3, datetime(2025, 11, 2, 5, 30)),
    (4, None),
]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_shift_does_not_depend_on_the_session_zone(spark, frame, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = tz.apply_timezone_conversion(frame, source_timezone=NY, select_columns="id, x")
        assert out.columns == ["id", "x_utc"] and rows(out) == EXPECTED
        instants = out.select(tz.utc_instant(out.x_utc).cast("long").alias("s")).collect()
        assert instants[0]["s"] == 1736960400
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_names_and_selection(spark, frame):
    kept = tz.apply_timezone_conversion(frame, source_timezone=NY, convert_to_utc=False, select_columns=["id", "x"])
    assert kept.columns == ["id", "x"] and rows(kept) == EXPECTED
    everything = tz.apply_timezone_conversion(frame, source_timezone=NY)
    assert everything.columns == ["id", "x_utc", "z"]
    assert tz.apply_timezone_conversion(frame, source_timezone=NY, select_columns="*").columns == everything.columns
    without = tz.apply_timezone_conversion(frame.select("id"), source_timezone=NY)
    assert without.columns == ["id"]
    also = tz.apply_timezone_conversion(frame, source_timezone=NY, also=["x"])
    assert also.columns == ["id", "z", "x"]


def test_zone_is_required(frame):
    with pytest.raises(ValueError, match="source_timezone"):
        tz.apply_timezone_conversion(frame)


def test_detection_and_cast(frame):
    assert tz.get_timestamp_columns(frame) == ["x"]
    assert tz.get_timestamp_columns(frame, include_ntz=False, include_tz=True) == ["z"]
    assert tz.get_timestamp_columns(frame, include_tz=True) == ["x", "z"]
    cast = tz.cast_timestamps(frame, "id, x", ["x"])
    assert dict(cast.dtypes) == {"id": "int", "x": "timestamp"}
    assert cast.first()["x"] == datetime(2025, 1, 15, 12)
