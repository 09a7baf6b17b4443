from datetime import datetime, timezone

import pytest

from sessionloom.operators import instants as I

CASES = [
    ("2025-11-02 01:30:00", "America/New_York", "2025-11-02T05:30:00"),  # occurs twice: the first
    ("2025-03-09 02:30:00", "America/New_York", "2025-03-09T07:30:00"),  # skipped: the offset before
    ("2025-10-05T02:10:00", "Australia/Sydney", "2025-10-04T16:10:00"),
    ("2025-08-05t12:19:26.142z", "UTC", "2025-08-05T12:19:26.142000"),
    ("Fri, 02 May 2025 15:39:59 +0545", "UTC", "2025-05-02T09:54:59"),
    ("Apr 1, 2025 8:38:08 PM EDT", "America/New_York", "2025-04-02T00:38:08"),
    ("20240903T042002Z", "UTC", "2024-09-03T04:20:02"),
    ("2024-09-21T15:28:53.427-04:00[America/New_York]", "UTC", "2024-09-21T19:28:53.427000"),
    ("2024-09-03T04:18:17.591956692Z", "UTC", "2024-09-03T04:18:17.591956"),
    ("03/04/2025 01:02:03 AM", "America/New_York", "2025-03-04T06:02:03"),
    ("03.04.2025 01:02:03", "Europe/Berlin", "2025-04-02T23:02:03"),
    ("03/04/2025", "Europe/London", "2025-04-02T23:00:00"),
    ("1725634698223795", "UTC", "2024-09-06T14:58:18.223795"),
    ("1729334248.932", "UTC", "2024-10-19T10:37:28.932000"),
    ("1725377052909", "UTC", "2024-09-03T15:24:12.909000"),
    ("2025-02-30 00:00:00", "UTC", None),
    ("Invalid Date", "UTC", None), ("", "UTC", None), (None, "UTC", None), ("NaT", "UTC", None), ("2025-01-01 10:00", None, None), ("2025-01-01 25:00", "UTC", None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, v, z, "clash") for i, (v, z, _) in enumerate(CASES)], "i int, value string, tz_name string, reading string")
    got = {r.i: r for r in I.normalise_instants(df).collect()}
    for i, (v, _, want) in enumerate(CASES):
        us = got[i].utc_us
        assert (us is None) == (want is None), v
        if want:
            assert us == int(datetime.fromisoformat(want).replace(tzinfo=timezone.utc).timestamp() * 1e6 + 0.5), v
            assert not got[i].ambiguous


def test_mixture_follows_the_data_where_there_is_no_custom():
    stats = {("UTC", "/"): {(True, True): 10, (False, True): 30}, ("America/New_York", "/"): {(True, True): 5}}
    fit = I.fit_orders(stats)
    assert fit["UTC", "/"][1] > 0.95 and fit["America/New_York", "/"][0] > 0.95


def test_unresolved_is_marked_and_empty_table(spark):
    df = spark.createDataFrame([("03/04/2025", "UTC")], "value string, tz_name string")
    assert I.normalise_instants(df).first().ambiguous
    assert I.normalise_instants(df.limit(0)).count() == 0
    with pytest.raises(Exception):
        I.normalise_instants(df, value="absent").count()
