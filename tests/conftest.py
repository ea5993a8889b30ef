from __future__ import annotations

import datetime as dt

import pytest

from footfall.schema import BEHAVIOR_EVENT
from footfall.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


_DEFAULTS = {
    "device_id": "d",
    "device_model": "m",
    "os_version": "o",
    "app_version": "a",
    "session_id": "",
    "page": "home",
    "ip": "10.0.0.1",
    "city": "c",
    "duration": 0,
    "properties": "{}",
    "source": "simulator",
    "experiment_id": "",
    "variant": "",
}


@pytest.fixture
def make_events(spark):
    """Events from ``(user, type, "yyyy-mm-dd hh:mm:ss", {column: value})``."""

    def make(rows, repeat_ids: bool = False):
        full = []
        for i, row in enumerate(rows):
            user, kind, time, *more = row
            at = dt.datetime.fromisoformat(time)
            event = {"event_id": f"e{i}", "user_id": user, "event_type": kind, "event_time": at, "server_time": at}
            full.append({**_DEFAULTS, **event, **(more[0] if more else {})})
        names = BEHAVIOR_EVENT.fieldNames()
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], BEHAVIOR_EVENT)

    return make


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
