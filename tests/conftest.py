import json

import pytest

from parcelflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[3]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def feed(spark):
    """Envelopes as dicts -> raw feed; the position in the list is the arrival order."""

    def make(*envelopes):
        rows = [(e if isinstance(e, str) else json.dumps(e), i) for i, e in enumerate(envelopes)]
        return spark.createDataFrame(rows, "value STRING, seq BIGINT")

    return make


def change(table, op, ts, after=None, before=None):
    return {"op": op, "ts_ms": ts, "source": {"table": table, "db": "x"}, "before": before, "after": after, "transaction": None}


def order(op, ts, status="60010", old=None, order_id="1", **more):
    after = {
        "id": order_id,
        "status": status,
        "sender_name": "Anna",
        "receiver_name": "Li",
        "amount": 12.5,
        "estimate_arrive_time": 1_699_264_800_000,
        "create_time": "2023-11-06T02:00:00Z",
        "update_time": "2023-11-06T03:00:00Z",
        **more,
    }
    return change("order_info", op, ts, after, {"id": order_id, "status": old} if old else None)


def cargo(op, ts, cargo_id="g1", order_id="1", **more):
    after = {
        "id": cargo_id,
        "order_id": order_id,
        "cargo_type": "82001",
        "volumn_length": 10,
        "weight": 1.25,
        "create_time": "2023-11-06T02:07:00Z",
        **more,
    }
    return change("order_cargo", op, ts, after)
