"""Exactly-once drains with rejects."""

import json

import pytest

from lakeloom import schemas
from lakeloom.sources import streams
from lakeloom.sources.drain import Drain
from tests.test_streams import folder, json_folder

SOURCE = schemas.flat("value STRING, timestamp TIMESTAMP")
PAYLOAD = schemas.flat("id INT, name STRING, price DOUBLE")


def click(i, **more):
    return json.dumps({"id": i, "name": f"n{i}", "price": i / 2, **more})


def source(spark, texts, per_file=3):
    path = json_folder([{"value": t, "timestamp": f"2024-01-01 00:{i:02d}:00"} for i, t in enumerate(texts)], per_file)
    return streams.replay_files(spark, path, SOURCE)


TEXTS = [click(0), "not json", click(2), click(3), '{"id": "x", "price": 1}', None, '{"name": "no id"}', click(7), "[1, 2]",
         click(9, extra=1), "", '{"id": 11, "name": null}']
GOOD = [0, 2, 3, 7, 9, 11]


def test_rows_and_rejects(spark):
    drain = Drain(spark, folder() + "/clicks", PAYLOAD, "clicks", required=("id",))
    drain.start(source(spark, TEXTS), folder()).awaitTermination()
    rows = drain.rows().collect()
    assert sorted(r.id for r in rows) == GOOD and {r.id: r.price for r in rows}[7] == 3.5
    assert {r.timestamp.minute for r in rows} == set(GOOD)
    rejects = {r.timestamp.minute: (r.value, r.reason) for r in drain.rejects().collect()}
    assert {m: v for m, (v, _) in rejects.items()} == {m: t for m, t in enumerate(TEXTS) if m not in GOOD}
    assert rejects[1][1] == "not of the message's type" and rejects[5][1] == "no text" and rejects[6][1] == "missing: id"
    assert sorted((r.batch, r.rows, r.rejects) for r in drain.ledger().collect()) == [(0, 2, 1), (1, 1, 2), (2, 1, 2), (3, 2, 1)]


def test_a_batch_done_again_leaves_each_row_once(spark, monkeypatch):
    src, check = [click(i) if i % 4 else f"broken {i}" for i in range(12)], folder()
    stream_path = source(spark, src)
    drain = Drain(spark, folder() + "/clicks", PAYLOAD, "clicks")
    whole = Drain._done

    seen = []

    def fails(self, place):
        seen.append(place)
        if len(seen) == 3:
            raise OSError("lost")
        whole(self, place)

    monkeypatch.setattr(Drain, "_done", fails)
    with pytest.raises(Exception, match="lost"):
        drain.start(stream_path, check).awaitTermination()
    # the third batch has written its rows, but is not in the ledger
    assert sorted(r.id for r in drain.rows().collect()) == [1, 2, 3, 5]
    assert drain._stored("rows").where("batch = 2").count() > 0
    monkeypatch.setattr(Drain, "_done", whole)
    drain.start(stream_path, check).awaitTermination()
    assert sorted(r.id for r in drain.rows().collect()) == [i for i in range(12) if i % 4]
    assert sorted(r.value for r in drain.rejects().collect()) == ["broken 0", "broken 4", "broken 8"]
    again = spark.createDataFrame([(click(99), None)], SOURCE)
    drain.take(again, 2)        # a batch of that number replaces the one before
    assert sorted(r.id for r in drain.rows().collect()) == [1, 2, 3, 5, 9, 10, 11, 99]
    assert sorted(r.value for r in drain.rejects().collect()) == ["broken 0", "broken 4"]


def test_feeds_do_not_meet(spark):
    path = folder() + "/clicks"
    for feed in ("a", "b"):
        Drain(spark, path, PAYLOAD, feed).start(source(spark, [click(1), "bad"]), folder()).awaitTermination()
    drain = Drain(spark, path, PAYLOAD, "a")
    assert sorted((r.feed, r.id) for r in drain.rows().collect()) == [("a", 1), ("b", 1)]
    assert drain.rejects().count() == 2
