"""The router's keyed state: what a batch takes, later batches and restarts know; held shipments come out once."""

import datetime as dt
import json
import os
import time

import pytest

from tallyloom.operators import ingest, ledger
from tallyloom.streaming import router

QUEUE = ("id bigint, created_at timestamp_ntz, s3_updated_at timestamp_ntz, s3_filename string, s3_line_num int, message_type string, json_data string,"
         " message_uuid string, order_id bigint, credit_id bigint, card_id bigint, customer_id bigint")
T0 = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)


def deliver(spark, folder, *messages):
    """One more file of (id, type, minutes, document)."""
    rows = [(i, T0, T0 + dt.timedelta(minutes=m), "f", 1, kind, json.dumps(doc), None, None, None, None, None) for i, kind, m, doc in messages]
    spark.createDataFrame(rows, QUEUE).coalesce(1).write.mode("append").parquet(f"{folder}/incoming")


def route(spark, folder, wait=router.WAIT, **limits):
    schema = spark.createDataFrame([], QUEUE).schema
    stream = spark.readStream.schema(schema).options(**limits).parquet(f"{folder}/incoming")
    xref = spark.createDataFrame([(1, False), (2, True)], "fc_id int, is_hj boolean")
    query = router.start_router(stream, folder, xref, wait)
    query.awaitTermination()
    return query, sorted((r.id, r.fate) for r in router.events(spark, folder, schema).select("id", "fate").collect())


def part(order, uuid, last):
    return {"order_id": order, "message_uuid": uuid, "is_last_hj_shipment": last, "items": [{"item_id": 1, "fc_detail": {"fc": ["2"], "units_shipped": 1}}]}


def test_keys_are_known_to_later_batches_and_restarts(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, (1, "ocn", 5, {"order_id": 7}), (2, "ocn", 3, {"order_id": 7}), (3, "oc", 0, {"order_id": 7}), (4, "oc", 1, {"order_id": 7}))
    _, got = route(spark, folder)
    assert got == [(1, "error"), (2, "queue"), (3, "queue"), (4, "queue")]
    # an earlier time in a later batch comes too late; so it does in a new run on the same folder
    deliver(spark, folder, (5, "ocn", 0, {"order_id": 7}), (6, "oc", 0, {"order_id": 7}), (7, "oc", 0, {"order_id": 8}), (8, "cm", 0, {}))
    _, got = route(spark, folder)
    assert got[4:] == [(5, "error"), (6, "known"), (7, "queue"), (8, "queue")]
    assert route(spark, folder)[1] == got
    staged = spark.read.schema("order_id bigint, created_at timestamp_ntz").parquet(f"{folder}/staging/oc")
    assert sorted(r.order_id for r in staged.collect()) == [7, 7, 8]


def test_a_held_shipment_comes_out_once(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, (1, "of", 0, part(5, "a", False)), (2, "of", 1, part(6, "b", False)))
    assert route(spark, folder)[1] == [(1, "unprocessed"), (2, "unprocessed")]
    deliver(spark, folder, (3, "of", 2, part(5, "c", True)))
    got = route(spark, folder)[1]
    assert got == [(1, "released"), (1, "unprocessed"), (2, "unprocessed"), (3, "queue")]
    # a part that comes after the last one waits for nothing; the same message again is known
    deliver(spark, folder, (4, "of", 3, part(5, "d", False)), (5, "of", 4, part(5, "a", False)))
    got = route(spark, folder)[1]
    assert [e for e in got if e[0] in (1, 4, 5)] == [(1, "released"), (1, "unprocessed"), (4, "released"), (4, "unprocessed"), (5, "known"), (5, "unprocessed")]
    staged = spark.read.schema("message_uuid string, updated_at timestamp_ntz").parquet(f"{folder}/staging/of")
    assert sorted(r.message_uuid for r in staged.collect()) == ["a", "c", "d"]


def test_a_held_shipment_comes_out_when_its_time_is_up(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, (1, "of", 0, part(5, "a", False)))
    assert route(spark, folder, wait=0.5)[1] == [(1, "unprocessed")]
    time.sleep(1)
    deliver(spark, folder, (2, "oc", 0, {"order_id": 1}))
    assert route(spark, folder, wait=0.5)[1] == [(1, "released"), (1, "unprocessed"), (2, "queue")]
    deliver(spark, folder, (3, "oc", 0, {"order_id": 2}))
    assert route(spark, folder, wait=0.5)[1] == [(1, "released"), (1, "unprocessed"), (2, "queue"), (3, "queue")]


def test_a_batch_reads_its_own_file_only(spark, tmp_path):
    folder = str(tmp_path)
    for k in range(8):
        deliver(spark, folder, *[(100 * k + i, "oc", i, {"order_id": 100 * (k // 2) + i}) for i in range(20)])
    query, got = route(spark, folder, maxFilesPerTrigger=1)
    rows = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert rows == [20] * 8 and len(os.listdir(f"{folder}/routed")) >= 8
    assert [f for _, f in got].count("queue") == 80 and [f for _, f in got].count("known") == 80


def test_held_test_agrees_with_the_batch_operator(spark):
    docs = [part(1, "a", False), part(1, "b", True), part(1, "c", None), {"order_id": 1, "is_last_hj_shipment": False}, {"is_last_hj_shipment": False, "items": [
        {"fc_detail": {"fc": ["1"]}}, {"fc_detail": {"fc": ["1", "2"]}}, {"fc_detail": None}]}, {"is_last_hj_shipment": False, "items": [{"fc_detail": {"fc": ["1"]}}]}]
    rows = [(i, T0, T0, "f", 1, "of", json.dumps(d), None, None, None, None, None) for i, d in enumerate(docs)]
    queue = spark.createDataFrame(rows, QUEUE)
    held, _ = ingest.hold_partial_shipments(queue, spark.createDataFrame([(1, False), (2, True)], "fc_id int, is_hj boolean"))
    waits, _ = ingest.shipment_parts(["2"])
    assert sorted(r.id for r in held.collect()) == sorted(r.id for r in queue.filter(waits).collect()) == [0, 4]


def test_two_held_shipments_of_one_key_are_released_once(spark, tmp_path):
    folder = str(tmp_path)
    deliver(spark, folder, (1, "of", 0, part(5, "a", False)), (2, "of", 1, part(5, "a", False)), (3, "of", 0, part(6, "a", None)))
    assert route(spark, folder)[1] == [(1, "unprocessed"), (2, "unprocessed"), (3, "queue")]
    deliver(spark, folder, (4, "of", 2, part(5, "b", True)))
    got = route(spark, folder)[1]
    assert sorted(f for i, f in got if i in (1, 2)) == ["known", "released", "unprocessed", "unprocessed"] and (4, "queue") in got
    deliver(spark, folder, (5, "of", 3, part(5, "a", None)))
    assert (5, "known") in route(spark, folder)[1]


def test_keys_are_a_built_in_aggregate(spark):
    rows = spark.createDataFrame([("oc", "", "1", (1, 5, 2, 0)), ("oc", "", "1", (0, 9, 1, 3)), ("of", "7", "a", None)],
                                 "kind string, family string, key string, first struct<batch: bigint, at: bigint, id: bigint, row: bigint>")
    first = router.first_of_key(rows)
    assert sorted((r.key, r.first and tuple(r.first)) for r in first.collect()) == [("1", (0, 9, 1, 3)), ("a", None)]
    assert not any(n in first._jdf.queryExecution().toString() for n in ("Pandas", "Python", "Arrow"))


def files(folder, name):
    return [f for _, _, names in os.walk(f"{folder}/{name}") for f in names if f.endswith(".parquet")]


def test_a_retry_goes_on_with_the_pieces_that_are_left(spark, tmp_path, monkeypatch):
    """Four parts in two pieces; the first run dies when a part of the second goes.  In the end no working copy is left."""
    folder = str(tmp_path)
    monkeypatch.setattr(router, "PIECE", 8)  # a task reads two files with two messages each
    for k in range(8):
        deliver(spark, folder, (10 * k + 1, "ocn", k, {"order_id": k % 4}), (10 * k + 2, "of", k, part(k % 3, str(k), k == 7)))
    gone, remove = [], ledger.remove

    def dies(session, path):
        gone.append(path)
        remove(session, path)
        if len(gone) == 3:
            raise OSError("the first run ends here")

    with monkeypatch.context() as first:
        first.setattr(ledger, "remove", dies)
        with pytest.raises(Exception, match="the first run ends here"):
            route(spark, folder)
    assert len(files(folder, "keyed")) == 2  # a part and the one of released shipments
    _, got = route(spark, folder)
    assert got == sorted([(10 * k + 1, "queue" if k < 4 else "error") for k in range(8)] + [(10 * k + 2, "unprocessed") for k in range(7)]
                         + [(12, "released"), (42, "released"), (72, "queue")])
    assert not any(files(folder, name) for name in ("keyed", "first", "fates"))
    taken = spark.read.schema("message_uuid string, updated_at timestamp_ntz").parquet(f"{folder}/staging/of")
    assert sorted(r.message_uuid for r in taken.collect()) == ["1", "4", "7"]


def test_tables_are_packed_and_messages_are_kept_once(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = [(i, T0, T0, "f", 1, "oc", json.dumps({"order_id": i}), None, None, None, None, None) for i in range(20)]
    xref = spark.createDataFrame([(2, True)], "fc_id int, is_hj boolean")
    got = router.run_once(spark.createDataFrame(rows, QUEUE), folder, xref)
    assert sorted((r.id, r.fate) for r in got.collect()) == [(i, "queue") for i in range(20)]
    kept = [f for name in ("incoming", "routed", "staging") for f in files(folder, name)]
    assert kept and all(f.endswith(".zstd.parquet") for f in kept)
    assert not any(files(folder, name) for name in ("keyed", "marks", "first", "fates"))
