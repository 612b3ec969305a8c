import json

import pytest
from test_functions import U, V, encode

from tallybook.operators import admission
from tallybook.schemas import JSON_BATCH, MAX_BATCH_ROWS, MAX_BODY_BYTES, PROTO_BATCH


def item(amount="100", **more):
    fields = {"id": json.dumps(U), "account_id": json.dumps(V), "amount": amount, **more}
    return "{" + ",".join(f'"{k}":{v}' for k, v in fields.items() if v is not None) + "}"


ONE = "[" + item() + "]"
BODIES = [
    (ONE, 1),
    ("[]", 0),
    (" [ ] ", 0),
    ("null", 0),
    ("[" + item() + "," + item("-5") + "]", 2),
    ("[" + item(str(2**63 - 1)) + "]", 1),
    ("[" + item(str(-(2**63))) + "]", 1),
    ("[" + item(extra='{"amount":"x"}') + "]", 1),
    ("[" + item(id='"urn:uuid:%s"' % U) + "]", 1),
    (None, "invalid_body"),
    ("", "invalid_body"),
    ("[", "invalid_body"),
    ("no json", "invalid_body"),
    (item(), "invalid_body"),
    ("[1]", "invalid_body"),
    ("[null]", "invalid_body"),
    (ONE + " x", "invalid_body"),
    (ONE + "," + ONE, "invalid_body"),
    (ONE + "] [", "invalid_body"),
    ("[" + item("1.5") + "]", "invalid_body"),
    ("[" + item("100.0") + "]", "invalid_body"),
    ("[" + item("1e2") + "]", "invalid_body"),
    ("[" + item('"100"') + "]", "invalid_body"),
    ("[" + item("true") + "]", "invalid_body"),
    ("[" + item("null") + "]", "invalid_body"),
    ("[" + item("9" * 20) + "]", "invalid_body"),
    ("[" + item(str(2**63)) + "]", "invalid_body"),
    ("[" + item(amount=None) + "]", "invalid_body"),
    ("[" + item(id=None) + "]", "invalid_body"),
    ("[" + item(account_id=None) + "]", "invalid_body"),
    ("[" + item(id='"zz"') + "]", "invalid_body"),
    ("[" + item(id="5") + "]", "invalid_body"),
    ("[" + item() + "," + item("1.5") + "]", "invalid_body"),
]


def test_json_bodies(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], JSON_BATCH)
    judged = admission.judge_json_batches(df)
    answers = {r["batch_id"]: r for r in admission.responses(judged).collect()}
    reasons = {r["batch_id"]: r["reason"] for r in admission.rejected_batches(judged).collect()}
    for i, (body, want) in enumerate(BODIES):
        got = answers[i]
        if isinstance(want, int):
            assert (got["status"], got["created_count"], i in reasons) == (201, want, False), body
        else:
            assert (got["status"], got["created_count"], reasons[i]) == (400, None, want), body
    rows = admission.decode_json_batches(df).collect()
    assert len(rows) == sum(w for _, w in BODIES if isinstance(w, int))
    assert {(r["id"], r["account_id"]) for r in rows} == {(U, V)}
    assert [r["pos"] for r in rows if r["batch_id"] == 4] == [0, 1]


def test_limits(spark):
    full = "[" + ",".join([item()] * MAX_BATCH_ROWS) + "]"
    over = "[" + ",".join([item()] * (MAX_BATCH_ROWS + 1)) + "]"
    widest = "[]" + " " * (MAX_BODY_BYTES - 2)
    bodies = [full, over, widest, widest + " ", over[:-1]]
    df = spark.createDataFrame(list(enumerate(bodies)), JSON_BATCH)
    judged = admission.judge_json_batches(df).select("batch_id", "reason").collect()
    want = [None, "too_many_rows", None, "body_too_large", "invalid_body"]
    assert [r["reason"] for r in sorted(judged)] == want


def frame(message: bytes) -> bytes:
    return b"\x0a" + bytes([len(message)]) + message


def test_proto_bodies(spark):
    sent = [0, 1, -1, 127, 128, 2**63 - 1, -(2**63)]
    good = b"".join(frame(encode(n)) for n in sent)
    bodies = [good, b"", good[:-1], good + b"\x00", frame(encode(1, first=b"a" * 15)), b"\x12\x00", None]
    df = spark.createDataFrame(list(enumerate(bodies)), PROTO_BATCH)
    answers = admission.responses(admission.judge_proto_batches(df), "frames").orderBy("batch_id").collect()
    assert [r["created_count"] for r in answers] == [len(sent), 0, None, None, None, None, None]
    rows = admission.decode_proto_batches(df).orderBy("batch_id", "pos").collect()
    assert [(r["id"], r["amount"]) for r in rows] == [(U, n) for n in sent]


@pytest.mark.parametrize("rows, reason", [(MAX_BATCH_ROWS, None), (MAX_BATCH_ROWS + 1, "too_many_rows")])
def test_proto_row_limit(spark, rows, reason):
    df = spark.createDataFrame([(0, frame(encode(7)) * rows)], PROTO_BATCH)
    assert admission.judge_proto_batches(df).first()["reason"] == reason


def test_other_proto_layouts(spark):
    """Unknown fields and other orders reject their request; the usual layout passes, a padded amount too."""
    whole = encode(300)
    turned = whole[18:36] + whole[:18] + whole[36:]
    bodies = [frame(whole), frame(turned), frame(whole + b"\x20\x05"), frame(whole[:36] + b"\x18\xac\x82\x00"), frame(whole) + b"\x10\x01"]
    df = spark.createDataFrame(list(enumerate(bodies)), PROTO_BATCH)
    judged = admission.judge_proto_batches(df)
    counts = [r["created_count"] for r in admission.responses(judged, "frames").orderBy("batch_id").collect()]
    assert counts == [1, None, None, 1, None]
    assert [r["amount"] for r in admission.accepted_frames(judged).collect()] == [300, 300]
