"""S8, P8-P13 on FIXTURES F4 rows."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import normalise_edits, parse_raw_edits


def _raw(**kw):
    base = {"id": 1, "type": "edit", "meta": {"domain": "en.wikipedia.org"}, "namespace": 0,
            "title": "Żółw", "timestamp": 1704067201, "user": "u", "bot": False}
    base.update(kw)
    return json.dumps(base, ensure_ascii=False)


def _text_df(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_skip_bad_records(spark):
    texts = [_raw(id=1), "not json at all", _raw(id=2)[:-1], None, _raw(id=3)]
    out = parse_raw_edits(_text_df(spark, texts), on_error="skip")
    assert sorted(r.id for r in out.collect()) == [1, 3]


def test_fail_mode_raises(spark):
    df = _text_df(spark, [_raw(id=1), "not json"])
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        parse_raw_edits(df, on_error="fail").collect()


def test_normalise_edges(spark):
    texts = [
        _raw(id=1, namespace=0, bot=True, timestamp=0),
        _raw(id=2, namespace=-2, bot=False),
        _raw(id=3, namespace=2303, bot=None),
        _raw(id=4, namespace=104),
        _raw(id=5, type="log"),
        _raw(id=6, type=None),
        _raw(id=7, user=""),
        json.dumps({"id": 8, "type": "edit", "namespace": 1, "timestamp": 10, "user": "x", "bot": False}),
        _raw(id=None),
    ]
    rows = {r.id: r for r in normalise_edits(parse_raw_edits(_text_df(spark, texts))).collect()}
    assert set(rows) == {1, 2, 3, 4, 7, 8, None}
    assert rows[1].namespace == "main namespace" and rows[1].user_type == "bot"
    assert rows[1].createTime == "1970-01-01 00:00:00.000"
    assert rows[2].namespace == "Media" and rows[2].user_type == "human"
    assert rows[3].namespace == "Gadget definition Talk" and rows[3].user_type is None
    assert rows[4].namespace == "unknown"
    assert rows[7].user_name == ""
    assert rows[8].domain is None  # missing meta
    assert rows[2].title == "Żółw"
    assert rows[2].createTime == "2024-01-01 00:00:01.000"
    assert list(rows[1].asDict()) == ["id", "domain", "namespace", "title", "createTime", "user_name", "user_type"]


def test_only_message_records_are_read(spark):
    df = spark.createDataFrame(
        [("message", _raw(id=1)), ("error", _raw(id=2)), (None, _raw(id=3)), ("message", "not json")],
        "kind string, value string",
    )
    out = parse_raw_edits(df, "value", on_error="skip", kind_col="kind")
    assert [r.id for r in out.collect()] == [1]


ODD_JSON = [
    '{"id": 1, "type": "edit", "meta": {"domain": "d"}, "namespace": 0, "title": "t", "timestamp": 5, "user": "u", "bot": true}',
    ' \t{"id": 2, "type": "edit", "meta": {"domain": "d"}, "namespace": 0, "title": "t", "timestamp": 5, "user": "u", "bot": true}\r\n',
    '{"id": 3, "type": "edit", "meta": {"domain": "d"}, "namespace": 0, "title": "t", "timestamp": 5, "user": "u", "bot": true} x',
    '{"id": 4, "type": "edit", "meta": {"domain": "d"}, "namespace": 0, "title": "t", "timestamp": 5, "user": "u", "bot": true}, {"id": 5}',
    '{"id": 6, "type": "edit", "meta": {"domain": "d"}, "namespace": 0, "title": "t", "timestamp": 5, "user": "u", "bot": true}{"id": 7}',
    '{"id": 8, "type": "edit", "meta": {"domain": "d"}, "namespace": "x", "title": 7, "timestamp": 5.5, "user": "u", "bot": "no"}',
    '{"id": 9}', '{"id": null, "meta": null}', '{"id": 10, "meta": {"other": 1}}', '{"id": 11, "meta": "text"}', '{"id": 12, "meta": [1]}',
    '{"id": 99999999999999999999, "type": "edit"}', '{}', '[]', '[{"id": 13}]', '5', 'null', '"text"', 'true', '', ' ', '{', '}', '{"id": 14', "{'id': 15}",
    '{"id": 16,}', 'event: {"id": 17}', '{"id": 18, "more": {"a": [1, 2, {"b": "}"}]}, "type": "edit"}', '{"type": "\\u00e9\\n\\"", "id": 19}',
    '{"id": 20, "type": "edit", "meta": {"domain": "d", "x": 1}, "namespace": 0, "title": "", "timestamp": -5, "user": "", "bot": false, "z": null}', None,
]


def test_records_are_read_as_by_the_variant_alone(spark):
    """Parsing by the schema first changes no field of a record, and the
    records are those that a strict parser reads as one object."""
    from tidemark.functions import codec
    from tidemark.schemas import RAW_EDIT

    def is_object(text):
        try:
            return isinstance(json.loads(text or ""), dict)
        except ValueError:
            return False

    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD_JSON)], "n int, value string")
    wanted = [i for i, x in enumerate(ODD_JSON) if is_object(x)]
    plain = df.where(F.col("n").isin(wanted)).withColumn("_v", F.try_parse_json("value")).select(
        "n", *[codec._field(F.col("_v"), f"$['{f.name}']", f.dataType).alias(f.name) for f in RAW_EDIT.fields]
    )
    got = codec.parse_json_or_skip(df, "value", RAW_EDIT, keep=["n"])
    assert sorted(r.n for r in got.collect()) == wanted
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and len(wanted) >= 12
