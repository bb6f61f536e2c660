import json

from pyspark.sql import functions as F

from sightline import schemas
from sightline.operators import decode, filters, project

LINES = [
    '{"id":"1","captureTime":10,"yearId":"7","yearIdProb":0.5,"unknown":[1]}',  # quoted number, unknown field
    '{"id":"2"}',  # nearly everything missing
    '{"id":"3","captureTime":1',  # cut off
    '{"id":"4","captureTime":"soon"}',  # does not fit
    "plain text", "null", "12", '[{"id":"5"}]', "", "   ", None,
    '{"id":null,"plateNumber":"京A12345"}',
]


def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_valid_and_quarantine_partition_the_lines(spark):
    decoded = decode.decode_json(lines(spark), schemas.EVENT_V2)
    good = decode.valid(decoded).collect()
    bad = [r.value for r in decode.quarantine(decoded).collect()]
    assert sorted(bad) == sorted([LINES[2], LINES[3], "plain text", "null", "12", '[{"id":"5"}]', "   ", ""])
    assert len(good) + len(bad) + LINES.count("") == len(LINES)
    by_id = {r.id: r for r in good}
    assert set(by_id) == {"1", "2", None}
    assert (by_id["1"].captureTime, by_id["1"].yearId, by_id["1"].yearIdProb) == (10, 7, 0.5)
    assert by_id["2"].captureTime is None
    assert by_id[None].plateNumber == "京A12345"


def test_a_line_is_parsed_once_in_the_plan(spark):
    decoded = decode.valid(decode.decode_json(lines(spark), schemas.EVENT_V1)).select("id", "captureTime")
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_other_columns_are_kept(spark):
    rows = lines(spark).withColumn("offset", F.lit(5))
    assert decode.decode_json(rows, "id string").columns == ["value", "offset", "id", "_corrupt"]


def test_valid_entity(spark):
    names = ["abcde", "abcdef", "abcdefghij", "abcdefghijk", "", None, "abc无defg", "abc未defg"]
    df = spark.createDataFrame([(n,) for n in names], "e string")
    assert [r[0] for r in df.select(filters.valid_entity(F.col("e"))).collect()] == [
        False, True, True, False, False, False, False, False
    ]


def test_valid_entity_rejects_the_far_future(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    base = 1704067200
    df = spark.createDataFrame([("abcdef", base + 86399), ("abcdef", base + 86400), ("abcdef", None)], "e string, t bigint")
    out = [r[0] for r in df.select(filters.valid_entity(F.col("e"), F.col("t"), now)).collect()]
    assert out == [True, False, False]


def test_routes(spark):
    df = spark.createDataFrame([(5,), (0,), (-1,), (-60,), (-61,), (None,)], "d bigint")
    assert [r[0] for r in df.select(filters.route(F.col("d"))).collect()] == [
        "advance", "state", "keep", "keep", "history", "keep"
    ]


def test_defaults_leave_no_null(spark):
    row = decode.valid(decode.decode_json(spark.createDataFrame([("{}",)], "value string"), schemas.EVENT_V2))
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    full = project.default_nulls(row, now=now).first().asDict()
    assert None not in full.values()
    assert full["captureTime"] == full["sendTime"] == 1704067200
    assert (full["levelId"], full["plateNumber"], full["regionCode"], full["yearIdProb"]) == (-1, "", 0, 0.0)


def test_coded_documents_have_their_fields(spark):
    assert len(schemas.DOCUMENT_V1) == 28 and len(schemas.ROW_STORE_V1) == 35
    assert len(schemas.DOCUMENT_V2) == 32 and len(schemas.fields_of(schemas.EVENT_V2)) == 37
    row = decode.valid(decode.decode_json(spark.createDataFrame([('{"id":"7","speed":3}',)], "value string"), schemas.EVENT_V2))
    doc = project.coded(row, schemas.ROW_STORE_V2).toJSON().first()
    assert json.loads(doc) == {"A001": "7", "A035": 3}


def test_warehouse_rows(spark):
    line = '{"id":"a","plateNumber":"p","captureTime":20160913101725,"createTime":20160913101726,"directionId":"N","brandId":-1}'
    row = decode.valid(decode.decode_json(spark.createDataFrame([(line,)], "value string"), schemas.EVENT_V1))
    full = project.warehouse_row(row, buckets=10)
    assert full.columns[-2:] == ["brandpartition", "dateid"] and len(full.columns) == 18
    got = full.first()
    assert (got.capturetime, got.createtime, got.directionid, got.brandpartition, got.dateid) == (
        1473761845, 1473761846, -1, -1, 20160913
    )
    assert project.warehouse_row(row, convert_create_time=False).first().createtime == 20160913101726
    first = project.first_warehouse_row(row)
    assert len(first.columns) == 12 and str(first.first().capturetime) == "2016-09-13 10:17:25"
