import base64
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from sightline.functions import keys, timecodes, vectors


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("name", ["0_2016091310", "", "节点_卡口", "a" * 500])
def test_name_uuid(spark, name):
    want = uuid.UUID(bytes=hashlib.md5(name.encode()).digest(), version=3).hex
    assert one(spark, keys.name_uuid(F.lit(name))) == want


def test_random_hex_id(spark):
    ids = [r[0] for r in spark.range(50).select(keys.random_hex_id()).collect()]
    assert len(set(ids)) == 50 and all(len(i) == 32 and int(i, 16) >= 0 for i in ids)


@pytest.mark.parametrize("value,width,want", [(1, 4, "0001"), (12345, 4, "12345"), (123, 3, "123"), (0, 3, "000")])
def test_zero_pad(spark, value, width, want):
    assert one(spark, keys.zero_pad(F.lit(value), width)) == want


def test_packed_writes_null(spark):
    assert one(spark, keys.packed(F.lit("a"), F.lit(None), F.lit(3))) == "a_null_3"


def test_version_of(spark):
    assert one(spark, keys.version_of(F.lit(1473733045), F.lit("0007"), F.lit("012"))) == 14737330450007012
    assert one(spark, keys.version_of(F.lit(1), F.lit("x"))) is None


@pytest.mark.parametrize("value,want", [(-1, -1), (-12, -2), (19, 9)])
def test_bucket_keeps_the_sign(spark, value, want):
    assert one(spark, keys.bucket(F.lit(value), 10)) == want


@pytest.mark.parametrize("digits,epoch,day", [
    ("20160913101725", 1473761845, 20160913), ("0", 0, 0), ("", 0, 0), ("20161313101725", 0, 0), ("abc", 0, 0),
])
def test_digit_times(spark, digits, epoch, day):
    assert one(spark, timecodes.epoch_seconds(F.lit(digits))) == epoch
    assert one(spark, timecodes.day_id(F.lit(digits))) == day


def test_month_of_unknown_time_is_now(spark):
    now = F.lit("2020-05-06 00:00:00").cast("timestamp")
    assert one(spark, timecodes.month_tag(F.lit(1473761845).cast("bigint"), now)) == "201609"
    assert one(spark, timecodes.month_tag(F.lit(0).cast("bigint"), now)) == "202005"
    assert one(spark, timecodes.month_tag(F.lit(-5).cast("bigint"), now)) == "202005"


def test_day_shift(spark):
    assert one(spark, timecodes.shift_day(F.to_date(F.lit("2024-03-01")), -1)) == "20240229"
    assert one(spark, timecodes.shift_hour_tag(F.lit("2016123123"), 1)) == "2017010123"
    assert one(spark, timecodes.shift_hour_tag(F.lit("nonsense"), 1)) is None


def test_byte_sum(spark):
    data = bytes(range(256)) + b"\x00\xff\n\r"
    assert one(spark, vectors.byte_sum(F.lit(base64.b64encode(data).decode()))) == sum(data)
    assert one(spark, vectors.byte_sum(F.lit("not base64!"))) is None
    assert one(spark, vectors.byte_sum(F.lit(None).cast("string"))) is None


def test_split_fields(spark):
    row = spark.range(1).select(*keys.split_fields(F.lit("f==,12"), ["a", "b", "c"])).first()
    assert (row.a, row.b, row.c) == ("f==", "12", None)
