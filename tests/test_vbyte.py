from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wordloom.functions.vbyte import vbyte_hex, vbyte_length

CODES = {
    0: "00", 1: "01", 127: "7F", 128: "8001", 255: "FF01", 300: "AC02", 16383: "FF7F", 16384: "808001",
    2097151: "FFFF7F", 2097152: "80808001", 268435455: "FFFFFF7F", 268435456: "8080808001", 4294967295: "FFFFFFFF0F",
}


def decoded(code: bytes) -> list[int]:
    numbers, value, shift = [], 0, 0
    for byte in code:
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            numbers.append(value)
            value, shift = 0, 0
    assert shift == 0
    return numbers


def test_known_codes(spark):
    frame = spark.createDataFrame([(n,) for n in CODES], "n BIGINT")
    for row in frame.select("n", vbyte_hex(F.col("n")).alias("h"), vbyte_length(F.col("n")).alias("l")).collect():
        assert (row.h, row.l) == (CODES[row.n], len(CODES[row.n]) // 2)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 2**63 - 1), min_size=50, max_size=200))
def test_codes_decode_to_their_numbers(spark, numbers):
    frame = spark.createDataFrame([(n,) for n in numbers], "n BIGINT")
    for row in frame.select("n", vbyte_hex(F.col("n")).alias("h"), vbyte_length(F.col("n")).alias("l")).collect():
        assert decoded(bytes.fromhex(row.h)) == [row.n]
        assert row.l == len(row.h) // 2
