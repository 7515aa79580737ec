"""Display formats agree with Python's own formatting of the same numbers."""

from touchline.functions.formats import percent_text, thousands_text


def test_thousands_and_percent_match_python(spark):
    ints = [0, 7, 1234, 1234567, 98765432]
    money = [0.0, 5.0, 12345.5, 12345.67, 1234567.1, 0.05]
    shares = [0.0, 1.0, 0.123456, 0.5, 1 / 3, 2 / 3, 0.0005, 0.99999]
    df = spark.createDataFrame([(i,) for i in ints], "x long")
    assert [r[0] for r in df.select(thousands_text("x")).collect()] == [f"{x:,}" for x in ints]
    dm = spark.createDataFrame([(m,) for m in money], "x double")
    assert [r[0] for r in dm.select(thousands_text("x", 2)).collect()] == [f"{x:,}" for x in money]
    ds = spark.createDataFrame([(s,) for s in shares], "x double")
    assert [r[0] for r in ds.select(percent_text("x")).collect()] == [f"{x:.2%}" for x in shares]
