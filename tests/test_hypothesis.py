"""Property tests: Spark column functions against plain-Python references,
many generated examples per Spark job."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pressroom.functions import text as TX

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
texts = st.lists(st.text(alphabet=st.sampled_from(list("ab 12\n\r\t\xa0x9.")), max_size=30), min_size=1,
                 max_size=40)


CLEANED = [("", 0.0, ""), ("a  b", 0.0, "a b"), (" 12  x 7 ", 12.0, "12 x 7"), ("a\r\n\r\nb", 0.0, "a\nb"),
           ("\xa0 a \x85", 0.0, "a"), ("\x1c\x1fx9.\x1e", 9.0, "x9."), ("a \n b", 0.0, "a \n b"), ("\t007", 7.0, "007"),
           ("\u200bz", 0.0, "\u200bz"), ("x" + "9" * 25, float("9" * 25), "x" + "9" * 25)]


def test_first_int_and_clean_on_cases(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(CLEANED)], "i int, x string")
    for r in df.select("i", TX.first_int("x").alias("n"), TX.clean_ws_v1("x").alias("c")).collect():
        assert (r["n"], r["c"]) == CLEANED[r["i"]][1:]


@SETTINGS
@given(st.lists(st.text(max_size=12) | st.text(alphabet="\x1c\x1d\x85\xa0\u2003\u2028 a\t", max_size=8), min_size=1, max_size=40))
def test_strip_matches_python(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
    got = {r["i"]: r["s"] for r in df.select("i", TX.strip("x").alias("s")).collect()}
    assert [got[i] for i in range(len(xs))] == [x.strip() for x in xs]


@SETTINGS
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=8),
                min_size=1, max_size=20))
def test_vector_codec_round_trips(spark, vecs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vecs)], "i int, v array<double>")
    back = {r["i"]: r["b"] for r in df.select(
        "i", TX.text_to_vector(TX.vector_to_text(F.col("v"))).alias("b")).collect()}
    assert all(back[i] == v for i, v in enumerate(vecs))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 5)),
                min_size=1, max_size=60),
       st.integers(1, 6))
def test_number_within_equals_row_number(spark, rows, parts):
    from pyspark.sql import Window

    from pressroom.operators.sequence import number_within

    df = spark.createDataFrame([(i, g, k) for i, (g, k) in enumerate(rows)], "id long, g string, k int")
    ours = number_within(df, ["g"], [F.col("k").desc(), F.col("id").asc()], "pos", num_partitions=parts)
    w = Window.partitionBy("g").orderBy(F.col("k").desc(), F.col("id").asc())
    ref = df.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    assert sorted(map(tuple, ours.select("id", "pos").collect())) == \
        sorted(map(tuple, ref.select("id", "pos").collect()))
