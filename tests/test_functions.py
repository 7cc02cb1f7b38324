"""Edge cases of the Column helpers (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from creditpulse.functions import numbers as N
from creditpulse.functions import text as T
from creditpulse.functions import timefn as TF


def col_values(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("x"))).collect()]


def test_is_blank_java_trim(spark):
    vals = [None, "", " ", "\t", "\n", "a", " a\t"]
    assert col_values(spark, vals, T.is_blank) == [True, True, True, True, True, False, False]
    assert col_values(spark, vals, T.java_trim) == [None, "", "", "", "", "a", "a"]


def test_strict_long(spark):
    vals = [None, "", " 5 ", "+5", "-5", "12.5", "abc", "12345678901234567890"]
    assert col_values(spark, vals, N.strict_long) == [None, 0, 5, 5, -5, None, None, None]
    assert col_values(spark, vals, N.strict_long_error) == [True, False, False, False, False, True, True, True]


def test_opt_numbers(spark):
    vals = [None, "", "12.7", "abc", "5000.0", "-3"]
    assert col_values(spark, vals, N.opt_long) == [None, None, 12, None, 5000, -3]
    errs = col_values(spark, vals, lambda c: N.opt_error(c, N.opt_long(c)))
    assert errs == [False, False, False, True, False, False]


def test_first_part_and_split(spark):
    vals = ["a|b|", "a|b|c|", "||", "|Y66", "Y66|X69|", "a", "a||c"]
    assert col_values(spark, vals, lambda c: T.first_part(c, "|")) == ["a", "a", None, "", "Y66", "a", "a"]
    assert col_values(spark, vals, lambda c: T.split_is_empty(c, "|")) == [False, False, True, False, False, False, False]
    sizes = col_values(spark, vals, lambda c: F.size(T.area_parts(c, "|")))
    assert sizes == [2, 3, 1, 2, 2, 1, 3]
    commas = [",", "A,B", ",B"]
    assert col_values(spark, commas, lambda c: T.first_part(c, ",")) == [None, "A", ""]


def test_first_non_blank_and_strip(spark):
    df = spark.createDataFrame([(" ", "x市", None), (None, "\t", None), ("a", "b", None)], "a string, b string, c string")
    out = [r[0] for r in df.select(T.first_non_blank("a", "b")).collect()]
    assert out == ["x市", "default", "a"]
    assert df.select(T.strip_token(F.lit("上海市市"), "市")).first()[0] == "上海"


def test_bucket_end(spark):
    vals = [1497404411776, 1497455939999, 1497456000000]
    assert col_values(spark, vals, TF.bucket_end, "bigint") == [1497404520000, 1497456000000, 1497456120000]


def test_day_and_text_round_trip(spark):
    ms = [0, 1497455939999, 1497456000000]
    assert col_values(spark, ms, TF.day_of, "bigint") == ["1970-01-01", "2017-06-14", "2017-06-14"]
    assert col_values(spark, ms, lambda c: TF.day_of(c, "Asia/Shanghai"), "bigint") == ["1970-01-01", "2017-06-14", "2017-06-15"]
    texts = col_values(spark, ms, TF.ms_to_text, "bigint")
    assert texts == ["1970-01-01 00:00:00", "2017-06-14 15:58:59", "2017-06-14 16:00:00"]
    back = col_values(spark, texts, TF.text_to_ms)
    assert back == [0, 1497455939000, 1497456000000]
    assert col_values(spark, ["2017-06-15 00:00:00"], lambda c: TF.text_to_ms(c, "Asia/Shanghai")) == [1497456000000]


def test_session_zone_does_not_matter(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ts = spark.sql("SELECT TIMESTAMP_NTZ'2016-03-13 02:30:00.123' AS t")
        assert ts.select(TF.ms_of_ntz(F.col("t"))).first()[0] == 1457836200123
        assert col_values(spark, [1457836200123], TF.ms_to_text, "bigint") == ["2016-03-13 02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_prev_day_and_prefix(spark):
    assert col_values(spark, ["2017-03-01", "2016-01-01"], TF.prev_day) == ["2017-02-28", "2015-12-31"]
    assert col_values(spark, ["2017-03-01 10:11:12.0"], TF.drop_fraction) == ["2017-03-01 10:11:12"]
    assert col_values(spark, ["2017-03-01 10:11:12"], TF.date_prefix) == ["2017-03-01"]


def test_equal_keys_and_odd_payloads(spark):
    from creditpulse.functions.envelope import parse_envelope

    texts = ['{"logNo":"a","collectTime":5,"flatMap":{"x":"1","y":"2","x":"3"}}', '{"logNo":"a","logNo":"b","collectTime":5,"collectTime":6,"flatMap":"t"}',
             '{"logNo":"a","collectTime":5,"flatMap":[1]}', '{"logNo":"a","collectTime":5,"flatMap":{}}', '{"logNo":"a","collectTime":5,"flatMap":"t"',
             '{"logNo":"a","collectTime":5,"flatMap":{"x":"1","x":null}}', "[1]", '"a"', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r.i: (r.log_no, r.collect_ms, r.p, r.env_err) for r in parse_envelope(df).collect()}
    bad = (None, None, None, "malformed json")
    assert got == {0: ("a", 5, {"x": "3", "y": "2"}, None), 1: ("b", 6, None, None), 2: ("a", 5, None, None), 3: ("a", 5, {}, None),
                   4: bad, 5: ("a", 5, {"x": None}, None), 6: bad, 7: bad, 8: (None, None, None, "empty record")}


def test_only_the_fields_asked_for(spark):
    from creditpulse.functions.envelope import parse_envelope

    texts = ['{"logNo":"a","collectTime":5,"flatMap":{"x":"1","y":2,"x":"3","z":{"q":[1]}}}', '{"logNo":"a","collectTime":5,"flatMap":{"x":"1","x":null}}',
             '{"logNo":"a","collectTime":5,"flatMap":"t"}', '{"logNo":"a","collectTime":5,"flatMap":{}}', '{"logNo":"CreditLoan_WorkFlow_LoanAmount","collectTime":5,"flatMap":[1]}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    got = {r.i: (r.log_no, r.p and tuple(r.p), r.env_err) for r in parse_envelope(df, fields=["x", "z"]).collect()}
    assert got == {0: ("a", ("3", '{"q":[1]}'), None), 1: ("a", (None, None), None), 2: ("a", None, None), 3: ("a", (None, None), None),
                   4: ("CreditLoan_WorkFlow_LoanAmount", None, "malformed json")}


def test_blanks_and_numbers_of_odd_texts(spark):
    from creditpulse.functions import numbers as N
    from creditpulse.functions import text as T

    texts = ["", " ", "\n\t", "a", " a", "a ", "\u0001a", "\u0085", "é ", " 市", None]
    trimmed = ["", "", "", "a", "a", "a", "a", "\u0085", "é", "市", None]
    assert col_values(spark, texts, T.java_trim) == trimmed
    assert col_values(spark, texts, T.is_blank) == [not t for t in trimmed]
    numbers = ["12", " 12 ", "12\n", "-7", "+7", "12.7", "1e3", "999999999999999999", "9223372036854775807", "9223372036854775808", "x", "١", None]
    assert col_values(spark, numbers, N.opt_long) == [12, 12, 12, -7, 7, 12, 1000, 999999999999999999, 2**63 - 1, None, None, 1, None]
