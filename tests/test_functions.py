import datetime as dt
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import parse, predicates, sets, timefn, userfn
from tidemill.schemas import CDC_PAYLOAD, EMPLOYEE, KAFKA_ENVELOPE_WITH_HEADERS, rows


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


BUCKETS = [
    (1, "23:51:07"), (5, "23:51:05"), (10, "23:51:00"), (30, "23:51:00"), (60, "23:51:00"), (300, "23:50:00"),
    (600, "23:50:00"), (1800, "23:30:00"), (3600, "23:00:00"), (14400, "20:00:00"), (21600, "18:00:00"),
    (28800, "16:00:00"), (43200, "12:00:00"), (86400, "00:00:00"),
]


def test_bucket_starts(spark):
    ts = F.lit("2024-07-25 23:51:07").cast("timestamp")
    found = one(spark, *[timefn.bucket_text(ts, w) for w, _ in BUCKETS], *[timefn.guarded_bucket_of(ts, w) for w, _ in BUCKETS])
    want = [f"2024-07-25 {t}" for _, t in BUCKETS]
    assert list(found[:14]) == want
    assert [str(v) for v in found[14:]] == want
    early = F.lit("1969-12-31 23:59:59").cast("timestamp")
    assert str(one(spark, timefn.time_bucket(early, 60))[0]) == "1969-12-31 23:59:00"


def test_bucket_guards(spark):
    with pytest.raises(ValueError):
        timefn.guarded_bucket(F.lit(1721951467000), 86401)
    with pytest.raises(Exception, match="not in milliseconds"):
        one(spark, timefn.guarded_bucket(F.lit(1721951467), 60))


def test_iso_millis(spark):
    texts = ["2022-01-28 19:11:01.736788456+00:00", "2022-01-28 19:11:01+00:00", "2022-01-28 20:11:01.7+01:00",
             "2022-01-28", "2022-13-28 19:11:01+00:00", None]
    found = [r[0] for r in rows(spark, [(t,) for t in texts], "t string").select(timefn.iso_millis(F.col("t"))).collect()]
    assert found == [1643397061736, 1643397061000, 1643397061700, None, None, None]


def test_millis_round_trip_and_hex(spark):
    ts = F.lit("2024-01-01 00:00:01.250").cast("timestamp")
    shift = timefn.shifted_millis(ts, 1704067200000)
    assert tuple(one(spark, shift, timefn.from_shifted_millis(shift, 1704067200000))) == (
        1250.0, dt.datetime(2024, 1, 1, 0, 0, 1, 250000))
    seconds = timefn.hex_id_seconds(F.lit("63ff2f4fcb72c100017bcd0c"))
    assert tuple(one(spark, seconds, timefn.to_hex(seconds))) == (0x63FF2F4F, "63ff2f4f")


def test_lenient_json(spark):
    texts = ['{"emp_id":"102c","first_name":"A","last_name":"B"}', '{"emp_id":1,"first_name":"A","last_name":"B","age":3}',
             '{"first_name":"A","last_name":"B"}', "plain", None]
    found = [r[0] for r in rows(spark, [(t,) for t in texts], "t string")
             .select(F.to_json(parse.parse_json(F.col("t"), EMPLOYEE))).collect()]
    assert found == ['{"first_name":"A","last_name":"B"}', '{"emp_id":1,"first_name":"A","last_name":"B"}',
                     '{"first_name":"A","last_name":"B"}', "{}", None]


def test_nested_json(spark):
    text = '{"i":1,"f":1.5,"b":true,"n":null,"a":[],"l":[1,2],"m":{},"o":{"x":{"y":"z"}},"ts":"2024-01-01T00:00:00Z"}'
    schema = "i int, f double, b boolean, n string, a array<int>, l array<int>, m map<string,string>, o map<string,map<string,string>>, ts timestamp"
    found = one(spark, parse.parse_json(F.lit(text), schema).alias("r")).r
    assert (found.i, found.f, found.b, found.n, found.a, found.l, found.m) == (1, 1.5, True, None, [], [1, 2], {})
    assert found.o == {"x": {"y": "z"}} and found.ts == dt.datetime(2024, 1, 1)


def test_headers(spark):
    value = (bytearray(b"k"), bytearray(b"v"), "t", 0, 1, dt.datetime(2024, 1, 1), 0)
    df = rows(spark, [(*value, [("a", bytearray(b"1")), ("h", bytearray(b"2")), ("h", bytearray(b"3"))]), (*value, []), (*value, None)],
              KAFKA_ENVELOPE_WITH_HEADERS)
    found = df.select(parse.first_header(F.col("headers"), "h").alias("h"), parse.header_texts(F.col("headers")).alias("all")).collect()
    assert [r.h for r in found] == ["2", None, None]
    assert [tuple(x) for x in found[0]["all"]] == [("a", "1"), ("h", "2"), ("h", "3")]
    assert parse.text_records(df, "offset").first() == ("k", "v", 1)


def test_lines(spark):
    df = rows(spark, [("Jack , 12",), ("Bob, x",), ("alone",)], "value string")
    assert [tuple(r) for r in df.select(*parse.person_line(F.col("value"))).collect()] == [("Jack", 12), ("Bob", None), ("alone", None)]
    line = F.lit("2024-03-18 07:07:02, 12, printer")
    moment = dt.datetime(2024, 3, 18, 7, 7, 2)
    assert tuple(one(spark, *parse.impression_line(line))) == (moment, 12, "printer")
    assert tuple(one(spark, *parse.click_line(line))) == (moment, 12, "printer")
    timed = parse.timed_words(rows(spark, [("2024-03-18 07:07:02, a b",)], "value string"))
    assert [tuple(r) for r in timed.collect()] == [(moment, "a"), (moment, "b")]


def test_bad_lines_become_dead_letters(spark):
    df = rows(spark, [("Jack , 12",), ("Bob, x",)], "value string")
    good, bad = parse.split_lines(df, parse.person_line(F.col("value")), ["name", "age"])
    assert [tuple(r) for r in good.collect()] == [("Jack", 12)]
    assert bad.first().dead_letter == '{"orig_request":"Bob, x","failed_reason":"missing or invalid: age"}'


def test_change_records(spark):
    good = '{"oc":"U","ns":"n","pk":"{\\"_id\\":1}","va":"{\\"value\\":\\"v\\"}"}'
    df = rows(spark, [(good,), ("junk",), (None,)], "value string").select(
        F.col("value").cast("binary").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("partition"), F.lit(1).alias("offset"))
    records = parse.cdc_records(df)
    assert [r.oc for r in records.collect()] == ["U", None, None]
    found = parse.cdc_rows(records, "n", T._parse_datatype_string("_id int"), T._parse_datatype_string("value string")).collect()
    assert [(r.oc, r._id, r.value) for r in found] == [("U", 1, "v")]


@pytest.mark.parametrize("text, spaces, words", [
    ("a  b  ", ["a", "", "b"], ["a", "b"]), ("", [""], []), ("   ", [], []), (" a", ["", "a"], ["a"]),
    ("a\tb\n c", ["a\tb\n", "c"], ["a", "b", "c"]), (None, None, []),
])
def test_tokens(spark, text, spaces, words):
    df = rows(spark, [(text,)], "t string")
    found = df.select(parse.space_tokens(F.col("t")), parse.words(F.col("t")), userfn.split_words("t")).first()
    assert tuple(found) == (spaces, words, words)


def test_checked_below(spark):
    assert one(spark, parse.checked_below(F.lit(9)))[0] == 9
    assert one(spark, parse.checked_below(F.lit(None).cast("int")))[0] is None
    for guard in (parse.checked_below, userfn.fail_from_ten):
        with pytest.raises(Exception, match="not below 10"):
            rows(spark, [(3,), (10,)], "n int").select(guard(F.col("n"))).collect()


def test_user_functions_in_sql(spark):
    userfn.register(spark)
    assert [r[0] for r in spark.sql("SELECT explode(split_words(' a  b ')) AS w").collect()] == ["a", "b"]
    assert spark.sql("SELECT fail_from_ten(3) AS n").first().n == 3


def test_average(spark):
    df = rows(spark, [("1", 10), ("1", 20), ("2", 5), ("2", 20), ("2", 15), ("1", 15)], "k string, v bigint")
    assert df.agg(userfn.average(F.col("v"))).first()[0] == pytest.approx(85 / 6)
    by_key = {r[0]: r[1] for r in df.groupBy("k").agg(userfn.average(F.col("v"))).collect()}
    assert by_key == {"1": 15.0, "2": pytest.approx(40 / 3)}
    assert df.where("false").agg(F.avg("v")).first()[0] is None


def test_conditions(spark):
    df = rows(spark, [("tmp_x",), ("tmpx",), ("log",), ("order",), (None,)], "name string")
    rule = predicates.all_of([predicates.not_like_any(F.col("name"), [r"tmp\_%"]), predicates.not_in(F.col("name"), ["log"])])
    assert [r[0] for r in df.where(rule).collect()] == ["tmpx", "order"]
    assert df.where(predicates.all_of([])).count() == 5 and df.where(predicates.any_of([])).count() == 0


def test_segments(spark):
    df = rows(spark, [("open", "1"), ("close", "t1"), ("open", None)], "name string, user string")
    rules = [predicates.Segment("OPEN", F.col("name") == "open"), predicates.Segment("ANY", F.lit(True))]
    segments = predicates.with_test_variants(rules, F.col("user").like("t%"))
    counts = df.select([F.count_if(s.predicate).alias(s.name) for s in segments]).first().asDict()
    assert counts == {"OPEN": 1, "OPEN_WITH_TEST": 2, "ANY": 1, "ANY_WITH_TEST": 3}


def test_field_in_list(spark):
    df = rows(spark, [("EVENT2",), ("e1",), ("e4",), (None,)], "name string")
    listed = " e1,Event2, EVENT3 ".split(",")
    def keep(**kw):
        return [r[0] for r in predicates.filter_field_in_list(df, "name", listed, **kw).collect()]
    assert keep(null_in_list=True) == ["e4"]
    assert keep() == ["e4", None]
    assert keep(negate=True) == ["EVENT2", "e1"]
    assert keep(null_in_list=True, negate=True) == ["EVENT2", "e1", None]
    assert predicates.filter_field_in_list(df, "Name", listed).count() == 4  # absent field, counted as NULL
    with pytest.raises(TypeError):
        predicates.filter_field_in_list(spark.range(1), "id", listed)


def test_sets(spark):
    found = one(spark, sets.union_sets(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))),
                sets.union_sets(F.lit(None).cast("array<string>"), F.array(F.lit("x"))))
    assert tuple(found) == (["a", "b"], ["x"])


def test_empty_typed_table(spark):
    empty = rows(spark, [], CDC_PAYLOAD)
    assert empty.count() == 0 and empty.columns == ["oc", "ns", "pk", "va"]


def test_split_words_makes_no_python_texts():
    lines = pa.array([" a \x0b\tb\n", None, "", " \t ", "é \u00a0x"] + ["word " * 300] * 10_000)
    tracemalloc.start()
    words = userfn.split_words.func(lines.slice(1))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words[:4].to_pylist() == [[], [], [], ["é", "\u00a0x"]] and len(words[10_003]) == 300
    assert userfn.split_words.func(lines.slice(0, 1)).to_pylist() == [["a", "b"]]
    assert most < 100e6  # three million words
