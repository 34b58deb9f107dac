"""Access-log parsing: whole-line match, typed fields, rejects, counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from linecraft.operators import access_log_counts, parsed_records, rejected_lines, tag_access_log

H = "h - - [01/Aug/1995:00:00:01 -0400]"
PLAIN = 'in24.inetnebr.com - - [01/Aug/1995:00:00:01 -0400] "GET /shuttle/missions.txt HTTP/1.0" 200 1839'
SEP = "\u0001"

# (line, reject reason or None)
LINE_CASES = [
    (PLAIN, None),
    (f'{H} "GET /a" 200 -', None),
    (f'{H} "GET /a HTTP/1.0" 200 12 extra', "no_match"),
    (f'{H} "GET /a b HTTP/1.0" 404 -', "no_match"),
    ("garbage", "no_match"),
    ("", "no_match"),
    (f'{H} "GET /a HTTP/1.0" 200 xx', "bad_size"),
    (f'{H} "GET /a HTTP/1.0" 200 5\u0085', "bad_size"),
    (f'h x - - [01/Aug/1995:00:00:01 -0400] "GET /a"b c" 200 5', None),
    (SEP.join("abcdefghi"), "no_match"),
    (f'{H} "GET /a{SEP}b HTTP/1.0" 200 7', None),
    (f'{H} "GET /a HTTP/1.0" 200 5{SEP}', "bad_size"),
    ("h - - [01/Aug/1995:00:00:01\t-0400] \"GET /t HTTP/1.0\" 200 1", None),
    (f'{H} "GET /a HTTP/1.0" 200 5\n', "no_match"),
]


def _tag(spark, lines, **kw):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, value string")
    return tag_access_log(df, **kw)


def test_line_cases(spark):
    rows = {r.id: r for r in _tag(spark, [s for s, _ in LINE_CASES]).collect()}
    for i, (line, reason) in enumerate(LINE_CASES):
        r = rows[i]
        assert r.reject_reason == reason, repr(line)
        assert r.parsed == (1 if reason is None else 0)
        assert r.value == line


def test_plain_record_fields(spark):
    r = _tag(spark, [PLAIN]).first()
    assert (r.remote_host, r.remote_identity, r.local_identity) == ("in24.inetnebr.com", "-", "-")
    assert (r.method, r.endpoint, r.protocol) == ("GET", "/shuttle/missions.txt", "HTTP/1.0")
    assert (r.response_code, r.content_size) == (200, 1839)
    assert r.request_time_local == dt.datetime(1995, 8, 1, 0, 0, 1)
    epoch = _tag(spark, [PLAIN]).select(F.unix_seconds("request_time")).first()[0]
    assert epoch == 807249601


def test_odd_fields(spark):
    rows = _tag(spark, [f'{H} "GET /a" 200 -', f'h x - - [01/Aug/1995:00:00:01 -0400] "GET /a"b c" 200 5',
                        f'{H} "GET /a{SEP}b HTTP/1.0" 200 7']).orderBy("id").collect()
    assert (rows[0].protocol, rows[0].content_size) == ("", 0)
    assert (rows[1].remote_host, rows[1].endpoint, rows[1].protocol) == ("h x", '/a"b', "c")
    assert (rows[2].endpoint, rows[2].content_size) == (f"/a{SEP}b", 7)


def test_schema(spark):
    types = dict(_tag(spark, [PLAIN]).dtypes)
    assert types["request_time"] == "timestamp"
    assert types["request_time_local"] == "timestamp_ntz"
    assert types["response_code"] == "int" and types["content_size"] == "bigint"
    assert types["parsed"] == "int" and types["reject_reason"] == "string"


@pytest.mark.parametrize(
    "text,ok",
    [
        ("01/Aug/1995:00:00:01 -0400", True),
        ("32/Jul/1995:25:61:00 -0400", False),
        ("01/Foo/1995:00:00:01 -0400", False),
        ("1/Aug/1995:0:00:01 -0400", False),
        ("29/Feb/1995:00:00:00 +0000", False),
        ("29/Feb/1996:00:00:00 +0000", True),
        ("01/AUG/1995:00:00:01 -0400", True),
        ("01/aug/1995:00:00:01 -0400", True),
        ("01/Aug/1995:24:00:00 -0400", False),
        ("00/Aug/1995:00:00:00 -0400", False),
        ("01/Aug/19950:00:00:01 -0400", False),
        ("01/August/1995:00:00:00 +0000", False),
        ("01/Aug/1995:00:00:00 +1400", True),
        ("01/Aug/1995:00:00:00 -9999", False),
    ],
)
def test_times(spark, text, ok):
    r = _tag(spark, [f'h - - [{text}] "GET /a HTTP/1.0" 200 1']).first()
    assert (r.reject_reason is None) == ok
    if not ok:
        assert r.reject_reason == "bad_time" and r.request_time is None and r.request_time_local is None


def test_dst_gap_in_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = _tag(spark, ['h - - [02/Apr/1995:02:30:00 -0500] "GET /a HTTP/1.0" 200 1'])
        r = df.select(
            F.unix_seconds("request_time").alias("s"), F.col("request_time_local").cast("string").alias("w")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.s == int(dt.datetime(1995, 4, 2, 7, 30, tzinfo=dt.timezone.utc).timestamp())
    assert r.w == "1995-04-02 02:30:00"


@pytest.mark.parametrize(
    "size,want",
    [("-", 0), ("1839", 1839), ("+5", 5), ("-7", -7), ("007", 7), ("5.7", None), ("xx", None),
     ("99999999999999999999", None), ("9223372036854775807", 9223372036854775807)],
)
def test_sizes(spark, size, want):
    r = _tag(spark, [f'{H} "GET /a HTTP/1.0" 200 {size}']).first()
    assert r.content_size == want
    assert r.reject_reason == (None if want is not None else "bad_size")


def test_parsed_and_rejects_split(spark):
    tagged = _tag(spark, [s for s, _ in LINE_CASES])
    good = parsed_records(tagged, keep=["id"]).collect()
    bad = rejected_lines(tagged, keep=["id"]).collect()
    assert len(good) + len(bad) == len(LINE_CASES)
    assert {r.id for r in good} == {i for i, (_, why) in enumerate(LINE_CASES) if why is None}
    assert all(r.reason is not None for r in bad)
    assert parsed_records(tagged).columns[0] == "remote_host"


def test_fail_mode_raises(spark):
    with pytest.raises(Exception, match="unparsable access-log line"):
        _tag(spark, [PLAIN, f'{H} "GET /a HTTP/1.0" 200 xx'], on_error="fail").collect()
    # mismatches alone do not abort, as in the original
    assert _tag(spark, [PLAIN, "garbage"], on_error="fail").count() == 2


def test_counts_and_guard(spark):
    lines = [s for s, _ in LINE_CASES]
    c = access_log_counts(_tag(spark, lines)).first()
    good = sum(1 for _, why in LINE_CASES if why is None)
    assert (c.total, c.ok, c.failed) == (len(lines), good, len(lines) - good)
    empty = spark.createDataFrame([], "id int, value string")
    with pytest.raises(Exception, match="No Data found in RDD"):
        access_log_counts(tag_access_log(empty)).collect()
    assert access_log_counts(tag_access_log(empty), fail_on_empty=False).first().total == 0


def _render(rec):
    t = rec["time"].strftime("%d/%b/%Y:%H:%M:%S")
    proto = (" " + rec["protocol"]) if rec["protocol"] else ""
    size = "-" if rec["size"] is None else str(rec["size"])
    return (f'{rec["host"]} {rec["rid"]} {rec["lid"]} [{t} {rec["offset"]}] '
            f'"{rec["method"]} {rec["endpoint"]}{proto}" {rec["status"]} {size}')


def test_render_parse_round_trip(spark):
    rnd = random.Random(3)
    recs = []
    for i in range(300):
        recs.append({
            "host": rnd.choice(["a.b", "10.0.0.1", "x-y.z"]) + str(i),
            "rid": rnd.choice(["-", "id"]), "lid": rnd.choice(["-", "bob"]),
            "time": dt.datetime(1995, 7, 1) + dt.timedelta(seconds=rnd.randint(0, 10**7)),
            "offset": rnd.choice(["-0400", "+0000", "+0530"]),
            "method": rnd.choice(["GET", "POST", "HEAD"]),
            "endpoint": "/" + "".join(rnd.choice("abc/._?=%") for _ in range(rnd.randint(0, 15))),
            "protocol": rnd.choice(["HTTP/1.0", "HTTP/1.1", ""]),
            "status": rnd.choice([200, 304, 404, 500]),
            "size": rnd.choice([None, 0, rnd.randint(1, 10**9)]),
        })
    rows = {r.id: r for r in _tag(spark, [_render(r) for r in recs]).collect()}
    for i, rec in enumerate(recs):
        r = rows[i]
        assert r.parsed == 1, _render(rec)
        assert (r.remote_host, r.remote_identity, r.local_identity) == (rec["host"], rec["rid"], rec["lid"])
        assert (r.method, r.endpoint, r.protocol) == (rec["method"], rec["endpoint"], rec["protocol"])
        assert (r.response_code, r.content_size) == (rec["status"], rec["size"] or 0)
        assert r.request_time_local == rec["time"]
    c = access_log_counts(_tag(spark, [_render(r) for r in recs] + ["junk"] * 7)).first()
    assert (c.total, c.ok, c.failed) == (307, 300, 7)


def test_regex_evaluated_once(spark):
    tagged = _tag(spark, [PLAIN])
    plan = parsed_records(tagged)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
