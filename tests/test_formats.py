import json

import pytest
from pyspark.sql import functions as F

from logloom.functions import converters, keys
from logloom.functions.formats import FORMATS, LogFormat, log_format, parse

LINE = '127.0.0.1 - frank [10/Oct/2000:13:55:36 -0700] "GET /a.gif HTTP/1.0" 200 2326'
GOLDEN = [
    ("COMMONAPACHELOG", LINE, ["127.0.0.1", None, "frank", "10/Oct/2000:13:55:36 -0700", "GET /a.gif HTTP/1.0", "200", "2326"]),
    ("COMMONAPACHELOG", LINE.replace("frank", "-").replace("2326", "-"), ["127.0.0.1", None, None, "10/Oct/2000:13:55:36 -0700", "GET /a.gif HTTP/1.0", "200", None]),
    ("COMMONAPACHELOG", LINE + ' "r" "a"', ["127.0.0.1", None, "frank", "10/Oct/2000:13:55:36 -0700", "GET /a.gif HTTP/1.0", "200", "2326"]),
    ("COMMONAPACHELOG", "garbage line", None),
    ("COMMONAPACHELOG", LINE + "\r", None),
    ("COMMONAPACHELOG", LINE.replace("127.0.0.1", "::1"), None),
    ("COMBINEDAPACHELOG", LINE + ' "http://r/" "Mozilla/4.08"', ["127.0.0.1", None, "frank", "10/Oct/2000:13:55:36 -0700", "GET /a.gif HTTP/1.0", "200", "2326", "http://r/", "Mozilla/4.08"]),
    ("COMBINEDAPACHELOG", LINE + ' "-" "M"', ["127.0.0.1", None, "frank", "10/Oct/2000:13:55:36 -0700", "GET /a.gif HTTP/1.0", "200", "2326", None, "M"]),
    ("COMBINEDAPACHELOG", LINE + ' "" "M"', None),
    ("APACHEERRORLOG", "[Fri Sep 09 10:42:29.902022 2011] [core:error] [pid 35708:tid 4328636416] [client 72.15.99.187] File does not exist: /x", ["Fri Sep 09 10:42:29.902022 2011", "core", "error", "35708", "4328636416", "72.15.99.187", "File does not exist: /x"]),
    ("APACHEERRORLOG", "[Fri Sep 09 10:42:29 2011] [error] [pid 35708] [client 72.15.99.187:80] m", ["Fri Sep 09 10:42:29 2011", None, "error", "35708", None, "72.15.99.187:80", "m"]),
    ("APACHEERRORLOG", "[Fri Sep 09 10:42:29 2011] [error] [client 72.15.99.187:80] m", None),
    ("SYSLOG", "Oct 11 22:14:15 web01 sshd[4123]: Accepted", ["Oct 11 22:14:15", "web01", "sshd", "4123", "Accepted"]),
    ("SYSLOG", "Oct 11 22:14:15 web01 kernel: up", ["Oct 11 22:14:15", "web01", "kernel", None, "up"]),
    ("SYSLOG", "Oct 11 22:14:15 <0.6> web01 cron[9]: x", ["Oct 11 22:14:15", "web01", "cron", "9", "x"]),
    ("SYSLOG", "Oct 11 22:14:15 web01 sshd[4123]: ", ["Oct 11 22:14:15", "web01", "sshd", "4123", ""]),
    ("SYSLOG", "Oct 11 22:14:15 web01 a\x01b[1]: m", None),
    ("SYSLOG", "Oct 11 22:14:15 web01 app[1]: m\x01n", ["Oct 11 22:14:15", "web01", "app", "1", "m\x01n"]),
    ("SYSLOG", "<34>Oct 11 22:14:15 web01 su: x", None),
    ("SYSLOG", "Oct 11 22:14:15 web01 su: -", ["Oct 11 22:14:15", "web01", "su", None, "-"]),
    ("RFC3339SYSLOG", "2003-10-11T22:14:15.003Z web01 app[12]: hello", ["2003-10-11T22:14:15.003Z", "web01", "app", "12", "hello"]),
    ("RFC3339SYSLOG", "2003-10-11T22:14:15+02:00 web01 app: hello", ["2003-10-11T22:14:15+02:00", "web01", "app", None, "hello"]),
]


def test_goldens(spark):
    rows = [(i, name, line) for i, (name, line, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "i int, name string, line string")
    for name, fmt in FORMATS.items():
        for r in df.where(F.col("name") == name).select("i", parse(F.col("line"), fmt).alias("x")).collect():
            want = GOLDEN[r["i"]][2]
            assert (None if r["x"] is None else list(r["x"])) == want, GOLDEN[r["i"]]


def one(spark, text, *options):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(converters.chain(F.col("t"), list(options)).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("line", "delimiter", "want"),
    [
        ("a,b,c", ",", '{"f1":"a","f2":"b","f3":"c"}'),
        ("a,,c", ",", '{"f1":"a","f2":"","f3":"c"}'),
        ("a", ",", '{"f1":"a","f2":null,"f3":null}'),
        ("", ",", '{"f1":null,"f2":null,"f3":null}'),
        ("a,b,c,d\n", ",", '{"f1":"a","f2":"b","f3":"c"}\n'),
        ('x,"y,z"', ",", '{"f1":"x","f2":"\\"y","f3":"z\\""}'),
        ("a;b,c", ",;", '{"f1":"a","f2":"b","f3":"c"}'),
        ("a]b^c", "]^", '{"f1":"a","f2":"b","f3":"c"}'),
    ],
)
def test_csv(spark, line, delimiter, want):
    assert one(spark, line, {"optionName": "CSVTOJSON", "customFieldNames": ["f1", "f2", "f3"], "delimiter": delimiter}) == want


def test_other_converters(spark):
    assert one(spark, "x\n", {"optionName": "ADDBRACKETS"}) == "{x\n}"
    assert one(spark, "x\n", {"optionName": "ADDMETADATA", "metadata": {"a": 1, "b": [1, 2], "c": None}}) == '{"metadata":{"a":1,"b":[1,2],"c":null},"data":"x"}\n'
    assert one(spark, "x", {"optionName": "singleline"}) == "x"
    assert one(spark, "nothing", {"optionName": "LOGTOJSON", "logFormat": "SYSLOG"}, {"optionName": "ADDBRACKETS"}) is None
    assert json.loads(one(spark, "k=v", {"optionName": "LOGTOJSON", "matchPattern": "(\\w)=(\\w)", "customFieldNames": ["a", "b"], "jsonFormat": "PRETTYPRINT"})) == {"a": "k", "b": "v"}
    for bad in ({"optionName": "NONE"}, {"optionName": "CSVTOJSON"}, {"optionName": "CSVTOJSON", "customFieldNames": ["a", "a"]}, {"optionName": "LOGTOJSON", "matchPattern": "(a)"}, {"optionName": "ADDMETADATA"}):
        with pytest.raises(ValueError):
            one(spark, "x", bad)


def test_format_checks():
    with pytest.raises(ValueError):
        log_format("SYSLOG", ["a"])
    with pytest.raises(ValueError):
        LogFormat("x", "(a)(b)", ("a",))
    assert log_format("syslog", list("abcde")).optional == {"d"}
    assert log_format("COMMONAPACHELOG", ["a"], "(.)").dash_is_null and not log_format("SYSLOG", ["a"], "(.)").dash_is_null


def test_keys(spark):
    df = spark.range(100).select(F.lit("x").alias("d"), F.lit("/a/b.log").alias("p"))
    k = lambda o: [r[0] for r in df.select(keys.key(o, F.col("d"), F.col("p"))).collect()]
    assert all(0 <= int(x) < 1_000_000 for x in k("RANDOM_INT")) and all(0 <= float(x) < 1e6 for x in k("RANDOM_DOUBLE"))
    assert set(k("FILE_NAME,lit")) == {"b.log,lit"} and set(k("DETERMINISTIC")) == {"9dd4e461268c8034f5c8564e155c67a6"}
