import datetime as dt
import re

import numpy as np
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.functions import sampling as R
from callinsight.functions import scalars as X


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_yes_no(spark):
    given = ["Yes", "YES, fully.", "yes.", "No", None]
    assert column(spark, given, X.is_yes) == [True, True, True, False, None]


def test_tone(spark):
    given = ["Positive", "The tone was Negative.", "positive.", "Natural.", "Positive, not Negative", "Neutral", None]
    want = ["Positive", "Negative", "positive.", "Natural.", "Positive", "Neutral", None]
    assert column(spark, given, X.normalize_tone) == want


def test_most_common(spark):
    df = spark.createDataFrame(
        [("b", "a", None), ("4", "5", "4"), ("x", "y", "z"), (None, None, None), ("a", "b", "b")], "a string, b string, c string"
    )
    got = [r[0] for r in df.select(X.most_common([F.col(c) for c in "abc"])).collect()]
    assert got == ["b", "4", "x", None, "b"]


def test_score_from_text(spark):
    assert column(spark, ["4", "Score: 3 of 5", "none", None], X.score_from_text) == [4, 3, None, None]


def test_outcome(spark):
    df = spark.createDataFrame(
        [(False, False), (False, True), (True, True), (True, False), (True, None), (None, True)], "a boolean, s boolean"
    )
    got = [r[0] for r in df.select(X.upsale_outcome(F.col("a"), F.col("s"))).collect()]
    none, ok, failed = "No Upsale Attempted", "Successful Upsales", "Failed Upsales"
    assert got == [none, none, ok, failed, None, None]


def test_months_and_days(spark):
    day = spark.createDataFrame([(dt.date(2024, 9, 17),)], "d date")
    month = X.month_start(F.col("d"))
    row = day.select(month, X.month_label(month), X.month_key(month), X.parse_day(F.lit("08.31.2025"))).first()
    assert tuple(row) == (dt.date(2024, 9, 1), "Sep 24", "2024-09", dt.date(2025, 8, 31))


def test_clock_wraps(spark):
    assert column(spark, [0, 86399, 86400, 90061], X.clock, "int") == ["00:00:00", "23:59:59", "00:00:00", "01:01:01"]


def test_blank_lines(spark):
    text = "\n  Agent: hi\n\n   \nClient: yes\r\n\t\nAgent: bye  \n\n"
    lines = [x for x in text.strip().splitlines() if x.strip()]
    assert column(spark, [text], X.drop_blank_lines) == ["\n".join(lines)]


def test_markdown(spark):
    import re

    text = "Agent: hi there\n continued\nÉtion: oui\n1st line"
    want = re.sub(r"^(\w+)", r"**\1**", text.replace("\n", "  \n"), flags=re.MULTILINE)
    assert column(spark, [text], X.as_markdown) == [want]


def test_bubble_size(spark):
    df = spark.createDataFrame([(1, 1, 9), (5, 1, 9), (9, 1, 9), (7, 7, 7)], "v int, lo int, hi int")
    got = [r[0] for r in df.select(X.bubble_size(F.col("v"), F.col("lo"), F.col("hi"))).collect()]
    assert got == [float(np.interp(v, (1, 9), (10, 50))) for v in (1, 5, 9)] + [50.0]


def test_render(spark):
    got = spark.range(1).select(X.render("a {x} b {y}!", x=F.col("id"), y=F.lit("z"))).first()[0]
    assert got == "a 0 b z!"


def test_explicit_order(spark):
    df = spark.createDataFrame([(x,) for x in S.UPSALE_LABELS], "c string")
    got = [r[0] for r in df.orderBy(X.in_order(F.col("c"), S.UPSALE_ORDER)).collect()]
    assert got == S.UPSALE_ORDER


def test_random_times_wrap_past_midnight(spark):
    ids = spark.range(2000)
    clock = lambda a, b: [r[0] for r in ids.select(X.clock(R.random_second("t", F.col("id"), a, b))).collect()]
    day = clock(9 * 3600, 17 * 3600)
    assert min(day) >= "09:00:00" and max(day) <= "17:00:00"
    night = clock(22 * 3600, 6 * 3600)
    assert all(t >= "22:00:00" or t <= "06:00:00" for t in night)
    assert any(t >= "22:00:00" for t in night) and any(t <= "06:00:00" for t in night)
    # The end hour not being later than the start hour adds a day, even for half an hour.
    assert any(t > "12:00:00" for t in clock(9 * 3600, 9 * 3600 + 1800))


def test_random_days_are_inclusive_and_repeatable(spark):
    first, last = F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 3))
    draw = lambda n: [r[0].day for r in spark.range(500).repartition(n).select(R.random_day("d", F.col("id"), first, last)).orderBy(F.col("id")).collect()]
    one = draw(1)
    assert set(one) == {1, 2, 3}
    assert one == draw(7)


def test_score_is_the_first_number_alone(spark):
    answers = ["4 out of 5", "10", "-3", "4.5", "level 45", "--3", "a-b 2", "- 5", "3.", "2,", "2,5", "0 then 3", "6", "", None, "x\ny 1\n", "5-4", "-", "1a", "٣ 2"]
    got = spark.createDataFrame([(a,) for a in answers], "a string").select(X.score_from_text(F.col("a"))).collect()
    first = [re.search(r"-?[0-9]+(?:[.,][0-9]+)?", a or "") for a in answers]
    assert [r[0] for r in got] == [int(m[0]) if m and re.fullmatch("[1-5]", m[0]) else None for m in first]
    plan = spark.range(1).select(X.score_from_text(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("cast(id") == 1
