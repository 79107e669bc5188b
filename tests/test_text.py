"""Transcripts: turns, talk statistics, anonymization, question answering."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S
from callinsight.operators import answers, pii, relations, turns

TEXT = (
    "[start]\n"
    "Agent: Hello, this is Ann Lee.\nHow can I help?\n"
    "Customer: Hi, I am Bob Ray. Mail bob.ray@example.com or 123-456-7890.\n"
    "Agent: Thanks, Bob! Agent: is my title.\n"
    "Client: Or +1 (743) 555-3824, not 233.233.171.252 or 4785380592391139.\n"
)


def texts(spark, *values):
    return spark.createDataFrame(list(values), "text_file string, text string")


def test_turns(spark):
    df = spark.createDataFrame([("1", TEXT), ("2", ""), ("3", None)], "call_id string, text string")
    got = [tuple(r) for r in turns.split_turns(df).orderBy("call_id", "turn").collect()]
    assert [(t, s) for _, t, s, _ in got] == [(0, None), (1, "Agent"), (2, "Client"), (3, "Agent"), (4, "Client")]
    assert got[1][3] == "Hello, this is Ann Lee.\nHow can I help?"
    assert got[3][3] == "Thanks, Bob! Agent: is my title."


def test_turns_need_no_shuffle(spark):
    df = spark.createDataFrame([("1", TEXT)], "call_id string, text string")
    plan = turns.split_turns(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_talk_stats(spark):
    rows = [("1", 0, "Agent", "one two three"), ("1", 1, "Client", "four"), ("1", 2, "Agent", ""), ("1", 3, None, "noise"), ("2", 0, "Client", "x " * 240)]
    df = spark.createDataFrame(rows, "call_id string, turn int, speaker string, text string")
    got = {(r.call_id, r.speaker): (r.turns, r.words, r.minutes, r.share) for r in turns.talk_stats(df).collect()}
    assert got == {("1", "Agent"): (2, 3, 3 / 240, 0.75), ("1", "Client"): (1, 1, 1 / 240, 0.25), ("2", "Client"): (1, 240, 1.0, 1.0)}


def brute_force(text, names):
    """Entities one after another in order of score, on text with the earlier findings cut out."""
    marks = {"EMAIL": "\x01", "PHONE": "\x02", "PERSON": "\x03"}
    for entity in ("EMAIL", "PHONE"):
        text = re.sub(pii.PATTERNS[entity], marks[entity], text)
    if names:
        pattern = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
        text = re.sub(rf"\b(?:{pattern})\b", marks["PERSON"], text)
    for entity, mark in marks.items():
        text = text.replace(mark, pii.OPERATORS[entity][1]["new_value"])
    return text


def test_anonymize(spark):
    names = ["Ann Lee", "Ann", "Lee", "Bob Ray", "Bob", "Ray", "", None]
    df = texts(spark, ("1.txt", TEXT), ("2.txt", None)).withColumn("names", F.array(*[F.lit(n).cast("string") for n in names]))
    got = {r.original_file: r for r in pii.anonymize(df, names_column="names").collect()}
    assert got["1.txt"].text == brute_force(TEXT, [n for n in names if n])
    assert got["1.txt"].anonymized_file == "1.anon.txt" and got["1.txt"].error is None
    assert got["2.txt"].text is None and got["2.txt"].error == "no text"
    text = got["1.txt"].text
    assert "233.233.171.252" in text and "4785380592391139" in text
    assert "john_doe@email.com or 123456789" in text and "Or 123456789," in text
    assert "this is John Doe." in text and "Thanks, John Doe!" in text


def test_anonymized_text_has_only_replacements(spark):
    df = texts(spark, ("1.txt", TEXT), ("2.txt", "a@b.co c@d.org 111-222-3333"))
    again = pii.anonymize(df).select(F.col("original_file").alias("text_file"), "text")
    findings = {r.finding for r in pii.pii_report(again, full=True).collect()}
    assert findings <= {o[1]["new_value"] for o in pii.OPERATORS.values()}


def test_names_are_literal(spark):
    df = texts(spark, ("1.txt", "Call J.R. (Joe) now, JxR and J.R.s stay, x\\Ey not xy")).withColumn("names", F.array(F.lit("J.R."), F.lit("x\\Ey")))
    assert pii.anonymize(df, names_column="names").first().text == "Call John Doe (Joe) now, JxR and J.R.s stay, John Doe not xy"


def test_threshold_and_operators(spark):
    df = texts(spark, ("1.txt", "a@b.co 111-222-3333"))
    only_mail = pii.anonymize(df, threshold=0.99)
    assert only_mail.first().text == "john_doe@email.com 111-222-3333"
    custom = pii.anonymize(df, ["EMAIL"], {"EMAIL": ("replace", {"new_value": "<mail>"})})
    assert custom.first().text == "<mail> 111-222-3333"
    with pytest.raises(ValueError):
        pii.anonymize(df, ["EMAIL"], {"EMAIL": ("hash", {})})
    with pytest.raises(ValueError):
        pii.anonymize(df, ["CARD"])


def test_report_and_highlight(spark, rows):
    df = texts(spark, ("1.txt", "<a@b.co> & a@b.co, 111-222-3333"), ("2.txt", "none"))
    assert rows(pii.pii_report(df)) == [("1.txt", "EMAIL", 2), ("1.txt", "PHONE", 1)]
    found = pii.detect(df)
    html = pii.highlighted(found).filter("text_file = '1.txt'").first().html
    mail = '<mark class="EMAIL">a@b.co</mark>'
    assert html == f'&lt;{mail}&gt; &amp; {mail}, <mark class="PHONE">111-222-3333</mark>'


def test_speaker_names(spark):
    client = spark.createDataFrame([("c", "Bob", "Ray")], "client_id string, first_name string, last_name string")
    agent = spark.createDataFrame([("a", "Ann", "Lee")], "agent_id string, first_name string, last_name string")
    df = spark.createDataFrame([("1", "c", "a"), ("2", "x", None)], "call_id string, client_id string, agent_id string")
    got = {r.call_id: r.names for r in relations.with_speaker_names(df, client, agent).collect()}
    assert got == {"1": ["Bob Ray", "Bob", "Ray", "Ann Lee", "Ann", "Lee"], "2": []}


def test_names_from_a_recognizer(spark):
    """A trained recognizer plugs in as a batch function that returns the names it saw."""

    def recognize(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"names": [[w for w in t.split() if w.istitle()] for t in batch["text"]]})

    df = texts(spark, ("1.txt", "ask Maria or Li about it"), ("2.txt", "nobody here"))
    names = T.StructType([T.StructField("names", T.ArrayType(T.StringType()))])
    found = answers.infer(df, recognize, names, ["text_file", "text"], batch_size=8)
    got = {r.original_file: r.text for r in pii.anonymize(found.drop("error"), names_column="names").collect()}
    assert got == {"1.txt": "ask John Doe or John Doe about it", "2.txt": "nobody here"}


BLOCK_1 = "1. billing discrepancies\n2. The client asked about a bill.\n3. Yes.\n4. Natural.\n5. positive.\n"
BLOCK_2 = "1. No\n2. No\n3. 4\n4. 5\n5. 4\n6. 5\n7. 4\n8. 3"


def test_parse_and_postprocess(spark):
    df = spark.createDataFrame(
        [("1", BLOCK_1, BLOCK_2), ("2", "1. x\n3. y", BLOCK_2), ("3", BLOCK_1, None), ("4", BLOCK_1, BLOCK_2.replace("3. 4", "3. 4 out of 5"))],
        "text_file string, block_1 string, block_2 string",
    )
    parsed = answers.parse_answers(df)
    got = {r.text_file: r for r in answers.postprocess_answers(parsed).collect()}
    first = got["1"].asDict()
    assert [first[c] for c in S.SCORE_COLUMNS] == [4, 5, 4, 5, 4, 3]
    assert (first["concern_addressed"], first["upsale_attempted"], first["client_tone"], first["agent_tone"]) == (True, False, "Natural.", "positive.")
    assert first["summary"] == "The client asked about a bill." and first["error"] is None
    assert got["2"].error == "block 1 incomplete" and got["2"].topic is None
    assert got["3"].error == "block 2 incomplete"
    assert got["4"].empathy == 4
    good, bad = answers.split_errors(parsed, ["text_file"])
    assert good.count() == 2 and sorted(r.text_file for r in bad.collect()) == ["2", "3"]


def test_untidy_lists(spark):
    summary = "2. The client called.\n   2. offered refunds\n4 of 5 were paid.\n7. or so"
    untidy = re.sub(r"(?m)^2\. .*$", summary.replace("\\", ""), BLOCK_1, count=1)
    scores = {"ten": "10", "minus": "-3", "level": "level 45", "seven": "7", "part": "4.5"}
    data = [("ok", "Sure:\n\n" + untidy, BLOCK_2)] + [(n, BLOCK_1, BLOCK_2.replace("3. 4", f"3. {x}")) for n, x in scores.items()]
    parsed = answers.parse_answers(spark.createDataFrame(data, "text_file string, block_1 string, block_2 string"))
    got = {r.text_file: r for r in parsed.collect()}
    assert got["ok"].error is None and got["ok"].summary == summary[3:]
    assert {got[n].error for n in scores} == {"empathy is no score"} and {got[n].topic for n in scores} == {None}


def test_names_in_any_case(spark):
    df = spark.createDataFrame([("1.txt", "hi BOB ray \ufdd0 and bobby", ["Bob Ray", "Bob"])], "text_file string, text string, names array<string>")
    assert pii.anonymize(df, names_column="names").first().text == "hi John Doe \ufdd0 and bobby"


def test_phone_forms_and_look_alikes(spark):
    phones = ["555.123.4567", "(555)123-4567", "+44 20 7946 0958", "1-800-555-1234", "+1 (743) 555-3824", "123-456-7890"]
    stay = ["233.233.171.252", "4785380592391139", "4785 3805 9239 1139", "2024-01-15", "3.14159"]
    df = spark.createDataFrame([(x, f"call {x} now") for x in phones + stay], "text_file string, text string")
    got = {r.original_file: r.text for r in pii.anonymize(df, ["PHONE"]).collect()}
    assert {got[x] for x in phones} == {"call 123456789 now"}
    assert all(got[x] == f"call {x} now" for x in stay)


def test_polls_agree_in_both_forms(spark, rows):
    polls = [BLOCK_2, BLOCK_2.replace("3. 4", "3. 5"), BLOCK_2.replace("3. 4", "3. 5").replace("1. No", "1. Yes")]
    df = spark.createDataFrame([("1", BLOCK_1, *polls)], "text_file string, block_1 string, p1 string, p2 string, p3 string")
    row = answers.parse_answers(df, ["p1", "p2", "p3"]).first()
    assert (row.upsale_attempted, row.empathy, row.customization) == ("No", 5, 3)
    long = spark.createDataFrame(
        [("1", q, p, a) for q, given in {"tie": "ba", "major": "454", "null": "x"}.items() for p, a in enumerate(given)] + [("1", "null", 9, None)],
        "text_file string, question string, poll int, answer string",
    )
    assert rows(answers.consolidate_polls(long), "question", "answer", "votes") == [("major", "4", 2), ("null", "x", 1), ("tie", "b", 1)]


def test_question_table(spark):
    got = answers.question_table(spark.range(1)).collect()
    assert [r.column for r in sorted(got, key=lambda r: (r.block, r.number))] == S.ANSWER_COLUMNS
    assert len(got) == 13


def test_prompts_hold_text_and_all_questions(spark):
    row = answers.prompts(texts(spark, ("1.txt", "Agent: hi"))).first()
    for prompt, questions in ((row.prompt_1, answers.QUESTIONS[0]), (row.prompt_2, answers.QUESTIONS[1])):
        assert "Agent: hi" in prompt
        assert all(f"{n}. {q}" in prompt for n, q in enumerate(questions, start=1))


def _lengths(batch: pd.DataFrame) -> pd.DataFrame:
    if batch["text"].str.contains("bad").any():
        raise RuntimeError("cannot read this")
    return pd.DataFrame({"n": batch["text"].str.len()})


N = T.StructType([T.StructField("n", T.LongType())])


@pytest.mark.parametrize("batch_size", [1, 2, 64, 1000])
def test_infer_reports_bad_rows_alone(spark, batch_size):
    df = texts(spark, *[(str(i), "bad" if i in (3, 77) else "x" * i) for i in range(130)]).coalesce(1)
    got = {r.text_file: (r.n, r.error) for r in answers.infer(df, _lengths, N, ["text_file"], batch_size=batch_size).collect()}
    assert len(got) == 130
    for i in range(130):
        assert got[str(i)] == ((None, "RuntimeError: cannot read this") if i in (3, 77) else (i, None))


def test_infer_halves_a_failing_batch(spark):
    calls = spark.sparkContext.accumulator(0)

    def model(batch):
        calls.add(1)
        return _lengths(batch)

    df = texts(spark, *[(str(i), "bad" if i == 9 else "x") for i in range(64)]).coalesce(1)
    answers.infer(df, model, N, ["text_file"], batch_size=64).collect()
    assert calls.value <= 13  # the batch, then two halves at each of six levels


def test_infer_builds_a_model_once_a_task(spark):
    built = spark.sparkContext.accumulator(0)

    def make():
        built.add(1)
        return _lengths

    df = texts(spark, *[(str(i), "x" * i) for i in range(40)]).repartition(2)
    assert answers.infer(df, None, N, ["text_file"], batch_size=3, make_model=make).filter("error is null").count() == 40
    assert built.value == 2
    with pytest.raises(ValueError):
        answers.infer(df, None, N, ["text_file"])


def test_a_model_that_returns_too_few_rows(spark):
    df = texts(spark, ("1", "a"), ("2", "bb"))
    short = answers.infer(df.coalesce(1), lambda b: pd.DataFrame({"n": [1]}), N, ["text_file"], batch_size=2).collect()
    assert [(r.n, r.error) for r in short] == [(1, None), (1, None)]  # alone each has its result
    none = answers.infer(df, lambda b: pd.DataFrame({"n": []}), N, ["text_file"], batch_size=2).collect()
    assert {r.error for r in none} == {"ValueError: 0 results for 1 rows"}


BLOCK = answers.Block(["topic", "refund", "empathy"], ["What?", "Refund?", "1 to 5?"], ["a", "b", "c"], "{questions} | {text}")


def test_a_block_of_ones_own(spark):
    row = answers.prompts(texts(spark, ("1.txt", "hi")), blocks=[BLOCK]).first()
    assert row.prompt_1 == "1. What?\n2. Refund?\n3. 1 to 5? | hi"
    replies = [("1", "1. x\n2. Yes\n3. 4", "1. y\n2. No\n3. 5", "1. y\n2. Yes\n3. 5"), ("2", None, "1. z", ""), ("3", "1. x\n2. Yes\n3. seven", None, None)]
    got = {r.text_file: r for r in answers.parse_blocks(spark.createDataFrame(replies, "text_file string, a string, b string, c string"), [BLOCK]).collect()}
    assert (got["1"].topic, got["1"].refund, got["1"].empathy, got["1"].error) == ("y", "Yes", 5, None)
    assert got["2"].error == "block 1 incomplete" and got["3"].error == "empathy is no score"
    assert [r.column for r in answers.question_table(spark.range(1), [BLOCK]).collect()] == ["topic", "refund", "empathy"]
    with pytest.raises(ValueError):
        answers.Block(["a"], [], ["x"])
    with pytest.raises(ValueError):
        answers.checked_blocks([BLOCK, answers.Block(["topic"], ["Again?"], ["d"])])
