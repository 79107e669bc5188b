"""Registered queries and their plain-SQL counterparts.

``queries()`` runs every operator over the star-schema tables (see ``callinsight.sources.star`` for
how calls, people and transcripts derive from them); ``oracle_sql()`` states the same results in
SQL for DuckDB, written independently of the Spark expressions.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.functions import sampling as R
from callinsight.functions import scalars as X
from callinsight.operators import (
    answers,
    filters,
    frame,
    indicators,
    integrity,
    locations,
    outcomes,
    pii,
    quality,
    reconcile,
    relations,
    spans,
    synthesis,
    timeline,
    turns,
    updates,
)
from callinsight.plans import rollup
from callinsight.sources import star
from callinsight.sources.store import CallStore

try:  # the training-data operators may be absent; everything else works without them
    import corpus_pipeline
    from callinsight.llm import queries as llm
except ImportError:
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

BOX = ["minimum", "lower_fence", "q1", "median", "q3", "upper_fence", "maximum"]

# Controls of the filtered dashboard: conditions on values, not on ids.
CONTROLS = {
    "Client Tone": ["Positive", "Neutral"],
    "Effective Communication": (2, 4),
    "Caller City": [f"NATION_{i}" for i in range(0, 25, 2)],
}


def entry(spark: SparkSession) -> DataFrame:
    """Monthly calls next to upsale success and concerns addressed."""
    rows = _frame(spark, SMOKE_DIR)
    volume = timeline.calls_over_time(rows).select("month", "calls")
    return timeline.upsales_vs_concerns(rows).join(volume, "month").orderBy("month")


# --- Queries ----------------------------------------------------------------------------------


@star.reused
def _frame(spark: SparkSession, d: str) -> DataFrame:
    return frame.dashboard_frame(star.calls(spark, d), star.clients(spark, d))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _on_frame(chart: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: chart(_frame(spark, d))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("text_file"), "text"
    )


def _spread_over_calls(spark: SparkSession, d: str) -> DataFrame:
    """Spans of the transcripts that name their speakers; the names come as rows."""
    texts = star.named_transcripts(spark, d).select("text_file", "text")
    return pii.detect_with_names(texts, star.speaker_names(spark, d), "text_file")


def _inputs(spark: SparkSession, d: str) -> DataFrame:
    t = star.deliveries(spark, d)
    return reconcile.accounted(t["calls"], t["texts"], t["recordings"])


def _text_errors(spark: SparkSession, d: str) -> DataFrame:
    t = star.deliveries(spark, d)
    return reconcile.text_errors(t["texts"], reconcile.by_recording(t["calls"], t["texts"]))


#: A block of questions of its own, asked three times; one of its columns is none of the call table's.
CUSTOM_BLOCK = answers.Block(
    ["topic", "refund", "empathy"],
    ["What is it about?", "Was a refund promised?", "How much empathy, from 1 to 5?"],
    ["first", "second", "third"],
    "Text: {text}\nAsked: {questions}",
)


def _custom_answers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")

    def reply(n: int):
        items = [R.pick(f"topic{n}", k, S.TOPICS[:3]), R.pick(f"refund{n}", k, ["Yes", "No"]), R.score(f"empathy{n}", k).cast("string")]
        lines = [F.concat(F.lit(f"{i}. "), item) for i, item in enumerate(items, start=1)]
        return F.when(R.below(f"short{n}", k, 4) == 0, F.concat_ws("\n", *lines[:2])).otherwise(F.concat_ws("\n", *lines))

    texts = star.table(spark, d, "orders").select(
        F.concat(k.cast("string"), F.lit(".anon.txt")).alias("text_file"), *[reply(n).alias(c) for n, c in enumerate(CUSTOM_BLOCK.answers)]
    )
    return answers.parse_blocks(texts, [CUSTOM_BLOCK])


def _custom_prompts(spark: SparkSession, d: str) -> DataFrame:
    asked = answers.prompts(_documents(spark, d), blocks=[CUSTOM_BLOCK])
    return asked.select("text_file", F.md5("prompt_1").alias("prompt_1"))


def _shared_folder(spark: SparkSession) -> str:
    """A new folder that the executors share, below the checkpoint folder; a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='callinsight-')}"
    return f"{root.rstrip('/')}/tables-{uuid.uuid4().hex}"


def _update_days(spark: SparkSession, d: str) -> DataFrame:
    """Updates of some calls of some months, applied to tables stored by month: per day its calls, those updated, and
    whether it was written anew."""
    store = CallStore(spark, _shared_folder(spark), period="month")
    store.insert_calls(star.new_calls(spark, d))
    (first,) = store.manifest.read().tables["call"]
    chosen = (F.month("date") % 5 == 0) & (R.below("touch", F.col("call_id"), 2) == 0)
    store.update_calls("Analyzed", "call_id", "call_id", star.new_calls(spark, d).filter(chosen).select("call_id", F.lit("changed").alias("topic")))
    rewritten = F.col("snapshot") != first.partition("=")[2]
    return store.calls_with_snapshot().groupBy("date").agg(
        F.count("*").alias("calls"),
        F.count_if((F.col("status") == "Analyzed") & (F.col("topic") == "changed")).alias("updated"),
        F.bool_or(rewritten).alias("rewritten"),
    )


def _minutes(spark: SparkSession, d: str, mode: str) -> DataFrame:
    box = quality.value_distribution(star.call_minutes(spark, d), mode, value_column="minutes")
    return box.withColumns({c: F.round(c, 9) for c in BOX})


def _rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollup.rollup(_frame(spark, d))


def _transcript_view(spark: SparkSession, d: str) -> DataFrame:
    anonymized = pii.anonymize(star.transcripts(spark, d)).select(
        F.col("anonymized_file").alias("text_file"), "text"
    )
    grid = frame.transcript_grid(_frame(spark, d))
    return relations.transcript_view(grid, anonymized, star.recordings(spark, d)).drop("Summary")


def _update_chain(spark: SparkSession, d: str) -> DataFrame:
    steps = dict(star.step_outputs(spark, d))
    steps["answered"] = answers.postprocess_answers(steps["answered"])
    return updates.apply_chain(star.new_calls(spark, d), steps)


def _prompts(spark: SparkSession, d: str) -> DataFrame:
    asked = answers.prompts(_documents(spark, d))
    return asked.select("text_file", F.md5("prompt_1").alias("prompt_1"), F.md5("prompt_2").alias("prompt_2"))


def _synthetic_calls(spark: SparkSession, d: str) -> DataFrame:
    keys = star.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return synthesis.synthetic_calls(keys, star.agents(spark, d), star.clients(spark, d))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    t = star.defective(spark, d)
    return integrity.orphans(t["call"], t["client"], "client_id").select("call_id", "client_id", "agent_id", "date", "time")


def _quarantine(spark: SparkSession, d: str) -> DataFrame:
    t = star.defective(spark, d)
    return integrity.with_known_people(t["call"], t["client"], t["agent"]).select("call_id", "known")


def _ordered_updates(spark: SparkSession, d: str) -> DataFrame:
    """Updates by agent, a key that many calls share, with several values, equal order values and NULLs."""
    orders = star.calls(spark, d).select("call_id", "agent_id", "summary")
    data = orders.select(
        "agent_id",
        F.when(F.length("call_id") % 2 == 0, F.col("summary")).alias("topic"),
        F.pmod(F.length("summary"), F.lit(3)).alias("rank"),
    )
    return updates.update_calls(star.calls(spark, d), data, "Analyzed", "agent_id", "agent_id", order_by="rank").select(
        "call_id", "agent_id", "status", "topic"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**call_queries(), **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})}


def oracle_sql() -> dict[str, str]:
    return {**call_sql(), **(llm.oracle_sql() if llm else {})}


def call_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "upsales_by_agent": _on_frame(lambda f: _rounded(outcomes.upsales(f, "comparison"), "share")),
        "upsales_overall": _on_frame(lambda f: _rounded(outcomes.upsales(f, "average"), "share")),
        "upsales_bar_by_agent": _on_frame(
            lambda f: outcomes.upsales(f, "comparison", chart="bar").drop("share")
        ),
        "concerns_by_agent": _on_frame(lambda f: _rounded(outcomes.concerns(f, "comparison"), "share")),
        "concerns_overall": _on_frame(lambda f: _rounded(outcomes.concerns(f, "average"), "share")),
        "concerns_bar_by_agent": _on_frame(
            lambda f: outcomes.concerns(f, "comparison", chart="bar").drop("share")
        ),
        "quality_by_agent": _on_frame(lambda f: _rounded(quality.quality(f, "comparison"), "value")),
        "quality_overall": _on_frame(lambda f: _rounded(quality.quality(f, "average"), "value")),
        "communication_box_by_agent": _on_frame(lambda f: quality.score_distribution(f, "comparison")),
        "communication_box_overall": _on_frame(lambda f: quality.score_distribution(f, "average")),
        "kpis": _on_frame(lambda f: _rounded(indicators.kpis(f), "value", "delta_relative")),
        "kpis_rollup": lambda spark, d: _rounded(
            rollup.kpis(_rollup(spark, d)).filter("kpi <> 'Number of Callers'"), "value", "delta_relative"
        ),
        "rollup_calls_over_time": lambda spark, d: rollup.calls_over_time(_rollup(spark, d)),
        "rollup_upsales": lambda spark, d: rollup.upsales(_rollup(spark, d)),
        "rollup_quality": lambda spark, d: _rounded(rollup.quality(_rollup(spark, d)), "value"),
        "duration_box": lambda spark, d: _minutes(spark, d, "average"),
        "duration_box_by_agent": lambda spark, d: _minutes(spark, d, "comparison"),
        "agent_list": _on_frame(outcomes.group_list),
        "calls_over_time": _on_frame(timeline.calls_over_time),
        "upsales_vs_concerns_by_month": _on_frame(
            lambda f: _rounded(timeline.upsales_vs_concerns(f), "upsales_success", "concerns_addressed")
        ),
        "monthly_metrics": _on_frame(lambda f: _rounded(timeline.monthly_metrics(f), "value")),
        "call_locations": _on_frame(lambda f: _rounded(locations.call_locations(f), "size")),
        "call_locations_from_tables": lambda spark, d: _rounded(
            locations.call_locations_from_tables(star.calls(spark, d), star.clients(spark, d)), "size"
        ),
        "dashboard_frame": _on_frame(frame.with_targets),
        "dashboard_filtered": _on_frame(lambda f: filters.apply_controls(f, CONTROLS)),
        "kpis_filtered": _on_frame(
            lambda f: _rounded(indicators.kpis(filters.apply_controls(f, CONTROLS)), "value", "delta_relative")
        ),
        "transcript_grid": _on_frame(frame.transcript_grid),
        "transcript_view": _transcript_view,
        "calls_without_recording": lambda spark, d: relations.calls_without_recording(
            star.new_calls(spark, d), star.recordings(spark, d)
        ).select("call_id", "audio_file", "date"),
        "batch_for_analysis": lambda spark, d: relations.create_batch_for_analysis(
            star.metadata(spark, d), star.audio(spark, d)
        ),
        "postprocess_answers": lambda spark, d: answers.postprocess_answers(star.answers(spark, d)),
        "parse_answers": lambda spark, d: answers.parse_answers(star.answer_texts(spark, d), ["poll_1"]),
        "parse_answers_untidy": lambda spark, d: answers.parse_answers(
            star.answer_texts(spark, d).withColumn("block_1", F.regexp_replace("block_1", r"(?m)^2\. (.*)$", "2. $1\n  2. again\nand 7. more")),
            ["poll_1"],
        ),
        "parse_polled_answers": lambda spark, d: answers.parse_answers(
            star.answer_texts(spark, d), ["poll_1", "poll_2", "poll_3"]
        ),
        "poll_answers": lambda spark, d: answers.consolidate_polls(star.poll_answers(spark, d)),
        "question_prompts": _prompts,
        "custom_block_answers": _custom_answers,
        "custom_block_prompts": _custom_prompts,
        "inputs_accounted": _inputs,
        "input_errors": _text_errors,
        "update_calls_days": _update_days,
        "update_calls_chain": _update_chain,
        "update_calls_ordered": _ordered_updates,
        "integrity_report": lambda spark, d: integrity.integrity_report(star.defective(spark, d)),
        "orphan_calls": _orphans,
        "quarantined_calls": _quarantine,
        "calls_per_client": lambda spark, d: relations.calls_of(
            star.clients(spark, d), star.calls(spark, d), "client_id"
        ),
        "calls_per_agent": lambda spark, d: relations.calls_of(
            star.agents(spark, d), star.calls(spark, d), "agent_id"
        ),
        "client_call_totals": lambda spark, d: relations.call_totals(
            star.clients(spark, d), star.calls(spark, d), "client_id"
        ),
        "anonymize_documents": lambda spark, d: pii.anonymize(_documents(spark, d), ["EMAIL", "PHONE"]),
        "anonymize_calls": lambda spark, d: pii.anonymize(
            star.named_transcripts(spark, d), names_column="names"
        ),
        "pii_report": lambda spark, d: pii.pii_report(_documents(spark, d)),
        "pii_findings": lambda spark, d: pii.pii_report(_documents(spark, d), full=True),
        "pii_highlighted": lambda spark, d: pii.highlighted(pii.detect(_documents(spark, d), ["EMAIL", "PHONE"])),
        "pii_spans_calls": lambda spark, d: spans.as_rows(_spread_over_calls(spark, d)),
        "pii_report_calls": lambda spark, d: spans.report(_spread_over_calls(spark, d)),
        "pii_highlighted_calls": lambda spark, d: pii.highlighted(_spread_over_calls(spark, d)),
        "clean_transcripts": lambda spark, d: _documents(spark, d).select(
            "text_file", X.drop_blank_lines(F.col("text")).alias("text")
        ),
        "transcript_turns": lambda spark, d: turns.split_turns(star.transcripts(spark, d)),
        "talk_stats": lambda spark, d: _rounded(
            turns.talk_stats(turns.split_turns(star.transcripts(spark, d))), "minutes", "share"
        ),
        "conversation_talk_stats": lambda spark, d: _rounded(
            turns.talk_stats(star.conversation_turns(spark, d)), "minutes", "share"
        ),
        "transcript_markdown": lambda spark, d: star.transcripts(spark, d).select(
            "text_file", X.as_markdown(F.col("text")).alias("transcript")
        ),
        "synthetic_calls": _synthetic_calls,
        "synthetic_ground_truths": lambda spark, d: synthesis.ground_truths(_synthetic_calls(spark, d)),
        "synthetic_clients": lambda spark, d: synthesis.synthetic_clients(
            star.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
        ),
        "synthetic_agents": lambda spark, d: synthesis.synthetic_agents(
            star.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), "es"
        ),
    }


# --- SQL --------------------------------------------------------------------------------------


def _h(tag: str, k: str) -> str:
    return f"(('0x' || substr(md5('{tag}:' || {k}), 1, 8))::BIGINT)"


def _q(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    return "'" + str(value).replace("'", "''") + "'"


def _pick(tag: str, choices: list, k: str) -> str:
    return f"([{', '.join(_q(c) for c in choices)}])[1 + {_h(tag, k)} % {len(choices)}]"


def _one_to_five(tag: str, k: str) -> str:
    return f"(1 + {_h(tag, k)} % 5)::INTEGER"


def _clock(sec: str) -> str:
    return f"format('{{:02d}}:{{:02d}}:{{:02d}}', ({sec}) // 3600, ({sec}) % 3600 // 60, ({sec}) % 60)"


def _sql_raw_answers(k: str) -> dict[str, str]:
    return {
        "topic": _pick("topic", S.TOPICS, k),
        "summary": f"'Call ' || {k}",
        **{c: _pick(c, star.YES_NO_ANSWERS, k) for c in S.YES_NO_COLUMNS},
        **{c: _pick(c, star.TONE_ANSWERS, k) for c in S.TONE_COLUMNS},
        **{
            c: f"CASE WHEN {_h('null_' + c, k)} % 19 <> 0 THEN {_one_to_five(c, k)} END"
            for c in S.SCORE_COLUMNS
        },
    }


def _yes(x: str) -> str:
    return f"contains(lower({x}), 'yes')"


def _tone(x: str) -> str:
    return (
        f"CASE WHEN contains({x}, 'Positive') THEN 'Positive' WHEN contains({x}, 'Negative') THEN 'Negative' "
        f"WHEN contains({x}, 'Neutral') THEN 'Neutral' ELSE {x} END"
    )


def _clean(raw: dict[str, str]) -> dict[str, str]:
    done = dict(raw)
    done.update({c: _yes(raw[c]) for c in S.YES_NO_COLUMNS})
    done.update({c: _tone(raw[c]) for c in S.TONE_COLUMNS})
    return done


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in columns.items())


def call_sql() -> dict[str, str]:
    k = "o_orderkey"
    n_agents = "(SELECT count(*) FROM supplier)"
    base = {
        "call_id": f"{k}::VARCHAR",
        "client_id": "o_custkey::VARCHAR",
        "agent_id": f"'A' || lpad(({_h('agent', k)} % {n_agents})::VARCHAR, 10, '0')",
        "date": "o_orderdate::DATE",
        "time": _clock(f"32400 + {_h('time', k)} % 28801"),
    }
    clients = """clients AS (SELECT c_custkey::VARCHAR AS client_id, 'Customer' AS first_name,
        split_part(c_name, '#', 2) AS last_name, n_name AS client_city,
        '555-' || lpad((%s %% 1000)::VARCHAR, 3, '0') || '-' || lpad((%s %% 10000)::VARCHAR, 4, '0') AS phone_number,
        'client' || c_custkey || '@example.com' AS email,
        (25 + n_nationkey)::VARCHAR AS latitude, (-(70 + n_nationkey))::VARCHAR AS longitude
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)""" % (
        _h("phone_a", "c_custkey"),
        _h("phone_b", "c_custkey"),
    )
    agents = """agents AS (SELECT 'A' || lpad(s_suppkey::VARCHAR, 10, '0') AS agent_id, 'Supplier' AS first_name,
        split_part(s_name, '#', 2) AS last_name FROM supplier)"""
    values = {
        **base,
        "status": "'Analyzed'",
        "audio_file": f"{k} || '.wav'",
        "transcription_file": f"{k} || '.txt'",
        "anonymized_file": f"{k} || '.anon.txt'",
        **_clean(_sql_raw_answers(k)),
    }
    calls = f"calls AS (SELECT {_list({f.name: values[f.name] for f in S.CALL.fields})} FROM orders)"
    display = ", ".join(f'{f.name} AS "{S.DISPLAY_NAMES.get(f.name, f.name)}"' for f in S.CALL.fields)
    framed = (
        f"WITH {calls}, {clients}, frame AS (SELECT {display}, client_city AS \"Caller City\", latitude, longitude "
        "FROM calls JOIN clients USING (client_id)) "
    )
    outcome = """CASE WHEN NOT "Upsale Attempted" THEN 'No Upsale Attempted'
        WHEN "Upsale Success" THEN 'Successful Upsales' ELSE 'Failed Upsales' END"""
    known = '"Upsale Attempted" IS NOT NULL AND "Upsale Success" IS NOT NULL'
    concern = """CASE WHEN "Concern Addressed" THEN 'Concerns Addressed' ELSE 'Concerns Not Addressed' END"""
    concern_known = '"Concern Addressed" IS NOT NULL'

    def filled(label: str, where: str, labels: list[str], by_agent: bool) -> str:
        """Zero-filled counts: every group with every label, then the counts joined on."""
        listed = ", ".join(f"({_q(x)})" for x in labels)
        group = '(SELECT DISTINCT "Agent ID" FROM frame)' if by_agent else "(SELECT 1)"
        key = '"Agent ID", ' if by_agent else ""
        on = 'USING ("Agent ID", category)' if by_agent else "USING (category)"
        part = 'PARTITION BY "Agent ID"' if by_agent else ""
        return (
            framed + f", c AS (SELECT {key}{label} AS category, count(*) AS n FROM frame WHERE {where} GROUP BY ALL), "
            f"grid AS (SELECT * FROM {group} g CROSS JOIN (VALUES {listed}) l(category)) "
            f"SELECT {key}category, coalesce(n, 0)::BIGINT AS counts, "
            f"round(coalesce(n, 0) / nullif(sum(coalesce(n, 0)) OVER ({part}), 0), 6)::DOUBLE AS share "
            f"FROM grid LEFT JOIN c {on}"
        )

    def bars(label: str, where: str) -> str:
        return (
            framed
            + f'SELECT "Agent ID", {label} AS category, count(*) AS counts FROM frame WHERE {where} GROUP BY ALL'
        )

    metrics = " UNION ALL ".join(
        f"SELECT \"Agent ID\", '{m}' AS metric, \"{m}\" AS v FROM frame" for m in S.QUALITY_METRICS
    )
    means = framed + f', melted AS ({metrics}), means AS (SELECT "Agent ID", metric, avg(v) AS value FROM melted GROUP BY ALL) '

    def box(by_agent: bool) -> str:
        """Sorted scores as lists; quartiles at p*n - 0.5, fences within 1.5 IQR."""
        key = '"Agent ID", ' if by_agent else ""
        group = 'GROUP BY "Agent ID"' if by_agent else ""

        def q(p: float) -> str:
            pos = f"least(greatest(len(xs) * {p} - 0.5, 0), len(xs) - 1)"
            low, high = f"xs[(floor({pos}) + 1)::INTEGER]", f"xs[(ceil({pos}) + 1)::INTEGER]"
            return f"({low} + ({pos} - floor({pos})) * ({high} - {low}))::DOUBLE"

        return (
            framed + f', s AS (SELECT {key}list("Effective Communication" ORDER BY "Effective Communication") AS xs '
            f'FROM frame WHERE "Effective Communication" IS NOT NULL {group}), '
            f"q AS (SELECT {key}xs, {q(0.25)} AS q1, {q(0.5)} AS median, {q(0.75)} AS q3 FROM s) "
            f"SELECT {key}len(xs)::BIGINT AS n, xs[1]::DOUBLE AS minimum, "
            "least(q1, list_min(list_filter(xs, lambda x: x >= q1 - 1.5 * (q3 - q1))))::DOUBLE AS lower_fence, "
            "q1, median, q3, "
            "greatest(q3, list_max(list_filter(xs, lambda x: x <= q3 + 1.5 * (q3 - q1))))::DOUBLE AS upper_fence, "
            "xs[len(xs)]::DOUBLE AS maximum FROM q"
        )

    def minutes_box(by_agent: bool) -> str:
        """The same figures of a continuous column, from sorted lists."""
        key = '"Agent ID", ' if by_agent else ""
        group = 'GROUP BY "Agent ID"' if by_agent else ""

        def q(p: float) -> str:
            pos = f"least(greatest(len(xs) * {p} - 0.5, 0), len(xs) - 1)"
            low, high = f"xs[(floor({pos}) + 1)::INTEGER]", f"xs[(ceil({pos}) + 1)::INTEGER]"
            return f"({low} + ({pos} - floor({pos})) * ({high} - {low}))::DOUBLE"

        figures = {
            "minimum": "xs[1]",
            "lower_fence": "least(q1, list_min(list_filter(xs, lambda x: x >= q1 - 1.5 * (q3 - q1))))",
            "q1": "q1",
            "median": "median",
            "q3": "q3",
            "upper_fence": "greatest(q3, list_max(list_filter(xs, lambda x: x <= q3 + 1.5 * (q3 - q1))))",
            "maximum": "xs[len(xs)]",
        }
        return (
            f'WITH m AS (SELECT {base["agent_id"]} AS "Agent ID", CASE WHEN {_h("no_minutes", k)} % 31 <> 0 THEN o_totalprice / 10000 END AS x FROM orders), '
            f"s AS (SELECT {key}list(x ORDER BY x) AS xs FROM m WHERE x IS NOT NULL {group}), "
            f"q AS (SELECT {key}xs, {q(0.25)} AS q1, {q(0.5)} AS median, {q(0.75)} AS q3 FROM s) "
            f"SELECT {key}len(xs)::BIGINT AS n, " + ", ".join(f"round({e}, 9)::DOUBLE AS {n}" for n, e in figures.items()) + " FROM q"
        )

    def kpis(source: str) -> str:
        def row(name: str, value: str, target: str) -> str:
            return (
                f"SELECT '{name}' AS kpi, round({value}, 6)::DOUBLE AS value, {target}::DOUBLE AS target, "
                f"round(({value} - {target}) / {target}, 6)::DOUBLE AS delta_relative FROM {source}"
            )

        return framed + " UNION ALL ".join(
            [
                row("Upsale Success", 'avg("Upsale Success"::INTEGER)', "0.25"),
                row("Concerns Addressed", 'avg("Concern Addressed"::INTEGER)', "0.5"),
                row("Number of Calls", 'count("Caller ID")', "NULL"),
                row("Number of Agents", 'count(DISTINCT "Agent ID")', "NULL"),
                row("Number of Callers", 'count(DISTINCT "Caller ID")', "NULL"),
            ]
        )

    chosen = (
        "\"Client Tone\" IN ('Positive', 'Neutral') AND \"Effective Communication\" BETWEEN 2 AND 4 "
        f'AND "Caller City" IN ({", ".join(_q(c) for c in CONTROLS["Caller City"])})'
    )
    month = "date_trunc('month', \"Call Date\")::DATE"
    located = (
        framed + ', c AS (SELECT "Caller City", latitude, longitude, count("Caller ID") AS calls, '
        'count("Agent ID") AS agent_ids, count(DISTINCT "Caller ID") AS callers FROM frame GROUP BY ALL), '
        "b AS (SELECT min(calls) AS lo, max(calls) AS hi FROM c) "
        'SELECT "Caller City", latitude, longitude, calls, agent_ids, callers, '
        "round(CASE WHEN hi = lo THEN 50.0 ELSE 10 + 40.0 * (calls - lo) / (hi - lo) END, 6)::DOUBLE AS size FROM c, b"
    )

    # Texts.
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    phone = (
        r"(?:\+\d{1,2} )?\(\d{3}\) ?\d{3}-\d{4}|\b(?:1-)?\d{3}-\d{3}-\d{4}\b"
        r"|\b\d{3}\.\d{3}\.\d{4}\b|\+\d{1,3}(?: \d{2,4}){2,4}\b"
    )
    documents = "docs AS (SELECT doc_id || '.txt' AS text_file, text FROM documents)"
    # An e-mail is taken out of the text before phone numbers are looked for.
    masked = f"regexp_replace(text, '{email}', chr(1), 'g')"

    def anonymized(text: str = "text") -> str:
        m = f"regexp_replace({text}, '{email}', chr(1), 'g')"
        m = f"regexp_replace({m}, '{phone}', chr(2), 'g')"
        return f"replace(replace({m}, chr(1), 'john_doe@email.com'), chr(2), '123456789')"

    transcripts = """transcripts AS (SELECT doc_id::VARCHAR AS call_id, doc_id || '.txt' AS text_file,
        array_to_string(list_transform(string_split(text, chr(10)), lambda line, i:
            CASE (i - 1) % 3 WHEN 0 THEN 'Agent: ' WHEN 1 THEN 'Client: ' ELSE '' END || line), chr(10)) AS text
        FROM documents)"""
    white = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
    turn_rows = (
        f"{transcripts}, parts AS (SELECT call_id, unnest(list_filter(string_split(regexp_replace(text, "
        f"'(?m)^(Agent|Client|Customer):', chr(1) || '\\1:', 'g'), chr(1)), lambda p: trim(p, {white}) <> '')) AS part, "
        "generate_subscripts(list_filter(string_split(regexp_replace(text, "
        f"'(?m)^(Agent|Client|Customer):', chr(1) || '\\1:', 'g'), chr(1)), lambda p: trim(p, {white}) <> ''), 1) - 1 AS turn "
        "FROM transcripts), "
        "turns AS (SELECT call_id, turn::INTEGER AS turn, CASE WHEN starts_with(part, 'Agent:') THEN 'Agent' "
        "WHEN starts_with(part, 'Client:') OR starts_with(part, 'Customer:') THEN 'Client' END AS speaker, "
        f"trim(regexp_replace(part, '^(Agent|Client|Customer):', ''), {white}) AS text FROM parts)"
    )
    stats = (
        ", w AS (SELECT call_id, speaker, len(regexp_extract_all(text, '\\S+')) AS n FROM turns WHERE speaker IS NOT NULL), "
        "g AS (SELECT call_id, speaker, count(*) AS turns, sum(n)::BIGINT AS words FROM w GROUP BY ALL) "
        "SELECT call_id, speaker, turns, words, round(words / 240, 6)::DOUBLE AS minutes, "
        "round(words / nullif(sum(words) OVER (PARTITION BY call_id), 0), 6)::DOUBLE AS share FROM g"
    )
    bold = "replace(regexp_replace(text, '(?m)^([\\pL\\pM\\pN_]+)', '**\\1**', 'g'), chr(10), '  ' || chr(10))"

    # Answers.
    def poll(c: str, p: int) -> str:
        tag = f"poll{p}_{c}"
        return _pick(tag, ["Yes", "No"], k) if c in S.YES_NO_COLUMNS else f"{_one_to_five(tag, k)}::VARCHAR"

    first, second = S.ANSWER_BLOCKS
    raw = _sql_raw_answers(k)

    def short(tag: str) -> str:
        return f"{_h('short_' + tag, k)} % 31 = 0"

    def majority(c: str, ps: list[str]) -> str:
        """Of three answers the one given twice, else the first; incomplete polls are NULL."""
        a, b, d = ps
        return f"CASE WHEN {b} = {d} THEN {b} ELSE coalesce({a}, {b}, {d}) END"

    def parsed(polls: list[int]) -> str:
        given = {c: f"coalesce({raw[c]}::VARCHAR, 'unknown')" for c in first}
        polled = {
            f"p{p}_{c}": f"CASE WHEN NOT ({short(f'poll_{p}')}) THEN {poll(c, p)} END" for c in second for p in polls
        }
        error = (
            f"CASE WHEN {short('block_1')} THEN 'block 1 incomplete' "
            f"WHEN {' AND '.join(short(f'poll_{p}') for p in polls)} THEN 'block 2 incomplete' END"
        )
        inner = f"SELECT {k} || '.anon.txt' AS text_file, {_list({**given, **polled})}, {error} AS error FROM orders"
        out = {}
        for c in S.ANSWER_COLUMNS:
            if c in first:
                e = c
            elif len(polls) == 1:
                e = f"p{polls[0]}_{c}"
            else:
                e = majority(c, [f"p{p}_{c}" for p in polls])
            e = f"CASE WHEN error IS NULL THEN {e} END"
            out[c] = f"({e})::INTEGER" if c in S.SCORE_COLUMNS else e
        return f"WITH t AS ({inner}) SELECT text_file, {_list(out)}, error FROM t"

    poll_rows = " UNION ALL ".join(
        f"SELECT {k} || '.anon.txt' AS text_file, '{c}' AS question, {p} AS poll, {poll(c, p)} AS answer FROM orders"
        for c in second
        for p in (1, 2, 3)
    )

    def render(template: str, fields: dict[str, str]) -> str:
        parts = []
        rest = template
        while "{" in rest:
            literal, _, rest = rest.partition("{")
            name, _, rest = rest.partition("}")
            parts += [_q(literal)] * bool(literal) + [fields[name]]
        parts += [_q(rest)] * bool(rest)
        return " || ".join(parts)

    # The prompts, written out.
    first_list = (
        "1. Which one of these topics is the text about: slow internet speed, billing discrepancies, account login problems, "
        "setting up a new device, phishing or malware concerns, scheduled maintenance notifications, service upgrades, "
        "negotiating pricing, canceling service, customer service feedback?\n"
        "2. Summarize the text in at most 50 words.\n"
        "3. Did the call settle the client's concern? Answer Yes or No.\n"
        "4. Which tone did the client use: Positive, Neutral, Negative? If unsure, answer Neutral.\n"
        "5. Which tone did the agent use: Positive, Neutral, Negative? If unsure, answer Neutral."
    )
    second_list = (
        "1. Did the agent offer an additional product or service? Answer Yes or No.\n"
        "2. Did the client accept the offer? Answer Yes or No, and No if nothing was offered.\n"
        "3. From 1 to 5, how much empathy did the agent show?\n"
        "4. From 1 to 5, how much professionalism did the agent show?\n"
        "5. From 1 to 5, how much kindness did the agent show?\n"
        "6. From 1 to 5, how much effective communication did the agent show?\n"
        "7. From 1 to 5, how much active listening did the agent show?\n"
        "8. From 1 to 5, how much customization did the agent show?"
    )
    prompts = {
        f"prompt_{b}": f"md5({_q('Read this text:' + chr(10))} || text || {_q(chr(10) + 'Answer every question in a numbered list, one line each:' + chr(10) + listed + chr(10))})"
        for b, listed in ((1, first_list), (2, second_list))
    }

    # Updates: each step's files are left-joined in turn, a failed step leaves the rest NULL.
    def kept(tag: str) -> str:
        return f"{_h(tag, k)} % 23 <> 0"

    clean = _clean(raw)
    d, t, a, n = (f"({kept('fail_' + s)})" for s in ("diarize", "transcribe", "anonymize", "answer"))
    t_ok, a_ok, n_ok = t, f"({t} AND {a})", f"({t} AND {a} AND {n})"
    chain_columns = {
        **base,
        "status": f"CASE WHEN {n_ok} THEN 'Analyzed' WHEN {a_ok} THEN 'Anonymized' WHEN {t_ok} THEN 'Transcribed' "
        f"WHEN {d} THEN 'Speech diarized' END",
        "audio_file": f"{k} || '.wav'",
        "transcription_file": f"CASE WHEN {t_ok} THEN {k} || '.txt' END",
        "anonymized_file": f"CASE WHEN {a_ok} THEN {k} || '.anon.txt' END",
        **{c: f"CASE WHEN {n_ok} THEN {clean[c]} END" for c in S.ANSWER_COLUMNS},
    }

    # Integrity.
    dirty = (
        f"{clients}, {agents}, "
        f"dirty_client AS (SELECT * REPLACE (CASE WHEN {_h('no_city', 'client_id')} % 37 <> 0 THEN client_city END "
        "AS client_city) FROM clients), "
        f"base AS (SELECT {_list({**base, 'audio_file': k + chr(32) + chr(124) * 2 + chr(32) + _q('.wav')})} FROM orders), "
        "dirty_call AS (SELECT * REPLACE ("
        f"CASE WHEN {_h('orphan', 'call_id')} % 41 = 0 THEN 'X' || client_id ELSE client_id END AS client_id, "
        f"CASE WHEN {_h('no_audio', 'call_id')} % 43 <> 0 THEN audio_file END AS audio_file, "
        f"CASE WHEN {_h('twice', 'call_id')} % 53 = 0 THEN 'same' ELSE call_id END AS call_id), "
        f"CASE WHEN {_h('bad_status', 'call_id')} % 59 = 0 THEN 'Lost' WHEN {_h('status', 'call_id')} % 2 = 0 THEN 'Created' END AS status, "
        f"CASE WHEN {_h('long', 'call_id')} % 47 = 0 THEN repeat('topic ', 10) END AS topic FROM base)"
    )
    source = {"client": "dirty_client", "agent": "agents", "call": "dirty_call"}
    present = {"client": S.CLIENT.fieldNames(), "agent": S.AGENT.fieldNames(), "call": [*base, "audio_file", "topic"]}
    report = []
    for name, schema in S.TABLES.items():
        key = S.PRIMARY_KEYS[name]

        def line(rule: str, column: str, number: str, name: str = name) -> str:
            return (
                f"SELECT '{name}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
                f"({number})::BIGINT AS violations"
            )

        t = source[name]
        report.append(
            line("primary key", key, f"SELECT count(*) FROM (SELECT {key} FROM {t} GROUP BY 1 HAVING count(*) > 1)")
        )
        for f in schema.fields:
            here = f.name in present[name]
            if f.metadata.get("required"):
                report.append(line("not null", f.name, f"SELECT count(*) FROM {t} WHERE {f.name} IS NULL"))
            if "max_length" in f.metadata:
                number = (
                    f"SELECT count(*) FROM {t} WHERE length({f.name}) > {f.metadata['max_length']}" if here else "0"
                )
                report.append(line("length", f.name, number))
        if name == "call":
            statuses = "'Created', 'Audio processed', 'Speech diarized', 'Transcribed', 'Translated', 'Anonymized', 'Analyzed'"
            report.append(line("domain", "status", f"SELECT count(*) FROM {t} WHERE status NOT IN ({statuses})"))
    for child, key, parent in S.FOREIGN_KEYS:
        report.append(
            f"SELECT '{child}' AS table_name, 'foreign key' AS rule, '{key}' AS column_name, (SELECT count(*) FROM "
            f"{source[child]} x WHERE {key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {source[parent]} y "
            f"WHERE y.{key} = x.{key}))::BIGINT AS violations"
        )

    # Synthesis.
    def ranked(people: str, key: str) -> str:
        return (
            f"SELECT *, row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key}) - 1 AS idx FROM {people}"
        )

    settings = synthesis.CallSettings()
    option = _pick("upsale", list(synthesis.UPSALE_OPTIONS), k)

    def of_option(i: int, kind: str) -> str:
        whens = " ".join(f"WHEN {_q(o)} THEN {_q(v[i])}" for o, v in synthesis.UPSALE_OPTIONS.items())
        return f"(CASE {option} {whens} END)::{kind}"

    drawn = {
        "call_id": f"md5('call:' || {k})",
        "text_file": f"md5('call:' || {k}) || '.txt'",
        "date": f"DATE '2024-09-01' + ({_h('date', k)} % 365)::INTEGER",
        "time": _clock(f"32400 + {_h('time', k)} % 28801"),
        "language": "'en'",
        "topic": _pick("topic", S.TOPICS, k),
        "concern_addressed": _pick("concern", [True, False], k),
        "agent_tries_upsale": of_option(0, "BOOLEAN"),
        "agent_succeeds_upsale": of_option(1, "BOOLEAN"),
        **{c: _pick(c, S.TONES, k) for c in S.TONE_COLUMNS},
        **{c: _one_to_five(c, k) for c in S.SCORE_COLUMNS},
    }
    hidden = {
        "upsale_text": of_option(2, "VARCHAR"),
        "agent_idx": f"{_h('agent', k)} % (SELECT count(*) FROM agents)",
        "client_idx": f"{_h('client', k)} % (SELECT count(*) FROM clients)",
    }
    prompt = render(
        synthesis.PROMPT,
        {
            "language": "language",
            "agent_name": "a.first_name || ' ' || a.last_name",
            "client_name": "c.first_name || ' ' || c.last_name",
            "client_email": "c.email",
            "client_phone": "c.phone_number",
            "min_words": _q(settings.min_minutes * 240),
            "max_words": _q(settings.max_minutes * 240),
            "topic": "topic",
            "concern": "CASE WHEN concern_addressed THEN 'resolves' ELSE 'does not resolve' END",
            "upsale": "upsale_text",
            **{c: c for c in S.TONE_COLUMNS + S.SCORE_COLUMNS},
        },
    )
    sampled = (
        f"WITH {clients}, {agents}, ia AS ({ranked('agents', 'agent_id')}), ic AS ({ranked('clients', 'client_id')}), "
        f"drawn AS (SELECT {_list({**drawn, **hidden})} FROM orders), "
        f"sampled AS (SELECT {', '.join('drawn.' + c for c in drawn)}, agent_id, client_id, {prompt} AS prompt "
        "FROM drawn JOIN ia a ON agent_idx = a.idx JOIN ic c ON client_idx = c.idx) "
    )

    def person(key: str, language: str, first_tag: str, last_tag: str) -> dict[str, str]:
        return {
            "first_name": _pick(first_tag, synthesis.FIRST_NAMES[language], key),
            "last_name": _pick(last_tag, synthesis.LAST_NAMES[language], key),
        }

    ck = "c_custkey"
    en = person(ck, "en", "first", "last")

    def city(i: int) -> str:
        return _pick("city", [row[i] for row in synthesis.CITIES], ck)

    new_client = {
        "client_id": f"(10000000 + {ck})::VARCHAR",
        **en,
        "phone_number": f"'555-' || lpad(({_h('phone_a', ck)} % 1000)::VARCHAR, 3, '0') || '-' || "
        f"lpad(({_h('phone_b', ck)} % 10000)::VARCHAR, 4, '0')",
        "email": f"lower({en['first_name']}) || '.' || lower({en['last_name']}) || (10000000 + {ck}) || '@example.com'",
        "client_city": city(0),
        "latitude": city(1),
        "longitude": city(2),
    }

    def people_calls(people: str, key: str) -> str:
        return (
            f"WITH {calls}, {clients}, {agents} SELECT p.{key}, p.first_name, p.last_name, call_id, date, time "
            f"FROM {people} p LEFT JOIN calls USING ({key})"
        )

    greeted = (
        f"WITH {calls}, {clients}, {agents}, {transcripts}, named AS (SELECT t.text_file, "
        "a.first_name || ' ' || a.last_name AS an, a.first_name AS af, a.last_name AS al, "
        "c.first_name || ' ' || c.last_name AS cn, c.first_name AS cf, c.last_name AS cl, t.text "
        "FROM transcripts t JOIN calls USING (call_id) JOIN clients c USING (client_id) JOIN agents a USING (agent_id)), "
        "greeted AS (SELECT * REPLACE ('Agent: This is ' || an || ', do I speak to ' || cn || '?' || chr(10) || text "
        "AS text) FROM named) "
    )
    # Spans: places follow from the pieces between matches. A match that overlaps one of a better kind is none.
    people = "'(?i)\\b(?:' || concat_ws('|', an, cn, al, cl, af, cf) || ')\\b'"

    def placed(entity: str, score: str, pattern: str) -> str:
        return (
            f"SELECT text_file, '{entity}' AS entity, {score}::DOUBLE AS score, unnest(list_transform(hits, lambda h, i: {{'start': "
            "(list_sum(list_transform(pieces[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda q: length(q))), 0))::INTEGER, "
            "'size': length(h)})) AS place FROM (SELECT text_file, "
            f"regexp_extract_all(text, {pattern}) AS hits, string_split_regex(text, {pattern}) AS pieces FROM greeted)"
        )

    spanned = (
        f"found AS ({placed('EMAIL', '1.0', _q(email))} UNION ALL {placed('PHONE', '0.95', _q(phone))} "
        f"UNION ALL {placed('PERSON', '0.9', people)}), "
        'raw AS (SELECT text_file, entity, place.start AS "start", place.start + place.size AS "end", score FROM found), '
        'spans AS (SELECT * FROM raw r WHERE NOT EXISTS (SELECT 1 FROM raw b WHERE b.text_file = r.text_file AND b.score > r.score '
        'AND b."start" < r."end" AND r."start" < b."end")) '
    )
    marked = (
        ", cut AS (SELECT text_file, text, list(s ORDER BY s.\"start\") FILTER (WHERE s.entity IS NOT NULL) AS ss FROM (SELECT g.text_file, g.text, "
        '{\'entity\': entity, \'start\': "start", \'end\': "end"} AS s FROM greeted g LEFT JOIN spans USING (text_file)) GROUP BY ALL) '
    )

    def html(x: str) -> str:
        return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    found_text = "text[s.start + 1:s.end]"
    before = "text[coalesce(ss[i - 1].end, 0) + 1:s.start]"
    calls_html = (
        "SELECT text_file, coalesce(array_to_string(list_transform(ss, lambda s, i: "
        f"{html(before)} || '<mark class=\"' || s.entity || '\">' || {html(found_text)} || '</mark>'), ''), '') || "
        f"{html('text[coalesce(ss[len(ss)].end, 0) + 1:]')} AS html FROM cut"
    )

    # Deliveries that do not fit each other.
    recording = f"CASE WHEN {_h('hot', k)} % 3 = 0 THEN 'hot.wav' WHEN {_h('unnamed', k)} % 17 <> 0 THEN {k} || '.wav' END"
    delivered = (
        f"c AS (SELECT {k}::VARCHAR AS call_id, {recording} AS audio_file FROM orders), "
        f"t0 AS (SELECT CASE WHEN {_h('stray', k)} % 19 = 0 THEN 'stray' || {k} || '.wav' ELSE {recording} END AS audio_file, "
        f"{k} || '.txt' AS transcription_file, CASE WHEN {_h('empty', k)} % 23 <> 0 THEN 'Agent: call ' || {k} END AS text "
        f"FROM orders WHERE {_h('no_text', k)} % 13 <> 0), "
        f"t AS (SELECT * FROM t0 UNION ALL SELECT * FROM t0 WHERE {_h('twice', 'transcription_file')} % 29 = 0 "
        f"UNION ALL SELECT audio_file, 'z' || transcription_file, text FROM t0 WHERE {_h('later', 'transcription_file')} % 31 = 0), "
        f"r AS (SELECT {k} || '.wav' AS audio_file FROM orders WHERE {_h('unrecorded', k)} % 37 <> 0), "
        "ranked AS (SELECT *, row_number() OVER w AS n, dense_rank() OVER w AS d FROM t WINDOW w AS (PARTITION BY audio_file ORDER BY transcription_file DESC)), "
        "fate AS (SELECT audio_file, transcription_file, CASE WHEN audio_file IS NULL THEN 'no recording named' "
        "WHEN d > 1 THEN 'a later text of the recording is used' "
        "WHEN audio_file NOT IN (SELECT audio_file FROM c WHERE audio_file IS NOT NULL) THEN 'no call has this recording' "
        "WHEN n > 1 THEN 'a later text of the recording is used' "
        "WHEN text IS NULL THEN 'no text' ELSE 'used' END AS outcome FROM ranked) "
    )

    # A block of three questions, asked three times.
    def asked(n: int) -> dict[str, str]:
        full = f"{_h(f'short{n}', k)} % 4 <> 0"
        given = {"topic": _pick(f"topic{n}", S.TOPICS[:3], k), "refund": _pick(f"refund{n}", ["Yes", "No"], k), "empathy": f"{_one_to_five(f'empathy{n}', k)}::VARCHAR"}
        return {f"{c}{n}": f"CASE WHEN {full} THEN {e} END" for c, e in given.items()}

    custom = (
        f"WITH a AS (SELECT {k} || '.anon.txt' AS text_file, {_list({**asked(0), **asked(1), **asked(2)})} FROM orders) SELECT text_file, "
        + ", ".join(f"{majority(c, [f'{c}{n}' for n in range(3)])}{'::INTEGER' if c == 'empathy' else ''} AS {c}" for c in ("topic", "refund", "empathy"))
        + ", CASE WHEN coalesce(topic0, topic1, topic2) IS NULL THEN 'block 1 incomplete' END AS error FROM a"
    )
    custom_list = "1. What is it about?\n2. Was a refund promised?\n3. How much empathy, from 1 to 5?"

    nameless = f"regexp_replace(regexp_replace(text, '{email}', chr(1), 'g'), '{phone}', chr(2), 'g')"
    for part in ("an", "cn", "af", "cf", "al", "cl"):
        nameless = f"regexp_replace({nameless}, '\\b' || {part} || '\\b', chr(3), 'g')"
    nameless = (
        f"replace(replace(replace({nameless}, chr(1), 'john_doe@email.com'), chr(2), '123456789'), chr(3), 'John Doe')"
    )
    files = (
        "text_file AS original_file, regexp_replace(text_file, '\\.txt$', '.anon.txt') AS anonymized_file, "
        "{text} AS text, NULL::VARCHAR AS error"
    )
    hits = (
        f"SELECT text_file, 'EMAIL' AS entity, regexp_extract_all(text, '{email}') AS hits FROM docs UNION ALL "
        f"SELECT text_file, 'PHONE', regexp_extract_all({masked}, '{phone}') FROM docs"
    )
    escaped = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    audio = (
        f"audio AS (SELECT {k} || '.txt' AS text_file, unnest(CASE WHEN {_h('dup', k)} % 29 = 0 "
        f"THEN [{k} || '.wav', {k} || '_2.wav'] ELSE [{k} || '.wav'] END) AS audio_file FROM orders "
        f"WHERE {_h('fail_audio', k)} % 23 <> 0)"
    )

    return {
        "upsales_by_agent": filled(outcome, known, S.UPSALE_LABELS, True),
        "upsales_overall": filled(outcome, known, S.UPSALE_LABELS, False),
        "upsales_bar_by_agent": bars(outcome, known),
        "concerns_by_agent": filled(concern, concern_known, S.CONCERN_LABELS, True),
        "concerns_overall": filled(concern, concern_known, S.CONCERN_LABELS, False),
        "concerns_bar_by_agent": bars(concern, concern_known),
        "quality_by_agent": means + 'SELECT "Agent ID", metric, round(value, 6) AS value FROM means',
        "quality_overall": means + "SELECT metric, round(avg(value), 6) AS value FROM means GROUP BY metric",
        "communication_box_by_agent": box(True),
        "communication_box_overall": box(False),
        "kpis": kpis("frame"),
        "kpis_rollup": kpis("frame").rpartition(" UNION ALL ")[0],
        "rollup_calls_over_time": framed + f"SELECT {month} AS month, count(*) AS calls FROM frame GROUP BY ALL",
        "rollup_upsales": framed + f', o AS (SELECT "Agent ID", 1 AS hit, {outcome} AS category FROM frame WHERE {known}), '
        "l AS (SELECT unnest(['Failed Upsales', 'No Upsale Attempted', 'Successful Upsales']) AS category), "
        'g AS (SELECT DISTINCT "Agent ID", category FROM frame CROSS JOIN l WHERE "Agent ID" IS NOT NULL) '
        'SELECT "Agent ID", category, count(o.hit) AS count FROM g LEFT JOIN o USING ("Agent ID", category) GROUP BY ALL',
        "rollup_quality": means + 'SELECT "Agent ID", metric, round(value, 6) AS value FROM means',
        "duration_box": minutes_box(False),
        "duration_box_by_agent": minutes_box(True),
        "agent_list": framed + 'SELECT DISTINCT "Agent ID" FROM frame WHERE "Agent ID" IS NOT NULL',
        "calls_over_time": framed
        + f"SELECT {month} AS month, strftime({month}, '%Y-%m') AS month_key, strftime({month}, '%b %y') AS label, "
        "count(*) AS calls FROM frame GROUP BY ALL",
        "upsales_vs_concerns_by_month": framed
        + f"SELECT {month} AS month, strftime({month}, '%b %y') AS label, "
        'round(coalesce(avg("Upsale Success"::INTEGER) FILTER (WHERE "Upsale Attempted") * 100, 0.0), 6)::DOUBLE '
        "AS upsales_success, "
        'round(coalesce(0.0 - avg("Concern Addressed"::INTEGER) * 100, 0.0), 6)::DOUBLE AS concerns_addressed '
        "FROM frame GROUP BY ALL",
        "monthly_metrics": framed
        + f"SELECT {month} AS month, strftime({month}, '%b %y') AS label, 'Upsales Success' AS metric, "
        'round(avg("Upsale Success"::INTEGER) * 100, 6)::DOUBLE AS value FROM frame WHERE "Upsale Attempted" GROUP BY ALL '
        f"UNION ALL SELECT {month}, strftime({month}, '%b %y'), 'Concerns Addressed', "
        'round(0.0 - avg("Concern Addressed"::INTEGER) * 100, 6)::DOUBLE FROM frame GROUP BY ALL',
        "call_locations": located,
        "call_locations_from_tables": located,
        "dashboard_frame": framed
        + 'SELECT *, 0.25::DOUBLE AS "Upsale Success Reference", 0.5::DOUBLE AS "Concern Reference" FROM frame',
        "dashboard_filtered": framed + f"SELECT * FROM frame WHERE {chosen}",
        "kpis_filtered": kpis(f"(SELECT * FROM frame WHERE {chosen})"),
        "transcript_grid": framed
        + 'SELECT "Agent ID", "Caller ID", "Topic", "Summary", audio_file, text_file FROM frame',
        "transcript_view": framed
        + f", {transcripts}, {audio}, view AS (SELECT call_id || '.anon.txt' AS text_file, {anonymized()} AS text "
        'FROM transcripts) SELECT "Agent ID", "Caller ID", "Topic", audio_file, text_file, '
        f"{bold} AS transcript, '/recordings/' || audio_file AS audio_path FROM frame JOIN view USING (text_file) "
        "JOIN (SELECT audio_file FROM audio) r USING (audio_file)",
        "calls_without_recording": f"WITH {audio} SELECT {base['call_id']} AS call_id, {k} || '.wav' AS audio_file, "
        f"{base['date']} AS date FROM orders WHERE NOT EXISTS (SELECT 1 FROM audio WHERE audio_file = {k} || '.wav')",
        "batch_for_analysis": f"WITH {audio}, m AS (SELECT {_list(base)}, {k} || '.txt' AS text_file FROM orders) "
        "SELECT call_id, client_id, agent_id, date, time, audio_file FROM m JOIN audio USING (text_file)",
        "postprocess_answers": f"SELECT {k} || '.anon.txt' AS text_file, "
        f"{_list({c: clean[c] for c in S.ANSWER_COLUMNS})} FROM orders",
        "parse_answers": parsed([1]),
        "parse_answers_untidy": "SELECT * REPLACE (summary || chr(10) || '  2. again' || chr(10) || 'and 7. more' AS summary) "
        f"FROM ({parsed([1])})",
        "parse_polled_answers": parsed([1, 2, 3]),
        "poll_answers": f"WITH p AS ({poll_rows}), v AS (SELECT text_file, question, answer, count(*) AS votes, "
        "min(poll) AS first FROM p GROUP BY ALL) SELECT text_file, question, answer, votes FROM v "
        "QUALIFY row_number() OVER (PARTITION BY text_file, question ORDER BY votes DESC, first) = 1",
        "question_prompts": f"WITH {documents} SELECT text_file, {_list(prompts)} FROM docs",
        "custom_block_answers": custom,
        "custom_block_prompts": f"WITH {documents} SELECT text_file, md5('Text: ' || text || chr(10) || 'Asked: ' || {_q(custom_list)}) AS prompt_1 FROM docs",
        "inputs_accounted": f"WITH {delivered} SELECT 'text' AS input, outcome, count(*) AS rows FROM fate GROUP BY ALL UNION ALL "
        "SELECT 'call', CASE WHEN audio_file IS NULL THEN 'no recording named' WHEN audio_file NOT IN (SELECT audio_file FROM r) "
        "THEN 'no such recording' WHEN audio_file IN (SELECT audio_file FROM t WHERE audio_file IS NOT NULL) THEN 'has a text' "
        "ELSE 'no transcript' END, count(*) FROM c GROUP BY ALL UNION ALL "
        "SELECT 'recording', CASE WHEN audio_file IN (SELECT audio_file FROM c WHERE audio_file IS NOT NULL) THEN 'used' "
        "ELSE 'no call has this recording' END, count(*) FROM r GROUP BY ALL",
        "input_errors": f"WITH {delivered} SELECT audio_file, transcription_file, outcome AS error FROM fate WHERE outcome <> 'used'",
        "update_calls_days": "WITH u AS (SELECT o_orderdate::DATE AS date, month(o_orderdate) % 5 = 0 "
        f"AND {_h('touch', k)} % 2 = 0 AS hit FROM orders), d AS (SELECT date, count(*) AS calls, count_if(hit)::BIGINT AS updated FROM u GROUP BY date) "
        "SELECT date, calls, updated, max(updated) OVER (PARTITION BY date_trunc('month', date)) > 0 AS rewritten FROM d",
        "update_calls_chain": f"SELECT {_list({f.name: chain_columns[f.name] for f in S.CALL.fields})} FROM orders",
        "integrity_report": f"WITH {dirty} " + " UNION ALL ".join(report),
        "orphan_calls": f"WITH {dirty} SELECT call_id, client_id, agent_id, date, time FROM dirty_call x "
        "WHERE NOT EXISTS (SELECT 1 FROM dirty_client y WHERE y.client_id = x.client_id)",
        "quarantined_calls": f"WITH {dirty} SELECT call_id, coalesce(client_id IN (SELECT client_id FROM dirty_client "
        "WHERE client_id IS NOT NULL), false) AND coalesce(agent_id IN (SELECT agent_id FROM agents), false) AS known FROM dirty_call",
        "update_calls_ordered": f"WITH {calls}, u AS (SELECT agent_id, CASE WHEN len(call_id) % 2 = 0 THEN summary END AS topic, "
        "len(summary) % 3 AS rank FROM calls), newest AS (SELECT agent_id, max(rank) AS rank FROM u GROUP BY agent_id), "
        "won AS (SELECT agent_id, max(topic) AS topic FROM u JOIN newest USING (agent_id, rank) GROUP BY agent_id) "
        "SELECT call_id, agent_id, 'Analyzed' AS status, won.topic FROM calls JOIN won USING (agent_id)",
        "calls_per_client": people_calls("clients", "client_id"),
        "calls_per_agent": people_calls("agents", "agent_id"),
        "client_call_totals": f"WITH {calls}, {clients} SELECT p.client_id, count(call_id) AS calls, "
        "min(date) AS first_day, max(date) AS last_day FROM clients p LEFT JOIN calls USING (client_id) GROUP BY ALL",
        "anonymize_documents": f"WITH {documents} SELECT {files.format(text=anonymized())} FROM docs",
        "anonymize_calls": greeted + f"SELECT {files.format(text=nameless)} FROM greeted",
        "pii_report": f"WITH {documents}, hits AS ({hits}) SELECT text_file, entity, len(hits)::INTEGER AS findings "
        "FROM hits WHERE len(hits) > 0",
        "pii_findings": f"WITH {documents}, hits AS ({hits}) SELECT text_file, entity, unnest(hits) AS finding, "
        "(generate_subscripts(hits, 1) - 1)::INTEGER AS position FROM hits",
        "pii_highlighted": f"WITH {documents} SELECT text_file, regexp_replace(regexp_replace({escaped}, '{email}', "
        f"'<mark class=\"EMAIL\">\\0</mark>', 'g'), '{phone}', '<mark class=\"PHONE\">\\0</mark>', 'g') AS html FROM docs",
        "pii_spans_calls": greeted + ", " + spanned + 'SELECT text_file, entity, "start", "end", score FROM spans',
        "pii_report_calls": greeted + ", " + spanned + "SELECT text_file, entity, count(*)::INTEGER AS findings FROM spans GROUP BY ALL",
        "pii_highlighted_calls": greeted + ", " + spanned + marked + calls_html,
        "clean_transcripts": f"WITH {documents} SELECT text_file, array_to_string(list_filter(string_split("
        f"trim(text, {white}), chr(10)), lambda l: regexp_matches(l, '\\S')), chr(10)) AS text FROM docs",
        "transcript_turns": f"WITH {turn_rows} SELECT call_id, turn, speaker, text FROM turns",
        "talk_stats": f"WITH {turn_rows}" + stats,
        "conversation_talk_stats": "WITH turns AS (SELECT conv_id::VARCHAR AS call_id, CASE role WHEN 'user' THEN 'Client' "
        "WHEN 'assistant' THEN 'Agent' END AS speaker, text FROM conversations WHERE role <> 'system')" + stats,
        "transcript_markdown": f"WITH {transcripts} SELECT text_file, {bold} AS transcript FROM transcripts",
        "synthetic_calls": sampled + f"SELECT {', '.join(drawn)}, agent_id, client_id, prompt FROM sampled",
        "synthetic_ground_truths": sampled + f"SELECT {', '.join(S.GROUND_TRUTHS.fieldNames())} FROM sampled",
        "synthetic_clients": f"SELECT {_list(new_client)} FROM customer",
        "synthetic_agents": f"SELECT (10000000 + s_suppkey)::VARCHAR AS agent_id, "
        f"{_list(person('s_suppkey', 'es', 'agent_first', 'agent_last'))} FROM supplier",
    }
