"""Question answering around a user-supplied model: prompts, batched calls, parsing, polls."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callinsight import schemas as S
from callinsight.functions import scalars as X

# Worker functions travel with their code: nothing of this package has to be installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUESTIONS = [
    [
        f"Which one of these topics is the text about: {', '.join(S.TOPICS)}?",
        "Summarize the text in at most 50 words.",
        "Did the call settle the client's concern? Answer Yes or No.",
        f"Which tone did the client use: {', '.join(S.TONES)}? If unsure, answer Neutral.",
        f"Which tone did the agent use: {', '.join(S.TONES)}? If unsure, answer Neutral.",
    ],
    [
        "Did the agent offer an additional product or service? Answer Yes or No.",
        "Did the client accept the offer? Answer Yes or No, and No if nothing was offered.",
        *[f"From 1 to 5, how much {c.replace('_', ' ')} did the agent show?" for c in S.SCORE_COLUMNS],
    ],
]

PROMPT = "Read this text:\n{text}\nAnswer every question in a numbered list, one line each:\n{questions}\n"


@dataclass(frozen=True)
class Block:
    """Questions put to the model in one prompt. ``answers``: the columns of its replies, one for each time it is asked;
    of several the most common answer counts. ``columns``: where the answers go, a column a question."""

    columns: Sequence[str]
    questions: Sequence[str]
    answers: Sequence[str]
    template: str = PROMPT

    def __post_init__(self) -> None:
        if len(self.columns) != len(self.questions) or not self.columns:
            raise ValueError(f"{len(self.columns)} columns for {len(self.questions)} questions")
        if not self.answers:
            raise ValueError("a block is asked once or more")

    @property
    def listed(self) -> str:
        return "\n".join(f"{n}. {q}" for n, q in enumerate(self.questions, start=1))


# The first block is answered once, the second one in each poll.
POLLS = ["poll_1", "poll_2", "poll_3"]


def usual_blocks(polls: Sequence[str] = POLLS) -> list[Block]:
    first, second = S.ANSWER_BLOCKS
    return [Block(first, QUESTIONS[0], ["block_1"]), Block(second, QUESTIONS[1], list(polls))]


def checked_blocks(blocks: Sequence[Block]) -> list[Block]:
    """The blocks, if no column of answers or replies occurs twice."""
    for kind in ("columns", "answers"):
        names = [c for b in blocks for c in getattr(b, kind)]
        if twice := sorted({c for c in names if names.count(c) > 1}):
            raise ValueError(f"{kind} of several questions: {twice}")
    return list(blocks)


def question_table(df: DataFrame, blocks: Sequence[Block] | None = None) -> DataFrame:
    """The questions as rows (block, number, column, question), on the session of ``df``."""
    rows = [
        (b, n, column, question)
        for b, block in enumerate(blocks or usual_blocks(), start=1)
        for n, (column, question) in enumerate(zip(block.columns, block.questions, strict=True), start=1)
    ]
    return df.sparkSession.createDataFrame(rows, "block int, number int, column string, question string")


def prompts(texts: DataFrame, template: str | None = None, questions: list[list[str]] | None = None, blocks: Sequence[Block] | None = None) -> DataFrame:
    """Add one prompt column per question block, ``prompt_1`` and so on.

    ``blocks`` bring their questions and templates; ``questions`` and ``template`` are a short form without columns."""
    if blocks is None:
        asked = [("\n".join(f"{n}. {q}" for n, q in enumerate(b, start=1)), template or PROMPT) for b in questions or QUESTIONS]
    else:
        asked = [(b.listed, template or b.template) for b in blocks]
    return texts.withColumns(
        {f"prompt_{b}": X.render(form, text=F.col("text"), questions=F.lit(listed)) for b, (listed, form) in enumerate(asked, start=1)}
    )


Model = Callable[[pd.DataFrame], pd.DataFrame]


def infer(
    df: DataFrame,
    model: Model | None,
    output: T.StructType,
    keys: list[str],
    batch_size: int = 1,
    make_model: Callable[[], Model] | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Run a batch function over all rows: key columns, its output columns, and ``error``.

    The model gets up to ``batch_size`` rows and returns the output columns in the same order. A batch that raises, or
    returns another number of rows, is halved until the rows that cannot be answered stand alone: only those come
    back with NULL outputs and the message in ``error``. Rows reach Python in Arrow batches bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch``.

    ``make_model`` builds the model instead, once in each task that has rows, for models that are costly to load or cannot
    be sent. ``profile`` asks for the executors and accelerators that the model needs.
    """
    if (model is None) == (make_model is None):
        raise ValueError("give either a model or make_model")
    schema = T.StructType(
        [df.schema[k] for k in keys] + list(output.fields) + [T.StructField("error", T.StringType())]
    )
    names = [f.name for f in output.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = model

        def answered(part: pd.DataFrame) -> list[pd.DataFrame]:
            result = part[keys].copy()
            try:
                given = answer(part.reset_index(drop=True))
                if len(given) != len(part):
                    raise ValueError(f"{len(given)} results for {len(part)} rows")
                for name in names:
                    result[name] = given[name].to_numpy()
                result["error"] = None
            except Exception as e:  # reported per row
                if len(part) > 1:
                    half = len(part) // 2
                    return answered(part.iloc[:half]) + answered(part.iloc[half:])
                for name in names:
                    result[name] = None
                result["error"] = f"{type(e).__name__}: {e}"
            return [result]

        for arrow_batch in batches:
            if answer is None and len(arrow_batch):
                answer = make_model()
            results = []  # one frame for each Arrow batch, however small the model's batches are
            for start in range(0, len(arrow_batch), batch_size):
                results += answered(arrow_batch.iloc[start : start + batch_size])
            if results:
                # Columns of errors alone have no type of their own.
                yield pd.concat([r.astype(object) for r in results], ignore_index=True)

    return df.mapInPandas(run, schema, profile=profile)


_WHITE = " \t\n\r"
_CUT = "\x1f"  # parts the items of one list; a control character that an answer cannot hold is removed first


def numbered_items(text: Column, n: int) -> Column:
    """The items of a numbered list, whole, as an array; NULL unless it holds 1 to n, in order.

    An item goes on until a line starts with the next number, over any number of lines, so other numbers
    at the start of a line belong to the item. Each list is matched once.
    """
    items = "".join(rf"^[ \t]*{i}\.(.*?)" for i in range(1, n)) + rf"^[ \t]*{n}\.(.*)"
    pattern = rf"(?smd)\A.*?{items}\z"
    groups = _CUT.join(f"${i}" for i in range(1, n + 1))
    parts = F.split(F.regexp_replace(F.translate(text, _CUT, ""), pattern, groups), _CUT)
    # Bound to a name of its own, so that the pattern runs once however often the parts are looked at.
    return F.get(
        F.transform(F.array(parts), lambda found: F.when(F.size(found) == n, F.transform(found, lambda x: F.btrim(x, F.lit(_WHITE))))), F.lit(0)
    )


def parse_blocks(texts: DataFrame, blocks: Sequence[Block], scores: Sequence[str] = tuple(S.SCORE_COLUMNS)) -> DataFrame:
    """(text_file, a column per question, error) from the numbered lists that answer ``blocks``.

    Where a block was asked several times each item is decided by majority. The replies of a text are columns of its
    row, so the vote is a plain expression without a shuffle. An incomplete list does not vote;
    without a complete one the row's answers are NULL and ``error`` names the block. ``scores``
    become integers; an answer that holds no score from 1 to 5 is an error of the row too.
    """
    blocks = checked_blocks(blocks)
    lists = {reply: f"_items_{b}_{i}" for b, block in enumerate(blocks) for i, reply in enumerate(block.answers)}
    size = {reply: len(block.columns) for block in blocks for reply in block.answers}
    parsed = texts.withColumns({items: numbered_items(F.col(reply), size[reply]) for reply, items in lists.items()})
    missing = [
        F.when(F.coalesce(*[F.col(lists[reply]) for reply in block.answers]).isNull(), f"block {b} incomplete")
        for b, block in enumerate(blocks, start=1)
    ]
    # An error of the model itself is the one to report, then the first block's.
    problem = F.coalesce(*missing)
    parsed = parsed.withColumn("error", F.coalesce("error", problem) if "error" in texts.columns else problem)

    # Each answer becomes a column of its own before votes compare it with the others.
    place = {name: (block, i) for block in blocks for i, name in enumerate(block.columns)}
    given = {name: {f"{lists[reply]}_{i}": (lists[reply], i) for reply in block.answers} for name, (block, i) in place.items()}
    parsed = parsed.withColumns({c: F.get(items, F.lit(i)) for votes in given.values() for c, (items, i) in votes.items()})

    def value(name: str) -> Column:
        votes = [F.col(c) for c in given[name]]
        item = F.when(F.col("error").isNull(), X.most_common(votes) if len(votes) > 1 else votes[0])
        return (X.score_from_text(item) if name in scores else item).alias(name)

    valued = parsed.select("text_file", *[value(name) for name in place], "error")
    unread = [F.when(F.col(name).isNull(), F.lit(f"{name} is no score")) for name in scores if name in place]
    if unread:
        valued = valued.withColumn("error", F.coalesce("error", *unread))
    good = F.col("error").isNull()
    return valued.select("text_file", *[F.when(good, F.col(name)).alias(name) for name in place], "error")


def parse_answers(texts: DataFrame, polls: Sequence[str] = ("block_2",)) -> DataFrame:
    """The usual two blocks: ``block_1``, and the second block from each of ``polls``."""
    return parse_blocks(texts, usual_blocks(polls))


def split_errors(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The good rows without ``error``, and the failed keys with their message."""
    return (
        df.filter(F.col("error").isNull()).drop("error"),
        df.filter(F.col("error").isNotNull()).select(*keys, "error"),
    )


def consolidate_polls(polls: DataFrame) -> DataFrame:
    """Most common answer per (text_file, question); the earliest answer wins a tie.

    Votes are counted per answer first, so what is compared per question is a few rows.
    """
    votes = (
        polls.filter(F.col("answer").isNotNull())
        .repartition("text_file", "question")  # both aggregates run on this one exchange
        .groupBy("text_file", "question", "answer")
        .agg(F.count("*").alias("_n"), F.min("poll").alias("_first"))
    )
    best = F.max_by("answer", F.struct(F.col("_n"), -F.col("_first")))
    return votes.groupBy("text_file", "question").agg(best.alias("answer"), F.max("_n").alias("votes"))


def postprocess_answers(answers: DataFrame) -> DataFrame:
    """Yes/no answers to booleans and tones to their keyword, in one projection; other columns stay as they are."""
    yes_no = {c: X.is_yes(F.col(c)) for c in S.YES_NO_COLUMNS if c in answers.columns}
    tones = {c: X.normalize_tone(F.col(c)) for c in S.TONE_COLUMNS if c in answers.columns}
    return answers.withColumns({**yes_no, **tones}) if yes_no or tones else answers
