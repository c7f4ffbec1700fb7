"""Instruction pairs: building, scoring with a reward model, filtering."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.prompts import PROMPT_TEMPLATE, messages, prompt_parts, render_chat, render_prompt
from corpusloom.functions.text import strip

# The metrics of the reward record.
METRICS = ("helpfulness", "correctness", "coherence", "complexity", "verbosity")
OVERALL = ("helpfulness", "correctness", "coherence")

Messages = list[dict[str, str]]
RewardClient = Callable[[Messages], dict[str, float]]


def qa_to_sft(df: DataFrame, context: Column, question: Column, answer: Column) -> DataFrame:
    """``(input, output)`` from question-answer rows; other columns are dropped."""
    return df.select(
        F.concat(strip(context), F.lit("\n\n"), strip(question)).alias("input"),
        strip(answer).alias("output"),
    )


def to_messages(df: DataFrame, context_field: str = "input", response_field: str = "output") -> DataFrame:
    return df.withColumn("messages", messages(F.col(context_field), F.col(response_field)))


def render_prompts(df: DataFrame, template: str | None = None) -> DataFrame:
    args = [F.col("input"), F.col("output")] + ([template] if template else [])
    return df.withColumn("prompt", render_prompt(*args))


def tokenize_pairs(
    df: DataFrame,
    tokenizer: Callable[[Column], Column],
    template: str = PROMPT_TEMPLATE,
    eod_id: int | None = None,
    context_field: str = "input",
    response_field: str = "output",
) -> DataFrame:
    """Add ``token_ids``, ``n_prompt`` and ``n_tokens``: the filled template as one training example.

    The prompt and the answer are tokenised apart, so that the answer's tokens are the
    same whatever the question; the first ``n_prompt`` tokens are given and bring no loss.
    ``eod_id`` is put at the end, if there is one. A pair without input or output has the
    template's own tokens only.
    """
    field = lambda name: F.coalesce(F.col(name), F.lit(""))
    given, answer = prompt_parts(field(context_field), field(response_field), template)
    end = F.array() if eod_id is None else F.array(F.lit(eod_id))
    taken = df.withColumns({"_given": tokenizer(given), "_answer": F.concat(tokenizer(answer), end.cast("array<int>"))})
    return taken.withColumns(
        {
            "token_ids": F.concat("_given", "_answer"),
            "n_prompt": F.size("_given"),
            "n_tokens": F.size("_given") + F.size("_answer"),
        }
    ).drop("_given", "_answer")


def turn_pairs(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, input, output)``: each user turn answered by the next turn.

    Joins on (conversation, turn number), which is unique, so a conversation of
    any length is spread like any other rows.
    """
    user = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("input")
    )
    reply = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    return user.join(reply, ["conv_id", "turn"])


def render_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, conversation)`` from one row per turn; a conversation is one record."""
    return turns.groupBy("conv_id").agg(
        render_chat(F.collect_list(F.struct("turn", "role", "text"))).alias("conversation")
    )


def reward_struct(rewards: dict[str, Column]) -> Column:
    """The reward record from one column per metric."""
    return F.struct(*[rewards[m].cast("double").alias(m) for m in METRICS])


def with_overall(df: DataFrame, reward_field: str = "reward") -> DataFrame:
    """Add ``overall``, the mean of helpfulness, correctness and coherence, to the record."""
    reward = F.col(reward_field)
    total = reward[OVERALL[0]] + reward[OVERALL[1]] + reward[OVERALL[2]]
    return df.withColumn(reward_field, reward.withField("overall", total / 3))


def score_pairs(
    df: DataFrame,
    client_factory: Callable[[], RewardClient],
    context_field: str = "input",
    response_field: str = "output",
    attempts: int = 5,
    backoff: float = 1.0,
) -> DataFrame:
    """Add ``reward`` by calling a reward model once per row.

    ``client_factory`` runs once per task. A failed call is repeated with
    doubled waits; the last failure is raised.
    """
    reward_type = T.StructType([T.StructField(m, T.DoubleType()) for m in METRICS])

    def call(client: RewardClient, conversation: Messages) -> dict[str, float]:
        for attempt in range(attempts):
            try:
                return client(conversation)
            except Exception:
                if attempt + 1 == attempts:
                    raise
                time.sleep(backoff * 2**attempt)
        raise ValueError("attempts must be positive")

    @F.pandas_udf(reward_type)
    def compute(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        client = client_factory()
        for contexts, responses in batches:
            rows = [
                call(
                    client,
                    [
                        {"role": "user", "content": context},
                        {"role": "assistant", "content": response},
                    ],
                )
                for context, response in zip(contexts, responses, strict=True)
            ]
            yield pd.DataFrame(rows, columns=list(METRICS), dtype="float64")

    # Not deterministic, so that a filter on the reward does not call the model twice.
    once = compute.asNondeterministic()
    return df.withColumn("reward", once(context_field, response_field))


def openai_reward_client(
    endpoint: str, model: str, api_key_variable: str
) -> Callable[[], RewardClient]:
    """Factory for a reward model behind an OpenAI-compatible endpoint.

    The key is read on the executor from the named environment variable and is
    never part of the plan. Needs the ``openai`` package on the executors.
    """

    def factory() -> RewardClient:
        from openai import OpenAI

        client = OpenAI(base_url=endpoint, api_key=os.environ[api_key_variable])

        def query(conversation: Messages) -> dict[str, float]:
            answer = client.chat.completions.create(messages=conversation, model=model)
            return {item.token: item.logprob for item in answer.choices[0].logprobs.content}

        return query

    return factory


def reward_filter(df: DataFrame, field: str = "overall", threshold: float = 3.5) -> DataFrame:
    """Rows whose metric is strictly above the threshold, without the reward record."""
    if field not in (*METRICS, "overall"):
        raise ValueError(f"unknown metric {field!r}")
    return df.where(F.col("reward")[field] > threshold).drop("reward")
