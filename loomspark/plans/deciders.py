"""What decides where a thread is cut: one interface, threads in, breakpoints out."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import turns
from ..operators.linearize import messages
from . import prompts
from .providers import Provider, ask

BREAKPOINTS = "breakpoints array<int>"
#: Output tokens of an answer (fixed value).
BREAKPOINT_TOKENS = 1500
INSTRUCTIONS = "Choose the turns at which a new topic begins, so that chunks have about the wanted number of turns. " + prompts.SENTIMENT_TAIL


class Decider(Protocol):
    """decide(threads, target) -> (conversation_id, breakpoints, status) of every thread with turns.

    Turn numbers in no order and out of range are allowed; an empty or null list means a fixed stride. Rows
    whose status isn't 'ok' have no decision.
    """

    def decide(self, threads: DataFrame, target: int) -> DataFrame: ...


class TableDecider:
    """Breakpoints that a table (conversation_id, breakpoints) already holds; threads that it lacks get a fixed stride."""

    def __init__(self, decided: DataFrame):
        self.decided = decided

    def decide(self, threads: DataFrame, target: int) -> DataFrame:
        found = threads.select("conversation_id").join(self.decided.select("conversation_id", "breakpoints"), "conversation_id", "left")
        return found.withColumn("status", F.lit("ok"))


class FunctionDecider:
    """decide(turns, target): a function of all threads' turns (a DataFrame as operators.turns.turns gives it) to (conversation_id, breakpoints)."""

    def __init__(self, decide: Callable[[DataFrame, int], DataFrame]):
        self.own = decide

    def decide(self, threads: DataFrame, target: int) -> DataFrame:
        return TableDecider(self.own(turns.turns(messages(threads)), target)).decide(threads, target)


class ModelDecider:
    """A model that is shown a thread's turns. Answers that can't be read mean a fixed stride; a call that fails has no decision."""

    def __init__(self, provider: Provider):
        self.provider = provider

    def decide(self, threads: DataFrame, target: int) -> DataFrame:
        asked = prompts.breakpoint_requests(turns.turns(messages(threads)), threads, target).withColumnRenamed("request", "prompt")
        answers = ask(self.provider, asked, ["conversation_id"], BREAKPOINTS, INSTRUCTIONS, BREAKPOINT_TOKENS)
        status = F.when(F.startswith("status", F.lit("error")), F.col("status")).otherwise(F.lit("ok"))
        return answers.select("conversation_id", "breakpoints", status.alias("status"))
