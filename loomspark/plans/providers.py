"""Models behind one interface: requests(request_id, instructions, prompt, schema, max_tokens) in, (request_id, response, error) out.

schema is the JSON schema of the answer, max_tokens what it may cost (0: no limit).

Requests are answered where they lie: a provider is a narrow transformation or a join. Results of calls
that cost money belong in a written table before anything else reads them.
"""

from __future__ import annotations

import heapq
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx
from ..functions.text import distinct_strings, first_n, truncate_bytes
from ..schemas import response_schema
from ..shared import stored

#: Seconds before each further try (fixed values).
RATE_LIMIT_WAITS, SERVER_WAITS = (65, 100), (5, 30)
ANSWER = "request_id string, response string, error string"


class Provider(Protocol):
    def complete(self, requests: DataFrame) -> DataFrame: ...


class ExtractiveProvider:
    """Offline and deterministic: answers are stretches of the prompt. JVM expressions only."""

    def complete(self, requests: DataFrame) -> DataFrame:
        fields = F.filter(F.split("prompt", "\n"), lambda x: F.startswith(x, F.lit("  ")))
        lines = F.when(F.size(fields) > 0, fields).otherwise(F.filter(F.split("prompt", "\n"), lambda x: F.startswith(x, F.lit("- "))))
        said = F.transform(lines, lambda x: F.regexp_replace(x, r"^(- [^:=]*[:=] ?|  [a-z_]+=)", ""))
        said = F.filter(said, lambda x: x != "")
        words = F.filter(F.split(F.array_join(said, " "), r"[^\p{L}]+"), lambda w: F.length(w) >= 7)
        text = truncate_bytes(F.coalesce(F.try_element_at(said, F.lit(1)), F.lit("")), 400)
        lists = {
            "key_points": F.transform(first_n(said, 3), lambda x: truncate_bytes(x, 200)), "tags": first_n(distinct_strings(words), 5), "terms": first_n(distinct_strings(words), 8),
            "dominant_emotions": first_n(distinct_strings(words), 3), "themes": first_n(distinct_strings(words), 4),
            **{c: F.array().cast("array<string>") for c in ("remembered_emotions", "present_emotions", "emotional_tensions", "symbols_or_metaphors", "tone_markers")},
        }
        answer = F.struct(
            text.alias("summary"), text.alias("emotional_summary"), F.lit("").alias("relational_shift"), F.lit("").alias("emotional_arc"), F.lit("").alias("resonance_notes"),
            F.array().cast("array<int>").alias("breakpoints"), *(F.coalesce(v, F.array().cast("array<string>")).alias(k) for k, v in lists.items()),
        )
        return requests.select("request_id", F.to_json(answer).alias("response"), F.lit(None).cast("string").alias("error"))


class TableProvider:
    """Answers that a table (request_id, response) already holds."""

    def __init__(self, answers: DataFrame):
        self.answers = answers

    def complete(self, requests: DataFrame) -> DataFrame:
        found = requests.select("request_id").join(self.answers.select("request_id", "response"), "request_id", "left")
        return found.select("request_id", "response", F.when(F.col("response").isNull(), F.lit("no answer")).alias("error"))


class CallableProvider:
    """call(instructions, prompt) -> text on the executors, with retries; ``tasks`` times ``calls`` bounds the calls at a time."""

    def __init__(self, call: Callable[[str, str], str], tasks: int = 6, waits: tuple = (RATE_LIMIT_WAITS, SERVER_WAITS), sleep: Callable[[float], None] = time.sleep, calls: int = 1, strict: bool = False):
        self.call, self.tasks, self.waits, self.sleep, self.calls, self.strict = call, tasks, waits, sleep, calls, strict

    def complete(self, requests: DataFrame) -> DataFrame:
        call, how = self.call, (self.calls, self.waits, self.sleep, self.strict)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            return _answers(batches, lambda r: call(r.instructions, r.prompt), *how)

        return requests.select("request_id", "instructions", "prompt").repartition(self.tasks).mapInPandas(run, ANSWER)


class HttpProvider:
    """A service that takes a JSON request by POST: instructions, input, the answer's schema, and a limit of tokens.

    The key is read on the executors, from the environment variable that ``key_env`` names; it is no part
    of the plan. Each of ``tasks`` has up to ``calls`` under way.
    """

    def __init__(self, url: str, model: str, key_env: str = "MODEL_API_KEY", tasks: int = 6, timeout: float = 300, waits: tuple = (RATE_LIMIT_WAITS, SERVER_WAITS), sleep: Callable[[float], None] = time.sleep, calls: int = 1, strict: bool = False):
        self.url, self.model, self.key_env, self.tasks, self.timeout, self.waits, self.sleep, self.calls, self.strict = url, model, key_env, tasks, timeout, waits, sleep, calls, strict

    def complete(self, requests: DataFrame) -> DataFrame:
        url, model, key_env, timeout, how = self.url, self.model, self.key_env, self.timeout, (self.calls, self.waits, self.sleep, self.strict)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            return _answers(batches, lambda r: post(url, request_body(model, r.instructions, r.prompt, r.schema, int(r.max_tokens)), os.environ.get(key_env, ""), timeout), *how)

        return requests.select("request_id", "instructions", "prompt", "schema", "max_tokens").repartition(self.tasks).mapInPandas(run, ANSWER)


def _answers(batches: Iterator[pd.DataFrame], call: Callable, calls: int, waits: tuple, sleep: Callable[[float], None], strict: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = scheduled([partial(call, r) for r in batch.itertuples()], calls, waits, sleep, strict)
        yield pd.DataFrame({"request_id": batch["request_id"], "response": [a for a, _ in found], "error": [e for _, e in found]})


def request_body(model: str, instructions: str, prompt: str, schema: str, max_tokens: int) -> dict:
    body = {"model": model, "instructions": instructions, "input": prompt}
    if max_tokens > 0:
        body["max_output_tokens"] = max_tokens
    if schema:
        body["text"] = {"format": {"type": "json_schema", "name": "answer", "strict": True, "schema": json.loads(schema)}}
    return body


def post(url: str, body: dict, key: str, timeout: float) -> str:
    """The text of the service's answer; its status and reason as an error otherwise."""
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    try:
        with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), head), timeout=timeout) as r:
            return answer_text(json.load(r))
    except urllib.error.HTTPError as e:
        raise RuntimeError(f"HTTP {e.code} {e.reason}: {e.read(500).decode('utf-8', 'replace')}") from None


def answer_text(answer: dict) -> str:
    """All text parts of an answer, in order."""
    if "output_text" in answer:
        return answer["output_text"]
    return "".join(part.get("text", "") for item in answer.get("output", ()) for part in item.get("content") or ())


def scheduled(calls: list[Callable[[], str]], at_once: int, waits: tuple, sleep: Callable[[float], None] = time.sleep, strict: bool = False) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each call, in their order, with so many under way at a time and up to three tries of each.

    A call that met a rate limit or a server's error waits in a queue by the time it is due, and holds up no
    other; other errors end it at once. strict: the first error ends all that haven't begun.
    """
    found: list[tuple[str | None, str | None]] = [(None, "cancelled")] * len(calls)
    due, ahead = [(0.0, i, 0) for i in range(len(calls))], 0.0  # ahead: of the clock, where sleep returned early
    now = lambda: time.monotonic() + ahead
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        running: dict = {}
        while due or running:
            while due and due[0][0] <= now() and len(running) < max(1, at_once):
                _, i, tries = heapq.heappop(due)
                running[pool.submit(calls[i])] = i, tries
            rest = due[0][0] - now() if due else None
            if not running:
                began = time.monotonic()
                sleep(max(0.0, rest))
                ahead += max(0.0, rest - (time.monotonic() - began))
                continue
            for f in wait(running, max(0.0, rest) if due and len(running) < at_once else None, FIRST_COMPLETED).done:
                i, tries = running.pop(f)
                if f.exception() is None:
                    found[i] = f.result(), None
                    continue
                error = str(f.exception()) or type(f.exception()).__name__  # it becomes a column, the row isn't lost
                kind = jsonx.error_kind(error)
                if kind in ("rate_limit", "server") and tries < len(waits[0]):
                    heapq.heappush(due, (now() + waits[kind == "server"][tries], i, tries + 1))
                else:
                    found[i] = None, error
                    if strict:
                        due.clear()
    return found


def ask(provider: Provider, prompts: DataFrame, keys: list[str], payload: str, instructions: str, max_tokens: int = 0) -> DataFrame:
    """keys, the decoded payload's columns, and status: 'ok' or why there is no payload. Answers are written before they are read."""
    closed = json.dumps(response_schema(payload))
    rows = prompts.withColumns({"request_id": F.sha2(F.to_json(F.struct(*keys)), 256), "instructions": F.lit(instructions), "schema": F.lit(closed), "max_tokens": F.lit(max_tokens)})
    rows = stored(rows.select("request_id", *keys, "instructions", "prompt", "schema", "max_tokens"), "requests")
    answers = stored(provider.complete(rows.drop(*keys)), "answers")
    both = rows.select("request_id", *keys).join(answers, "request_id")
    status = F.when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.col("error"))).otherwise(jsonx.decode_status(F.col("response")))
    schema = T.StructType.fromDDL(payload)
    return both.withColumns({"status": status, "_p": jsonx.decode(F.col("response"), schema)}).select(*keys, *(F.col("_p")[c].alias(c) for c in schema.fieldNames()), "status")


def ask_with_fallback(provider: Provider, first: DataFrame, second: DataFrame, keys: list[str], payload: str, instructions: str | tuple[str, str], max_tokens: tuple[int, int] = (0, 0), again: Column | None = None) -> DataFrame:
    """As ask; rows that fail, or those of them that again says, are asked again with the prompts of second, and its instructions if there are two. The last status holds."""
    words = (instructions, instructions) if isinstance(instructions, str) else instructions
    tried = ask(provider, first, keys, payload, words[0], max_tokens[0])
    failed = tried.filter("status != 'ok'") if again is None else tried.filter((F.col("status") != "ok") & again)
    more = ask(provider, second.join(failed.select(*keys), keys, "left_semi"), keys, payload, words[1], max_tokens[1])
    return tried.join(failed.select(*keys), keys, "left_anti").unionByName(more)


def recoverable() -> Column:
    """Whether an answer was there, but cut off or no JSON: more room may help. Errors of calls have had their tries."""
    return F.col("status").isin("truncated", "invalid", "empty")
