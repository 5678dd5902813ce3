"""Prompts to responses of a model that answers in JSON. What sends a request is an argument; what comes back is
checked by expressions, and a prompt without an answer is a row with the reason."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigweave.sources.fetch import retry_after

# A request's settings, its seconds and attempts, the waits between them.
TEMPERATURE, MOST_TOKENS, TIMEOUT, ATTEMPTS, BACKOFF, JITTER, MOST_BACKOFF = 0.1, 1800, 60.0, 3, 0.5, 0.25, 8.0

_USAGE = "struct<prompt_tokens: string, completion_tokens: string, total_tokens: string>"
ENVELOPE = f"model string, choices array<struct<finish_reason: string, message: struct<content: string>>>, usage {_USAGE}"

#: The body of a request and seconds to status, retry-after and the body of the reply. Raises OSError.
Send = Callable[[str, float], tuple[int, str | None, str]]


def request(system: str, user: str, model: str, most: int = MOST_TOKENS, temperature: float = TEMPERATURE) -> str:
    said = [{"role": "system", "content": system}, {"role": "user", "content": user}]
    return json.dumps({"model": model, "messages": said, "response_format": {"type": "json_object"}, "temperature": temperature, "max_tokens": most, "stream": False}, ensure_ascii=False)


def asked(body: str, send: Send, attempts: int = ATTEMPTS, timeout: float = TIMEOUT, sleep=time.sleep, rand=random.random) -> tuple[int | None, str | None]:
    """Status and body of the last reply; nulls where the network gave none. 408, 429, 5xx and no reply are asked again."""
    status, text = None, None
    for n in range(1, attempts + 1):
        wait = min(MOST_BACKOFF, BACKOFF * 2 ** (n - 1) + rand() * JITTER)
        try:
            status, after, text = send(body, timeout)
        except OSError:
            status, after, text = None, None, None
        if status is not None and status not in (408, 429) and status < 500:
            break
        if n < attempts:
            named = retry_after(after, time.time())
            sleep(wait if named is None else named)
    return status, text


def replies(prompts: DataFrame, send: Callable[[], Send], model: str, system: str = "", sleep=time.sleep, **settings) -> DataFrame:
    """prompts (text, ...) with status and body of the reply. A task that is run again asks again: write this before use."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        way = send()
        for pdf in parts:
            got = [asked(request(system, t or "", model, **settings), way, sleep=sleep) for t in pdf["text"]]
            yield pdf.assign(status=pd.array([g[0] for g in got], dtype="Int32"), body=pd.Series([g[1] for g in got], index=pdf.index, dtype=object))

    return prompts.mapInPandas(run, T.StructType([*prompts.schema.fields, T.StructField("status", T.IntegerType()), T.StructField("body", T.StringType())]))


def answer(status: Column, body: Column, model: str) -> Column:
    """Struct of response (JSON text, null without one), error (null with one), model and tokens."""
    env = F.from_json(body, ENVELOPE)
    first, usage = F.try_element_at(env["choices"], F.lit(1)), env["usage"]
    content = first["message"]["content"]
    count = lambda n: F.coalesce(usage[n].try_cast("long"), F.lit(0).cast("long"))
    odd = [F.coalesce(~usage[n].rlike(r"^\d+$"), F.lit(False)) for n in ("prompt_tokens", "completion_tokens", "total_tokens")]
    broken = content.isNull() | odd[0] | odd[1] | odd[2]
    failed = F.get_json_object(body, "$.error.code"), F.get_json_object(body, "$.error.type"), F.concat(F.lit("http_"), status.cast("string"))
    why = F.when(status.isNull(), F.lit("network_error")).when(~status.between(200, 299), F.coalesce(F.substring(failed[0], 1, 80), F.substring(failed[1], 1, 80), failed[2]))
    why = why.when(broken, F.lit("invalid_response")).when(first["finish_reason"] == "length", F.lit("truncated_response")).when(F.try_parse_json(content).isNull(), F.lit("invalid_json"))
    fine = why.isNull()
    tokens = lambda c: F.when(fine, c).otherwise(F.lit(0).cast("long"))
    total = F.coalesce(usage["total_tokens"].try_cast("long"), count("prompt_tokens") + count("completion_tokens"))
    return F.struct(
        F.when(fine, content).alias("response"), why.alias("error"), F.coalesce(env["model"], F.lit(model)).alias("model"),
        tokens(count("prompt_tokens")).alias("prompt_tokens"), tokens(count("completion_tokens")).alias("completion_tokens"), tokens(total).alias("total_tokens"),
    )


def usage(answers: DataFrame) -> DataFrame:
    """model, asked, answered and the tokens in all of rows of answer()'s fields."""
    sums = [F.sum(c).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]
    return answers.groupBy("model").agg(F.count("*").alias("asked"), F.count("response").alias("answered"), *sums)
