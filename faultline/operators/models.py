"""Model inference: the declared model, its providers, and the job that calls them."""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.clock import row_clock
from faultline.operators.joins import lookup
from faultline.schemas import GUARD

Call = Callable[[list[str]], list]


@dataclass(frozen=True)
class ModelSpec:
    """Declared input and output of a model and how to open a client for it.

    ``open_client(spec)`` runs on the executor, once per task, and returns a function from a list of
    inputs to the list of outputs in the same order. ``key_env`` names the environment variable
    holding the key; the key itself is read on the executor and is in no plan and in no file.
    """

    name: str
    output: str
    open_client: Callable[["ModelSpec"], Call]
    endpoint: str | None = None
    key_env: str | None = None
    system_prompt: str | None = None
    timeout_s: float = 180.0
    attempts: int = 4
    backoff_s: float = 0.5
    options: dict = field(default_factory=dict)

    def key(self) -> str | None:
        return os.environ.get(self.key_env) if self.key_env else None

    def fingerprint(self, dim: int) -> str:
        return f"{self.name}@{dim}"


def call_with_retry(call: Call, chunk: list[str], spec: ModelSpec) -> list[tuple]:
    """(output, error) per input. After the last attempt: NULL and the reason, never an exception. A chunk that fails is
    asked again input by input, so that one bad text does not take its neighbours along."""
    error = None
    for attempt in range(spec.attempts):
        try:
            replies = call(chunk)
            if len(replies) != len(chunk):
                raise ValueError(f"{len(replies)} replies for {len(chunk)} inputs")
            return [(reply, None) for reply in replies]
        except Exception as raised:  # noqa: BLE001 - any failure of a remote call
            error = f"{type(raised).__name__}: {raised}"
            if attempt + 1 < spec.attempts:
                time.sleep(spec.backoff_s * 2 ** attempt)
    if len(chunk) > 1:
        return [call_with_retry(call, [text], spec)[0] for text in chunk]
    return [(None, error)]


def predict(column: Column, spec: ModelSpec, max_in_flight: int, batch_size: int) -> Column:
    """struct<output, error> of one text column. Only that column travels to Python."""
    returns = T.StructType.fromDDL(f"output {spec.output}, error STRING")

    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        call = spec.open_client(spec)
        with ThreadPoolExecutor(max_in_flight) as pool:
            for texts in batches:
                asked = [t for t in texts if t is not None]
                chunks = [asked[i:i + batch_size] for i in range(0, len(asked), batch_size)]
                replies = [r for done in pool.map(lambda c: call_with_retry(call, c, spec), chunks) for r in done]
                answers = iter(replies)
                rows = [next(answers) if t is not None else (None, None) for t in texts]
                yield pd.DataFrame({"output": [r[0] for r in rows], "error": [r[1] for r in rows]}, dtype=object)

    # a call costs money and may differ next time: the optimizer must neither repeat nor move it
    return F.pandas_udf(infer, returnType=returns).asNondeterministic()(column)


def ml_predict(df: DataFrame, model: ModelSpec, col: str, out: str | None = None,
               max_in_flight: int = 4, batch_size: int = 100, stamp: str | None = None,
               error: str | None = None, partitions: int | None = None,
               distinct: bool = False) -> DataFrame:
    """Every input column plus the model's output ``out``; one call per row, NULL in, NULL out.

    ``partitions`` spreads the calls, each partition keeping at most ``max_in_flight`` open;
    ``distinct`` calls once per distinct text and looks the answer up;
    ``stamp`` adds the wall clock as the row leaves; ``error`` the reason of a failed call.
    """
    out = out or "output"
    asked = df.select(col).where(F.col(col).isNotNull()).distinct() if distinct else df
    if partitions:
        asked = asked.repartition(partitions)
    done = asked.withColumn("__reply", predict(F.col(col), model, max_in_flight, batch_size))
    done = done.withColumn(out, F.col("__reply.output"))
    if error:
        done = done.withColumn(error, F.col("__reply.error"))
    done = done.drop("__reply")
    if distinct:
        done = lookup(df, done, col, "left")
        done = done.select(*df.columns, out, *([error] if error else []))
    if stamp:
        done = done.withColumn(stamp, row_clock())
    return done


# Instruction for a planning model. The six field names and the guard text are fixed values: the parsed
# reply and the status log depend on them.
PLANNER_INSTRUCTION = (
    "You plan maintenance work. The user message holds one machine alarm with its readings and one section of the "
    "manual. Answer with one JSON object and nothing around it, with the fields diagnosis (string, one sentence), "
    "action (string, in the words of the manual), parts (array of the part numbers the section names), safety "
    "(string, any warning of the section, else none), estimated_minutes (integer) and line_stop_likely (boolean). "
    f"Rely on the section alone. When it does not fit the alarm, the diagnosis is \"{GUARD}\", parts is empty and no "
    "part number is invented."
)


# ---- providers -------------------------------------------------------------------------------

def precomputed(df: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Vectors that exist already, keyed; rows without one keep NULL."""
    return lookup(df, vectors, key, "left")


def letter_counts(spec: ModelSpec) -> Call:
    """Deterministic embedder for tests: how often each letter a-z occurs, case ignored."""
    def call(texts: list[str]) -> list:
        rows = []
        for text in texts:
            lowered = text.lower()
            rows.append(np.array([lowered.count(chr(97 + i)) for i in range(26)], dtype=np.float32))
        return rows
    return call


def quoting_planner(spec: ModelSpec) -> Call:
    """Deterministic planner for tests: names the section that the prompt carries."""
    section = re.compile(r"MANUAL SECTION (\S+) ")

    def call(prompts: list[str]) -> list:
        replies = []
        for prompt in prompts:
            named = section.search(prompt)
            replies.append(json.dumps({"diagnosis": f"see {named.group(1)}" if named else GUARD}))
        return replies
    return call


def hashing_embed(df: DataFrame, col: str, out: str, dim: int = 256) -> DataFrame:
    """Bag-of-words embedder that stays in the JVM: hashed term counts, length one."""
    from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern="\\W+")
    counts = HashingTF(inputCol="__words", outputCol="__counts", numFeatures=dim)
    unit = Normalizer(inputCol="__counts", outputCol="__unit")
    done = df.withColumn("__text", F.coalesce(F.col(col), F.lit("")))
    for step in (words, counts, unit):
        done = step.transform(done)
    vector = F.when(F.col(col).isNotNull(), vector_to_array("__unit", "float32"))
    return done.withColumn(out, vector).drop("__text", "__words", "__counts", "__unit")


def template_reply(grounded: Column, doc_ref: Column, queue: Column, severity: Column) -> Column:
    """Planner as a column: an action naming the section, or the guard when not grounded."""
    def reply(diagnosis, action, minutes, stop):
        return F.to_json(F.struct(
            diagnosis.alias("diagnosis"), action.alias("action"),
            F.array().cast("array<string>").alias("parts"), F.lit("none").alias("safety"),
            minutes.alias("estimated_minutes"), stop.alias("line_stop_likely")))
    refused = reply(F.lit(GUARD), F.lit("none"), F.lit(0), F.lit(False))
    planned = reply(F.concat(F.lit("see "), doc_ref), F.concat(F.lit("send "), queue),
                    (severity * 15).cast("int"), severity >= 4)
    return F.when(grounded, planned).otherwise(refused)


def http_transport(url: str, body: dict, key: str | None, timeout_s: float) -> dict:
    from urllib.request import Request, urlopen
    headers = {"Content-Type": "application/json"}
    if key:
        headers["Authorization"] = f"Bearer {key}"
    with urlopen(Request(url, json.dumps(body).encode(), headers), timeout=timeout_s) as reply:
        return json.load(reply)


def remote_embedder(spec: ModelSpec) -> Call:
    """Embeddings over the common HTTP wire format; one request per chunk."""
    send = spec.options.get("transport", http_transport)

    def call(texts: list[str]) -> list:
        reply = send(f"{spec.endpoint}/embeddings", {"model": spec.name, "input": texts}, spec.key(), spec.timeout_s)
        ordered = sorted(reply["data"], key=lambda item: item.get("index", 0))
        return [np.asarray(item["embedding"], dtype=np.float32) for item in ordered]
    return call


def remote_planner(spec: ModelSpec) -> Call:
    """Chat completions over the common HTTP wire format; one request per row (batch_size=1)."""
    send = spec.options.get("transport", http_transport)

    def one(prompt: str) -> str:
        messages = [{"role": "user", "content": prompt}]
        if spec.system_prompt:
            messages.insert(0, {"role": "system", "content": spec.system_prompt})
        reply = send(f"{spec.endpoint}/chat/completions", {"model": spec.name, "messages": messages},
                     spec.key(), spec.timeout_s)
        return reply["choices"][0]["message"]["content"]
    return lambda prompts: [one(p) for p in prompts]
