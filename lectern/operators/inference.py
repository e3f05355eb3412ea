"""Batched model inference over a prompt column (the library's UDF surface).

The model is an injected, picklable callable ``fn(prompt: str) -> str``.
It runs inside ``mapInArrow``: Arrow batches in, one response row out per
prompt, with retry, exponential back-off and a pause after each call.  Id columns
pass as they are and a few prompts at a time are Python strings.  The
number of partitions sets the total concurrency (``repartition(n)``), so a
global rate limit is ``n / min_interval`` calls per second.

Errors are data: a prompt that still fails after the last attempt yields
``response = NULL`` and ``error = <message>``; the job never aborts.
Responses are non-deterministic in general and expensive, so callers should
``cut_lineage`` (checkpoint) the result before it feeds more than one action.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Retry policy (attempts, back-off multiplier and cap in seconds,
# pause after each call in seconds).
TABLE_RETRIES = 4
TABLE_BACKOFF = 5.0
TABLE_BACKOFF_CAP = 40.0
REVIEW_RETRIES = 3
CALL_PAUSE = 1.0
# Rows of an Arrow batch that are answered before their answers leave the task.
SLICE_ROWS = 256


def backoff_wait(attempt: int, multiplier: float, cap: float | None) -> float:
    """Exponential wait before retry number ``attempt`` (1-based): m * 2**(attempt-1)."""
    w = multiplier * (2 ** (attempt - 1))
    return min(w, cap) if cap is not None else w


def call_with_retry(
    fn: Callable[[str], str],
    prompt: str,
    retries: int,
    multiplier: float,
    cap: float | None,
    pause: float,
    sleep: Callable[[float], None] = time.sleep,
) -> tuple[str | None, str | None, int]:
    """One prompt -> (response, error, attempts)."""
    last_err: str | None = None
    for attempt in range(1, retries + 1):
        try:
            out = fn(prompt)
            if pause > 0:
                sleep(pause)
            return (None if out is None else str(out)), None, attempt
        except Exception as exc:  # the model's failure becomes data
            last_err = f"{type(exc).__name__}: {exc}"
            if attempt < retries:
                w = backoff_wait(attempt, multiplier, cap)
                if w > 0:
                    sleep(w)
    return None, last_err, retries


def infer(
    df: DataFrame,
    prompt_col: str,
    fn: Callable[[str], str],
    id_cols: Sequence[str],
    retries: int = TABLE_RETRIES,
    multiplier: float = TABLE_BACKOFF,
    cap: float | None = TABLE_BACKOFF_CAP,
    pause: float = CALL_PAUSE,
    partitions: int | None = None,
) -> DataFrame:
    """``(id_cols..., prompt)`` -> ``(id_cols..., response, error, attempts)``.

    Only the id columns and the prompt cross into Python (column pruning
    happens before the opaque stage).  ``partitions`` hash-partitions the
    prompts by their ids over that many tasks (the number of concurrent
    calls); Spark cannot know that each row is an expensive call, and AQE
    would otherwise merge a small post-shuffle input into very few tasks.
    Hashing (not round-robin) keeps the placement stable when a task is
    retried.  By default the input layout is kept.
    """
    ids = list(id_cols)
    src = df.select(*ids, prompt_col)
    if partitions:
        src = src.repartition(partitions, *ids)
    id_fields = [src.schema[c] for c in ids]
    out_schema = T.StructType(
        id_fields
        + [
            T.StructField("response", T.StringType(), True),
            T.StructField("error", T.StringType(), True),
            T.StructField("attempts", T.IntegerType(), False),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(lo, SLICE_ROWS)
                res = [
                    call_with_retry(fn, p.as_py(), retries, multiplier, cap, pause)
                    if p.is_valid else (None, "no prompt", 0)
                    for p in batch.column(len(ids))
                ]
                answers = [pa.array([r[i] for r in res], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(ids)], *answers], names=out_schema.names)

    return src.mapInArrow(run, out_schema)


class EchoModel:
    """Deterministic offline model for tests and demos.

    It answers in prose around a JSON object built from the prompt, and fails
    on purpose for some prompts so that retries and error rows are exercised:
    prompts whose length is divisible by ``fail_every`` always fail; those
    divisible by ``flaky_every`` fail on the first call only (per process).
    The answer is ``Answer: {"n": <length>, "w": "<first word>"} Thanks.``
    where the first word is the prompt text before the first space.
    """

    def __init__(self, fail_every: int = 11, flaky_every: int = 7):
        self.fail_every = fail_every
        self.flaky_every = flaky_every
        self._seen: set[int] = set()

    def __call__(self, prompt: str) -> str:
        n = len(prompt)
        if self.fail_every and n % self.fail_every == 0:
            raise RuntimeError("model unavailable")
        if self.flaky_every and n % self.flaky_every == 0:
            h = hash(prompt)
            if h not in self._seen:
                self._seen.add(h)
                raise TimeoutError("transient")
        word = prompt.split(" ")[0].replace("\\", "").replace('"', "")
        return 'Answer: {"n": %d, "w": "%s"} Thanks.' % (n, word)


class RecordModel:
    """Deterministic offline model that answers the extraction requests.

    Head requests get a title (first five words of the text part), authors
    (the next words, comma-separated) and a year; part requests get a method
    (first word), a dataset list (second and third words) and a limitation
    (the last word); every other request gets a short text.  Prompts whose
    length is divisible by ``fail_every`` fail, to exercise error rows.
    """

    def __init__(self, fail_every: int = 13):
        self.fail_every = fail_every

    def __call__(self, prompt: str) -> str:
        import json

        if self.fail_every and len(prompt) % self.fail_every == 0:
            raise RuntimeError("model unavailable")
        if "Text: " in prompt and '"Paper Title"' in prompt:
            words = prompt.split("Text: ", 1)[1].split()
            obj = {
                "Paper Title": " ".join(words[:5]) or None,
                "Authors": ", ".join(words[5:5 + (len(words) % 6)]) or None,
                "Year of Publication": str(1990 + len(words) % 35),
            }
            return "Here is the JSON you asked for:\n" + json.dumps(obj) + "\nLet me know if you need more."
        if "Part: " in prompt:
            words = prompt.split("Part: ", 1)[1].split()
            obj = {
                "Meta-Learning Method Used": words[0] if words else None,
                "Dataset(s) Used": words[1:3],
                "Limitations": words[-1] if words else "Not explicitly mentioned",
            }
            return "```json\n" + json.dumps(obj) + "\n```"
        return "Summary of a record with " + str(len(prompt)) + " characters."
