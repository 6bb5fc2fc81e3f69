"""Calls of a language model over prompts, by a client that can be swapped."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from talus.operators.gate import Cancelled, Door, Unauthorized, Unreachable
from talus.sources.shared import ship

# Repeats of a failed call, longest wait and time limit of a call in seconds, and what calls of a local model ask for.
REPEATS, LONGEST_WAIT, TIME_LIMIT = 10, 60, 300
LOCAL = {"max_tokens": 8192, "temperature": 0.0, "top_p": 1.0, "top_k": 30, "chat_template_kwargs": {"enable_thinking": False}}
#: Most bytes of prompts that a Python worker is handed at once.
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class ClientConfig:
    """Where calls go. There is no default endpoint. provider: 'local' or 'router' ('openrouter' is another name for that)."""

    endpoint: str
    model: str
    authorization: str = ""
    provider: str = "local"
    time_limit: float = TIME_LIMIT
    repeats: int = REPEATS

    def __post_init__(self):
        if not self.endpoint or not self.model:
            raise ValueError("endpoint and model must be given")
        if provider(self.provider) is None:
            raise ValueError(f"unknown provider {self.provider!r}")


def provider(name: str) -> str | None:
    return {"local": "local", "router": "router", "openrouter": "router"}.get((name or "local").strip().lower())


def stub(prompt: str) -> str:
    """Answers without a model: no field is supported."""
    return '{"fields": []}'


class HttpClient:
    """Chat completions over HTTP, with waits of 1, 2, 4 ... seconds or as the endpoint asks. Behind a door, each attempt asks for its turn."""

    door: Door | None = None

    def __init__(self, config: ClientConfig, post: Callable | None = None, sleep: Callable[[float], None] = time.sleep):
        self.config, self.post, self.sleep, self.cancelled = config, post or self._post, sleep, False

    def _post(self, body: bytes) -> tuple[int, dict, bytes]:
        head = {"Content-Type": "application/json"} | ({"Authorization": self.config.authorization} if self.config.authorization else {})
        request = urllib.request.Request(self.config.endpoint, body, head)
        try:
            with urllib.request.urlopen(request, timeout=self.config.time_limit) as answer:
                return answer.status, dict(answer.headers), answer.read()
        except urllib.error.HTTPError as error:
            return error.code, dict(error.headers), error.read()

    def chat(self, messages: list[dict]) -> dict:
        body = {"model": self.config.model, "messages": messages}
        body |= LOCAL if provider(self.config.provider) == "local" else {"reasoning": {"enabled": True}}
        problem = ""
        for attempt in range(self.config.repeats + 1):
            if self.cancelled:
                raise Cancelled("another call was refused")
            if self.door:
                self.door.enter()
            wait = min(LONGEST_WAIT, 2**attempt)
            try:
                status, head, answer = self.post(json.dumps(body).encode())
                if status == 401:
                    self.cancelled = True
                    raise Unauthorized("the endpoint refuses the credentials")
                if status < 400:
                    return json.loads(answer)["choices"][0]["message"]
                problem = f"status {status}"
                asked = next((v for k, v in head.items() if k.lower() == "retry-after"), None)
                if asked is not None and str(asked).replace(".", "", 1).isdigit():
                    wait = min(LONGEST_WAIT, float(asked))
            except (OSError, KeyError, IndexError, ValueError) as error:
                problem = repr(error)
            if attempt < self.config.repeats:
                self.sleep(wait)
        raise RuntimeError(f"no answer after {self.config.repeats + 1} attempts: {problem}")

    def __call__(self, prompt: str) -> str:
        return self.chat([{"role": "user", "content": prompt}]).get("content") or ""

    def follow_up(self, prompt: str, answer: dict, question: str) -> dict:
        """A second turn that hands the first answer back, reasoning included."""
        return self.chat([
            {"role": "user", "content": prompt}, {"role": "assistant", **{k: v for k, v in answer.items() if k != "role"}},
            {"role": "user", "content": question}
        ])


def call_model(prompts: DataFrame, make_client: Callable[[], Callable[[str], str]] = lambda: stub, threads: int = 1, tasks: int | None = None, door: Door | None = None) -> DataFrame:
    """user_id, chunk, response and error: one call for each prompt. A failed call has an error and a null response; refused credentials fail the job.

    tasks bounds the calls at a time to tasks * threads. door: of the Gate in whose context the result is written; it holds all tasks' calls to
    one rate, and a refusal in one task stops the others before their next call. The session's limit on the bytes of Arrow batches is set to BATCH_BYTES, since
    thousands of prompts, the default number of rows, may be hundreds of megabytes.
    """
    ship(prompts.sparkSession)
    prompts.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        every = hasattr(client, "door")  # such a client asks before each attempt, others before each prompt
        if every:
            client.door = door

        def one(prompt: str) -> tuple[str | None, str | None]:
            if door and not every:
                door.enter()
            try:
                return client(prompt), None
            except Unauthorized as refusal:
                if door:
                    door.refuse(str(refusal))
                raise
            except (Cancelled, Unreachable):
                raise
            except Exception as error:  # one chunk's failure stays its own
                return None, repr(error)

        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                answers = list(pool.map(one, frame["prompt"]))
                yield pd.DataFrame({
                    "user_id": frame["user_id"], "chunk": frame["chunk"], "response": [a for a, _ in answers], "error": [e for _, e in answers]
                })

    kind = prompts.schema["user_id"].dataType.simpleString()
    dealt = prompts.repartition(tasks) if tasks else prompts
    return dealt.select("user_id", "chunk", "prompt").mapInPandas(
        of, f"user_id {kind}, chunk {prompts.schema['chunk'].dataType.simpleString()}, response string, error string"
    )
