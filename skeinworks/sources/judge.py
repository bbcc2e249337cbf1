"""External models behind one interface, with a deterministic stand-in that needs no network."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from skeinworks import runtime
from skeinworks.functions.ladder import ladder


class Judge(Protocol):
    """Answers a prompt with text; voices tells repeated calls for one prompt apart."""

    def answer(self, prompt: str, voice: int) -> str: ...


class StubJudge:
    """Votes by a hash of prompt and voice: the same answer everywhere and always."""

    def __init__(self, yes: float = 0.6):
        self.yes = yes

    def answer(self, prompt: str, voice: int) -> str:
        h = hashlib.blake2b(f"{voice}\x1f{prompt}".encode(), digest_size=8).digest()
        u, v = int.from_bytes(h[:4], "little") / 2**32, int.from_bytes(h[4:], "little") / 2**32
        return json.dumps({"allow": u < self.yes, "confidence": round(v, 6), "reason": ""})


def votes(prompts: DataFrame, make: Callable[[], Judge], voices: int = 3, retries: int = 1) -> DataFrame:
    """id, voice, allow, confidence, mode, error: every voice's answer to every prompt (id, prompt).

    One judge is made for each Python worker. An answer that no rung of the recovery ladder reads is asked for
    again, and then reported by its error.
    """
    runtime.ship_package(prompts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = make()
        for b in batches:
            rows = []
            for i, prompt in zip(b["id"], b["prompt"]):
                for voice in range(voices):
                    mode, got, error = "none", {}, None
                    for attempt in range(retries + 1):
                        try:
                            mode, got = ladder(judge.answer(prompt, voice + attempt * voices))
                            error = None if got else "unreadable"
                        except Exception as e:  # a call that fails is a row with an error, not a failed job
                            error = type(e).__name__
                        if got:
                            break
                    rows.append((i, voice, bool(got.get("allow")) if got else None, float(got.get("confidence") or 0.0) if got else None, mode, error))
            yield pd.DataFrame(rows, columns=["id", "voice", "allow", "confidence", "mode", "error"])

    kind = prompts.schema["id"].dataType.simpleString()
    return prompts.select("id", "prompt").mapInPandas(run, f"id {kind}, voice int, allow boolean, confidence double, mode string, error string")
