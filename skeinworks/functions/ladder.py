"""Recovery of JSON objects from raw text, rung by rung, with the rung as a column."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("problem", "level", "type", "solution")
SCHEMA = "mode string, problem string, level string, type string, solution string"
_fence = re.compile(r"```(?:json)?\s*(.*?)```", re.S | re.I)
_think = re.compile(r"<(think|analysis)>.*?</\1>", re.S | re.I)
_escape = re.compile(r'\\(?:(["\\/])|u([0-9a-fA-F]{4})|([nrtbf])(?![A-Za-z]))')
_CONTROL = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


def decode_escaped(text: str) -> str:
    r"""Escapes undone and the result trimmed; \n and its kin stay before a letter, which keeps \nu and \theta."""
    return _escape.sub(lambda m: m[1] or (chr(int(m[2], 16)) if m[2] else _CONTROL[m[3]]), text).strip()


def balanced_objects(text: str) -> list[str]:
    """All outermost {...} of a text; braces within strings do not count."""
    out, depth, start, quoted, skip = [], 0, 0, False, False
    for i, c in enumerate(text):
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"' and depth:
            quoted = True
        elif c == "{":
            start = i if not depth else start
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                out.append(text[start : i + 1])
    return out


def _load(text: str) -> dict | None:
    try:
        got = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def ladder(text: str | None) -> tuple[str, dict]:
    """mode and object: direct, fenced, blob (the last that parses), fields, or none."""
    if not text or not text.strip():
        return "empty", {}
    clean = _think.sub("", text).strip()
    if (got := _load(clean)) is not None:
        return "direct", got
    for body in _fence.findall(clean):
        if (got := _load(body.strip())) is not None:
            return "fenced", got
    for blob in reversed(balanced_objects(clean)):
        if (got := _load(blob)) is not None:
            return "blob", got
    fields = {}
    for f in FIELDS:
        m = re.search(rf'"{f}"\s*:\s*"((?:[^"\\]|\\.)*)"', clean)
        if m:
            fields[f] = decode_escaped(m[1])
    return ("fields", fields) if fields else ("none", {})


def _text(v) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def parse_ladder(column: str) -> Column:
    """A struct of mode and the four fields, by an Arrow-batched function."""

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [ladder(t if isinstance(t, str) else None) for t in s]
            yield pd.DataFrame({"mode": [m for m, _ in rows]} | {f: [_text(o.get(f)) for _, o in rows] for f in FIELDS})

    return run(F.col(column))
