"""Chat calls over HTTP: what is sent, as columns, and a client for operators.external that sends it.

A client is made in each task, keeps one connection open, and turns every fault into a CallError with its
status, the server's wish to wait and whether the prompt was too long.
"""

from __future__ import annotations

import http.client
import json
import os
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import OVERFLOW_MARKERS
from .external import CallError

#: Headers of every call; the key is added where the call is made and never stands in a table.
HEADERS = {"Content-Type": "application/json", "Accept": "application/json", "User-Agent": "fitloom/1.0"}


def request(prompt: Column, model: str, settings: dict) -> Column:
    """Struct of the headers (without the key) and the JSON body of a call with this prompt."""
    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    body = F.struct(F.lit(model).alias("model"), F.array(message).alias("messages"), *(F.lit(v).alias(k) for k, v in settings.items()))
    return F.struct(F.struct(*(F.lit(v).alias(k) for k, v in HEADERS.items())).alias("headers"), F.to_json(body).alias("body"))


def retry_after(headers: dict[str, str]) -> float | None:
    """Seconds that the server asks to wait, from either of two headers; names in lower case."""
    for name in ("retry-after", "x-ratelimit-reset-after"):
        try:
            return max(0.0, float(headers[name]))
        except (KeyError, ValueError):
            continue
    return None


class Client:
    """complete(prompt, settings) against a chat endpoint; the key comes from the environment of the task."""

    def __init__(self, url: str, model: str, key_name: str = "MODEL_API_KEY", timeout: float = 60):
        self.at, self.model, self.timeout = urlsplit(url), model, timeout
        key = os.environ.get(key_name, "")
        self.headers = HEADERS | ({"Authorization": f"Bearer {key}"} if key else {})
        self.line: http.client.HTTPConnection | None = None

    def complete(self, prompt: str, settings: dict) -> str:
        body = json.dumps({"model": self.model, "messages": [{"role": "user", "content": prompt}], **settings}, ensure_ascii=False).encode()
        try:
            if self.line is None:
                kind = http.client.HTTPSConnection if self.at.scheme == "https" else http.client.HTTPConnection
                self.line = kind(self.at.netloc, timeout=self.timeout)
            self.line.request("POST", self.at.path or "/", body, self.headers)
            answer = self.line.getresponse()
            text, headers = answer.read().decode("utf-8", "replace"), {k.lower(): v for k, v in answer.getheaders()}
        except (OSError, http.client.HTTPException) as e:
            self.line = None  # opened anew by the next call
            raise CallError(str(e) or type(e).__name__) from e
        if answer.status != 200:
            low = text.lower()
            raise CallError(" ".join(text.split())[:500] or f"HTTP {answer.status}", answer.status, retry_after(headers), any(m in low for m in OVERFLOW_MARKERS))
        try:
            return json.loads(text)["choices"][0]["message"]["content"]
        except (ValueError, LookupError, TypeError) as e:
            raise CallError("the answer has no text", answer.status) from e
