"""Remote services over HTTP: a chat completion endpoint and a search endpoint. Both pickle, so tasks can call them."""

from __future__ import annotations

import json
import os
import urllib.request
from dataclasses import dataclass, field


def _post(url: str, body: dict, key: str | None, seconds: float) -> dict:
    headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), headers), timeout=seconds) as r:
        return json.load(r)


@dataclass(frozen=True)
class Reply:
    text: str
    model: str
    usage: dict[str, int] = field(default_factory=dict)
    attempts: int = 1


@dataclass(frozen=True)
class RemoteModel:
    """``complete(system, user, json_mode)`` at a chat completion endpoint. The key is read from CASELOOM_LLM_KEY where the call is made."""

    url: str
    model: str
    max_tokens: int = 800
    seconds: float = 60.0

    def complete(self, system: str, user: str, json_mode: bool = False) -> Reply:
        body = {
            "model": self.model, "temperature": 0, "max_tokens": self.max_tokens,
            "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}],
        } | ({"response_format": {"type": "json_object"}} if json_mode else {})
        got = _post(self.url, body, os.environ.get("CASELOOM_LLM_KEY"), self.seconds)
        used = got.get("usage") or {}
        return Reply(got["choices"][0]["message"]["content"] or "", self.model, {k: int(used.get(k) or 0) for k in ("prompt_tokens", "completion_tokens")})

    def __call__(self, instruction: str, message: str) -> str:
        return self.complete(instruction, message, json_mode=True).text


@dataclass(frozen=True)
class RemoteSearch:
    """``search(question, k)`` -> (id, score) pairs at a search endpoint."""

    url: str
    seconds: float = 30.0

    def __call__(self, question: str, k: int) -> list[tuple[str, float]]:
        got = _post(self.url, {"search": question, "top": k}, os.environ.get("CASELOOM_SEARCH_KEY"), self.seconds)
        return [(r["id"], float(r["score"])) for r in got["value"]]
