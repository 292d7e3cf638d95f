"""A provider that asks a chat-completions endpoint over HTTP."""

from __future__ import annotations

import json
import urllib.request
from dataclasses import dataclass

from ..operators.generate import Reply


@dataclass(frozen=True)
class Endpoint:
    """Callable as a provider. Failures raise; `respond` retries them and keeps the last as the row's error."""

    base_url: str
    api_key: str = ""
    model: str = "gpt-4o-mini"
    temperature: float = 0.85
    top_p: float = 0.95
    max_tokens: int = 2048
    frequency_penalty: float = 0.3
    timeout: float = 60.0

    def __call__(self, system: str, user: str, expected: str) -> Reply:
        body = {
            "model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], "temperature": self.temperature,
            "top_p": self.top_p, "max_tokens": self.max_tokens, "frequency_penalty": self.frequency_penalty,
        }
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"}
        request = urllib.request.Request(f"{self.base_url.rstrip('/')}/chat/completions", json.dumps(body).encode(), headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            data = json.load(answer)
        used = data.get("usage") or {}
        return Reply(data["choices"][0]["message"]["content"] or "", used.get("prompt_tokens", 0), used.get("completion_tokens", 0), data.get("model", self.model))


def from_config(generation: dict):
    """The offline provider for a dry run or without a key, else the endpoint."""
    from ..operators.generate import offline

    if generation.get("dry_run") or not generation.get("api_key"):
        return offline
    names = ("model", "temperature", "top_p", "max_tokens", "frequency_penalty", "timeout")
    return Endpoint(generation["base_url"], generation["api_key"], **{k: generation[k] for k in names if k in generation})
