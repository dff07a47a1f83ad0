"""Calls to models over HTTP: one POST a prompt, errors as ``CallFailed`` with what a retry needs to know."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable

from consolida.sources.model_calls import Answer, CallFailed, answer_of, request


def caller(models: dict[str, dict], timeout: float = 150.0) -> Callable[[str, str], Answer]:
    """A call for ``with_replies``; ``models`` by key, with model_id, url, key_variable, and any of temperature, reasoning, seed, max_tokens, headers.

    The key is read where the call is made, from the environment of that task.
    """
    by_id = {m["model_id"]: m for m in models.values()}

    def call(model_id: str, prompt: str) -> Answer:
        model = by_id[model_id]
        options = {k: model[k] for k in ("temperature", "reasoning", "seed", "max_tokens") if k in model}
        headers = {"Content-Type": "application/json", **model.get("headers", {})}
        if model.get("key_variable"):
            headers["Authorization"] = f"Bearer {os.environ.get(model['key_variable'], '')}"
        body = json.dumps(request(prompt, model_id, **options)).encode()
        try:
            with urllib.request.urlopen(urllib.request.Request(model["url"], body, headers), timeout=timeout) as reply:
                return answer_of(json.loads(reply.read()))
        except urllib.error.HTTPError as refused:
            asked = refused.headers.get("Retry-After", "")
            raise CallFailed(refused.code, float(asked) if asked.replace(".", "", 1).isdigit() else None) from refused
        except (urllib.error.URLError, TimeoutError, ConnectionError, json.JSONDecodeError) as lost:
            raise CallFailed(None) from lost

    return call
