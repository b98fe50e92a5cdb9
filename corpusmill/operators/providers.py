"""Models behind services, by name: what answers extraction prompts and what embeds. Clients are made in the tasks, by a function that
the caller gives, so that none is sent over and none is imported here."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from typing import Any
from urllib.request import Request, urlopen

import numpy as np

from .embedding import Provider

Client = Callable[[], Any]


def posting(url: str = "http://localhost:11434", timeout: float = 300) -> Callable[[str, dict], dict]:
    """A client for a local model server: posts JSON to a path and returns the JSON that comes back."""

    def post(path: str, payload: dict) -> dict:
        request = Request(f"{url}{path}", json.dumps(payload).encode(), {"Content-Type": "application/json"})
        with urlopen(request, timeout=timeout) as answer:
            return json.loads(answer.read())

    return post


def _turns(system: str, user: str) -> list[dict[str, str]]:
    return [{"role": "system", "content": system}, {"role": "user", "content": user}]


def _ollama(client: Any, model: str, system: str, user: str) -> str:
    options = {"temperature": 0, "num_ctx": 16_384}
    return client("/api/chat", {"model": model, "format": "json", "stream": False, "options": options, "messages": _turns(system, user)})["message"]["content"]


def _openai(client: Any, model: str, system: str, user: str) -> str:
    answer = client.chat.completions.create(model=model, temperature=0, response_format={"type": "json_object"}, messages=_turns(system, user))
    return answer.choices[0].message.content


def _anthropic(client: Any, model: str, system: str, user: str) -> str:
    return client.messages.create(model=model, max_tokens=8_000, system=system, messages=_turns(system, user)[1:]).content[0].text


ASK = {"ollama": _ollama, "openai": _openai, "anthropic": _anthropic}


@dataclass
class Extractor:
    """What `operators.requirements.extracted` asks: calls the named service with a system prompt and the file's name and text. The client is made
    at the first call in a process."""

    name: str
    model: str
    client: Client
    system: str
    made: list = field(default_factory=list, repr=False)

    def __post_init__(self) -> None:
        if self.name not in ASK:
            raise ValueError(f"no provider {self.name!r}: one of {', '.join(ASK)}")

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": []}

    def __call__(self, text: str, file_name: str) -> str:
        if not self.made:
            self.made.append(self.client())
        return ASK[self.name](self.made[0], self.model, self.system, f"File: {file_name}\n\n---\n{text}")


def _local(client: Any, model: str, dimension: int, texts: list[str]) -> np.ndarray:
    return np.asarray(client.encode(texts, normalize_embeddings=True), np.float32)


def _remote(client: Any, model: str, dimension: int, texts: list[str]) -> np.ndarray:
    """Vectors come back with the place of their text, in any order."""
    found = sorted(client.embeddings.create(model=model, input=texts, dimensions=dimension).data, key=lambda x: x.index)
    if len(found) != len(texts):
        raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
    return np.asarray([x.embedding for x in found], np.float32)


EMBED = {"local": _local, "openai": _remote}


def embedder(name: str, model: str, client: Client, dimension: int) -> Callable[[], Provider]:
    """What `operators.embedding` makes once a task: a function from texts to vectors of the named service."""
    if name not in EMBED:
        raise ValueError(f"no provider {name!r}: one of {', '.join(EMBED)}")
    return lambda: partial(EMBED[name], client(), model, dimension)
