"""Models behind an interface: chat and embedding providers, with offline ones that need no network.

A request carries both a prompt for a model and the same facts as data, which the offline provider works from. All
providers are plain objects that can be sent to the executors.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import urllib.request
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np


@dataclass(frozen=True)
class Request:
    """``kind``: slice, topics, assign, facts, question or questions."""

    kind: str
    system: str
    prompt: str
    data: dict = field(default_factory=dict)
    temperature: float = 0.7
    max_tokens: int = 1000


class ChatProvider(Protocol):
    def complete(self, request: Request) -> str: ...


def sentences(text: str) -> list[str]:
    return [s.strip() for s in re.split(r"(?<=[.!?])\s+|\n+", text) if s.strip()]


def _number(*parts) -> int:
    return int.from_bytes(hashlib.sha256("\x1f".join(map(str, parts)).encode()).digest()[:8], "big")


class OfflineChat:
    """Picks sentences and fills templates; the same request always gets the same answer."""

    def complete(self, request: Request) -> str:
        return json.dumps(getattr(self, f"_{request.kind}")(request.data), ensure_ascii=False)

    def _slice(self, data: dict) -> dict:
        parts, size = [], max(1, -(-len(data["text"]) // 6))
        held = ""
        for s in sentences(data["text"]):
            held = f"{held} {s}".strip()
            if len(held) >= max(size, 300):
                parts.append(held)
                held = ""
        if held:
            parts.append(held)
        return {"segments": [{"title": " ".join(p.split()[:6]), "content": p} for p in parts]}

    def _topics(self, data: dict) -> dict:
        topics: dict[str, list[str]] = {}
        for s in data["segments"]:
            topics.setdefault((s["title"].split() or ["General"])[0], []).append(s["id"])
        return {"document_title": data["source"], "topics": [{"topic": t, "segment_ids": ids, "subtopics": []} for t, ids in topics.items()]}

    def _assign(self, data: dict) -> dict:
        topics = data["topics"]
        return {"assignments": [{"segment_id": s["id"], "topic": topics[_number(s["id"]) % len(topics)], "subtopic": None} for s in data["segments"]] if topics else []}

    def _facts(self, data: dict) -> list:
        found = [s for s in sentences("\n".join(data["contexts"])) if len(s.split()) >= 4] or sentences("\n".join(data["contexts"]))
        avoid = set(data.get("avoid", []))
        found = [s for s in found if s not in avoid] or found
        start = _number(*data["key"]) % max(1, len(found))
        return [{"extracted_fact": s} for s in (found[start:] + found[:start])[: data["n"]]]

    def _one(self, fact: str, kind: str, difficulty: str, true: bool | None) -> dict:
        words = fact.split()
        about = " ".join(words[: max(4, len(words) // 2)])
        if kind == "true-false":
            return {"question": f"Is it right, as the section has it, that {about} ...?", "ground_truth": f"{'Verdadeiro' if true else 'Falso'}: {fact}", "type": kind, "difficulty": difficulty}
        return {"question": f"Which statement does the section make when it says: {about} ...?", "ground_truth": fact, "type": kind, "difficulty": difficulty}

    def _question(self, data: dict) -> dict:
        return self._one(data["fact"], data["type"], data["difficulty"], data.get("true"))

    def _questions(self, data: dict) -> list:
        return [self._one(d["fact"], d["type"], d["difficulty"], d.get("true")) for d in data["items"]]


@dataclass(frozen=True)
class HttpChat:
    """A chat endpoint that takes ``model``, ``messages``, ``temperature`` and ``max_tokens`` as JSON and answers with ``choices``. The key is read from the environment where the call is made."""

    url: str
    model: str
    key_variable: str
    timeout: float = 120

    def complete(self, request: Request) -> str:
        body = {"model": self.model, "messages": [{"role": "system", "content": request.system}, {"role": "user", "content": request.prompt}], "temperature": request.temperature, "max_tokens": request.max_tokens}
        call = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ[self.key_variable]}"})
        with urllib.request.urlopen(call, timeout=self.timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]


def chat_of(model: str, url: str = "", key_variable: str = "API_KEY") -> ChatProvider:
    """The provider of a model's name: ``offline``, or a model behind a chat endpoint."""
    if model == "offline":
        return OfflineChat()
    if not url:
        raise ValueError(f"the model {model} needs chat_url, the address of a chat endpoint")
    return HttpChat(url, model, key_variable)


def attempt(provider: ChatProvider, request: Request, retries: int, sleep=time.sleep) -> str | None:
    """The answer, or None after so many failures; waits 1, 2, 4, ... and at most 16 seconds between them."""
    for k in range(max(1, retries)):
        try:
            return provider.complete(request)
        except Exception:
            if k + 1 < retries:
                sleep(min(2**k, 16))
    return None


def parse_json(answer: str | None):
    """The value of an answer: inside a json fence first, then any fence, then as it is; None if it isn't JSON."""
    if answer is None:
        return None
    m = re.search(r"```json\s*(.*?)```", answer, re.S) or re.search(r"```\s*(.*?)```", answer, re.S)
    try:
        return json.loads((m[1] if m else answer).strip())
    except ValueError:
        return None


class EmbeddingProvider(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class HashingEmbedder:
    """Unit vectors of hashed words and letter triples."""

    dimension: int = 64

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for row, text in zip(out, texts, strict=True):
            for w in text.lower().split():
                for gram in (w, *[w[k : k + 3] for k in range(len(w) - 2)]):
                    h = _number(gram)
                    row[h % self.dimension] += 1 if h >> 40 & 1 else -1
            norm = float(np.linalg.norm(row))
            if norm:
                row /= norm
        return out


@dataclass(frozen=True)
class HttpEmbedder:
    """An endpoint that takes ``model`` and ``input`` (texts) as JSON and answers with ``data``, each with its ``embedding``, in order."""

    url: str
    model: str
    key_variable: str
    timeout: float = 120

    def embed(self, texts: list[str]) -> np.ndarray:
        call = urllib.request.Request(self.url, json.dumps({"model": self.model, "input": texts}).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ[self.key_variable]}"})
        with urllib.request.urlopen(call, timeout=self.timeout) as answer:
            return np.array([x["embedding"] for x in json.load(answer)["data"]], np.float32)


def embedder_of(model: str, url: str = "", key_variable: str = "API_KEY") -> EmbeddingProvider:
    """The provider of a model's name: ``hashing``, or a model behind an endpoint."""
    if model == "hashing":
        return HashingEmbedder()
    if not url:
        raise ValueError(f"the model {model} needs embedding_url, the address of an endpoint for embeddings")
    return HttpEmbedder(url, model, key_variable)
