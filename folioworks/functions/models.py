"""Interfaces to outside models, with offline stand-ins that always give the same results, and key rotation."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioworks.functions.scalar import unit

DIMENSIONS = 768
INPUT_CHARS = 10_000


class Embedder(Protocol):
    dimensions: int

    def embed(self, texts: Sequence[str]) -> list[list[float]]: ...


class BoundaryModel(Protocol):
    """Replies to a prompt that shows numbered parts of a text with where it would divide it."""

    def reply(self, prompt: str) -> str: ...


class AnswerModel(Protocol):
    def answer(self, prompt: str) -> str: ...


@lru_cache(maxsize=1 << 18)
def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")


@dataclass
class HashingEmbedder:
    """Signed hashes of words, at norm 1: an embedder that needs no model."""

    dimensions: int = DIMENSIONS

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        words = [t[:INPUT_CHARS].lower().split() for t in texts]
        codes, known = pd.factorize(np.array([w for ws in words for w in ws], dtype=object))
        hashes = np.array([word_hash(w) for w in known], np.uint64)
        slot, sign = (hashes % np.uint64(self.dimensions)).astype(np.int64), np.where(hashes >> np.uint64(63), 1.0, -1.0)
        row = np.repeat(np.arange(len(texts)), [len(ws) for ws in words])
        sums = np.bincount(row * self.dimensions + slot[codes], sign[codes], len(texts) * self.dimensions).reshape(len(texts), self.dimensions)
        return unit(sums).tolist()


@dataclass
class LetterEmbedder:
    """How often a text has each letter from a to z, in either case, at norm 1."""

    dimensions: int = 26

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        letters = [(chr(97 + i), chr(65 + i)) for i in range(self.dimensions)]
        return unit(np.array([[t.count(a) + t.count(b) for a, b in letters] for t in (t[:INPUT_CHARS] for t in texts)], float).reshape(len(texts), self.dimensions)).tolist()


@dataclass
class EveryNth:
    """Divides after every n-th part that the prompt shows."""

    n: int = 4

    def reply(self, prompt: str) -> str:
        import re

        ids = sorted({int(x) for x in re.findall(r"<\|(?:sent|start_chunk)_(\d+)\|>", prompt)})
        cuts = [i for k, i in enumerate(ids) if k and k % self.n == 0]
        return "split_after: " + (", ".join(map(str, cuts)) if cuts else "none")


@dataclass
class FirstPassage:
    """Answers with the first passage of the prompt."""

    def answer(self, prompt: str) -> str:
        return prompt.partition("Passages:\n")[2].partition("\n\n---\n\n")[0].partition("\n\nQuestion:")[0]


class AllKeysFailed(RuntimeError):
    pass


@dataclass
class KeyRotation:
    """Keys in turn; a failed key is skipped until all have failed, then all are tried again after a pause."""

    keys: Sequence[str]
    pause: float = 60.0
    sleep: Callable[[float], None] = time.sleep
    at: int = 0
    failed: set[str] = field(default_factory=set)
    uses: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("no keys")

    @property
    def current(self) -> str:
        return self.keys[self.at]

    def next_key(self) -> str:
        """The next key that has not failed."""
        for step in range(1, len(self.keys) + 1):
            i = (self.at + step) % len(self.keys)
            if self.keys[i] not in self.failed:
                self.at = i
                return self.current
        self.sleep(self.pause)
        self.failed.clear()
        self.at = (self.at + 1) % len(self.keys)
        return self.current

    def mark_failed(self) -> None:
        self.failed.add(self.current)

    def run(self, call: Callable[[str], Any], retries: int | None = None) -> Any:
        """call(key), with other keys after a rate limit; other errors are raised at once."""
        last: Exception | None = None
        for _ in range(retries or len(self.keys)):
            try:
                self.uses[self.current] = self.uses.get(self.current, 0) + 1
                return call(self.current)
            except Exception as e:
                if not is_rate_limit(e):
                    raise
                last = e
                self.mark_failed()
                self.next_key()
        raise AllKeysFailed("every key is over its limit") from last

    def info(self) -> dict[str, Any]:
        return {"position": self.at + 1, "keys": len(self.keys), "failed": len(self.failed)}


def is_rate_limit(error: Exception) -> bool:
    """Whether an error speaks of a quota or a rate limit, by its status or its words."""
    status = getattr(error, "status", None) or getattr(error, "code", None)
    words = str(error).lower()
    return status == 429 or "429" in words or "quota" in words or "rate limit" in words


_rotations: dict[tuple[str, ...], KeyRotation] = {}


def shared_rotation(keys: Sequence[str]) -> KeyRotation:
    """One rotation for each Python worker and list of keys; the first to ask makes it."""
    return _rotations.setdefault(tuple(keys), KeyRotation(tuple(keys)))


#: Texts that a model gets at once.
EMBED_ROWS = 1024


def embedded_texts(model: Embedder, texts: list[str]) -> tuple[list[list[float]], list[bool]]:
    try:
        return model.embed(texts), [True] * len(texts)
    except Exception:  # one bad text must not cost the whole batch
        vectors, ok = [], []
        for t in texts:
            try:
                vectors += model.embed([t])
                ok.append(True)
            except Exception:
                vectors.append([0.0] * model.dimensions)
                ok.append(False)
        return vectors, ok


def embed(text: Column, embedder: Embedder | None = None) -> Column:
    """struct(embedding, embed_ok) of texts; a text that fails has a zero vector."""
    model = embedder or HashingEmbedder()

    @F.pandas_udf("embedding array<float>, embed_ok boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for at in range(0, len(batch), EMBED_ROWS):  # so that a batch's vectors are never held at once as lists
                texts = [(t or "")[:INPUT_CHARS] for t in batch.iloc[at : at + EMBED_ROWS]]
                parts.append(pd.DataFrame(dict(zip(("embedding", "embed_ok"), embedded_texts(model, texts), strict=True))))
            yield pd.concat(parts) if parts else pd.DataFrame({"embedding": [], "embed_ok": []})

    return run(text)


def answers(prompt: Column, model: AnswerModel | None = None) -> Column:
    """Answers to prompts; an error becomes the text of the answer."""
    chosen = model or FirstPassage()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for p in batch:
                try:
                    out.append(chosen.answer(p or ""))
                except Exception as e:
                    out.append(f"No answer: {e}")
            yield pd.Series(out, dtype=object)

    return run(prompt)
