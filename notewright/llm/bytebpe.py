"""Byte-level BPE ids from a public vocabulary file, fast enough for whole corpora.

The file is read once on the driver and its contents travel with the tasks, so executors need
no file of their own. Ids are those of the ``tokenizers`` library without special tokens added.
Texts that hold an added token's string go through that library itself; all others go through
``tiktoken`` with ranks read from the same file, which gives the same ids several times faster.
"""

from __future__ import annotations

import json
import pickle
import zlib
from dataclasses import dataclass
from pathlib import Path

import numpy as np

from notewright.workers import of_worker

# Fixed value: the splitting pattern of this vocabulary family.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _printable_bytes() -> dict[str, int]:
    """The byte each printable stand-in character means: visible Latin-1 stands for itself, the rest follow from 256."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    table = {chr(b): b for b in itself}
    for k, b in enumerate(b for b in range(256) if b not in itself):
        table[chr(256 + k)] = b
    return table


@dataclass(frozen=True)
class Vocabulary:
    """What travels to the tasks of a vocabulary file: the bytes of every token by id, and the file itself, both packed."""

    tokens: bytes
    added: tuple[str, ...]
    file: bytes


def read_vocabulary(path: str) -> Vocabulary:
    text = Path(path).read_text(encoding="utf-8")
    spec = json.loads(text)
    added = tuple(token["content"] for token in spec.get("added_tokens", []))
    means = _printable_bytes()
    ranks = {i: bytes(means[c] for c in piece) for piece, i in spec["model"]["vocab"].items() if piece not in added}
    return Vocabulary(zlib.compress(pickle.dumps(ranks)), added, zlib.compress(text.encode()))


class ByteBpe:
    """The encoder of a vocabulary. What it was read from is not kept beside it."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        self.added, self._file, self._exact = vocabulary.added, vocabulary.file, None
        ranks = {token: i for i, token in pickle.loads(zlib.decompress(vocabulary.tokens)).items()}
        self._fast = tiktoken.Encoding("bytebpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added):
            if self._exact is None:
                from tokenizers import Tokenizer

                self._exact = Tokenizer.from_str(zlib.decompress(self._file).decode())
            found = self._exact.encode(text, add_special_tokens=False).ids
        else:
            found = self._fast.encode_ordinary(text)
        return np.array(found, dtype="<u4")


def byte_bpe(vocabulary: Vocabulary) -> ByteBpe:
    """The encoder of a vocabulary, built once per Python worker."""
    return of_worker("bytebpe", vocabulary, ByteBpe)
