"""Text encoders. An encoder has ``encode(texts, batch_size) -> float matrix``."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Sequence

import numpy as np

from notewright.workers import of_worker

MODEL_NAME = "BAAI/bge-small-en-v1.5"
DIMENSION = 384
BATCH_SIZE = 32

Encoder = Callable[[], object]


class HashingEncoder:
    """Model-free encoder: signed counts of hashed words, scaled to unit length.

    Needs no download and gives the same vector on every machine, which suits tests
    and installations without a model.
    """

    def __init__(self, dimension: int = DIMENSION, seed: int = 0):
        self.dimension, self.seed = dimension, seed

    def encode(self, texts: Sequence[str], batch_size: int = BATCH_SIZE) -> np.ndarray:
        matrix = np.zeros((len(texts), self.dimension), dtype=np.float32)
        for row, text in zip(matrix, texts):
            codes = [zlib.crc32(word.encode(), self.seed) for word in re.findall(r"\w+", text.lower())]
            if not codes:
                codes = [zlib.crc32(text.encode(), self.seed)]
            code = np.array(codes, dtype=np.int64)
            signs = np.where(code & 1, 1.0, -1.0)
            row += np.bincount((code >> 1) % self.dimension, weights=signs, minlength=self.dimension)
            length = np.linalg.norm(row)
            if length:
                row /= length
            else:
                row[0] = 1.0
        return matrix


def hashing_encoder(dimension: int = DIMENSION, seed: int = 0) -> Encoder:
    """Factory of the hashing encoder, built once per Python worker."""
    return lambda: of_worker("hashing", (dimension, seed), lambda key: HashingEncoder(*key))
