"""Text encoder plug-in and the offline hashing encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import md5
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

DEFAULT_DIM = 384
BATCH_TEXTS = 128
# Tokens whose slots a worker keeps; some 20 MB.
_CACHE_LIMIT = 100_000


class Encoder(Protocol):
    """Anything that turns texts into a ``(n, dimension)`` matrix."""

    dimension: int

    def encode(self, texts: Sequence[str]) -> np.ndarray: ...


class HashingEncoder:
    """Signed token counts in ``dimension`` buckets, unit length, no model file.

    Token = lower-cased run of non-blanks. The first eight hex digits of its MD5 choose the
    bucket, the ninth the sign.
    """

    def __init__(self, dimension: int = DEFAULT_DIM, normalize: bool = True) -> None:
        self.dimension = dimension
        self.normalize = normalize
        self._slots: dict[str, tuple[int, float]] = {}

    def _slot(self, token: str) -> tuple[int, float]:
        slot = self._slots.get(token)
        if slot is None:
            if len(self._slots) >= _CACHE_LIMIT:
                self._slots.clear()
            digest = md5(token.encode("utf-8", "ignore")).hexdigest()
            slot = (int(digest[:8], 16) % self.dimension, 1.0 if digest[8] < "8" else -1.0)
            self._slots[token] = slot
        return slot

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        flat: list[int] = []
        signs: list[float] = []
        for row, text in enumerate(texts):
            base = row * self.dimension
            for token in text.lower().split():
                bucket, sign = self._slot(token)
                flat.append(base + bucket)
                signs.append(sign)
        size = len(texts) * self.dimension
        out = np.bincount(np.asarray(flat, dtype=np.int64), weights=signs, minlength=size) if flat else np.zeros(size)
        out = out.reshape(len(texts), self.dimension)
        if self.normalize:
            length = np.linalg.norm(out, axis=1, keepdims=True)
            out = np.divide(out, length, out=out, where=length > 0)
        return out.astype(np.float32)


def encode_column(
    text: Column | str,
    make_encoder: Callable[[], Encoder] = HashingEncoder,
    batch_texts: int = BATCH_TEXTS,
) -> Column:
    """ARRAY<FLOAT> of ``text``; ``make_encoder`` runs once per Python worker task.

    Texts reach the encoder ``batch_texts`` at a time. Null texts give null vectors.
    """

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = make_encoder()
        for column in batches:
            texts = column.drop_null().to_pylist()
            parts = [np.empty((0, encoder.dimension), np.float32)]
            for start in range(0, len(texts), batch_texts):
                matrix = np.asarray(encoder.encode(texts[start : start + batch_texts]), dtype=np.float32)
                if matrix.ndim != 2 or matrix.shape[1] != encoder.dimension:
                    raise ValueError(f"encoder gave shape {matrix.shape}, expected (n, {encoder.dimension})")
                parts.append(matrix)
            present = column.is_valid().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(present) * encoder.dimension]).astype(np.int32)
            flat = pa.array(np.concatenate(parts).ravel(), pa.float32())
            yield pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(~present))

    return encode(_col(text))
