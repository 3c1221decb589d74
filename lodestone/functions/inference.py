"""Vectors of texts by a model that runs in the executors' Python workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A batch of texts to a matrix with a row for each.
Model = Callable[[list[str]], np.ndarray]


def encoded(text: Column, load: Callable[[], Model], dimensions: int, batch: int = 64, least: int = 8) -> Column:
    """struct(vector array<float>, error string) of each text by the model that `load` gives, once a task.

    The texts of an Arrow batch go to the model in the order of their lengths, `batch` at a time. A batch that
    ends in a MemoryError is halved, down to `least` texts, and so are those after it; one that fails otherwise, or is that
    small, goes text by text. A text that fails alone, or whose row isn't so many finite numbers, has a
    vector of zeros and the error. Nulls count as empty texts.
    """

    def rows(model: Model, texts: list[str]) -> np.ndarray:
        out = np.asarray(model(texts), dtype=np.float32)
        if out.shape != (len(texts), dimensions) or not np.isfinite(out).all():
            raise ValueError(f"the model gave {out.shape}, or numbers that aren't finite")
        return out

    @F.pandas_udf("vector array<float>, error string")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, size = load(), batch
        for part in parts:
            texts = [x if isinstance(x, str) else "" for x in part]
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            out, errors = np.zeros((len(texts), dimensions), np.float32), [None] * len(texts)
            at = 0
            while at < len(order):
                now = order[at : at + size]
                try:
                    out[now] = rows(model, [texts[i] for i in now])
                except Exception as failed:  # a model may raise anything; what it raised is in the rows
                    if isinstance(failed, MemoryError) and size > least:
                        size = max(least, size // 2)
                        continue
                    for i in now:
                        try:
                            out[i] = rows(model, [texts[i]])[0]
                        except Exception as e:
                            errors[i] = f"{type(e).__name__}: {e}"
                at += len(now)
            yield pd.DataFrame({"vector": list(out), "error": pd.Series(errors, dtype=object)})

    return encode(text)
