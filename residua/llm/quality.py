"""Quality classifier: supervised subword embeddings.

Every word and every character 3- and 4-gram of a text is hashed to a learned vector. A document is the
average of its vectors, and a softmax layer over it gives the class. Vectors and layer are trained
together by stochastic gradient descent in numpy, on the driver, over a bounded labelled sample.

With two classes the softmax depends on the difference of the two outputs alone, and that difference is
linear in the average. So scoring needs one number a bucket, the vector times the difference of the
output rows, and gives exactly what the averaged vector gives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from residua.llm import labelled
from residua.session import bound_arrow_batches

BITS = 16
NGRAMS = 1 << BITS
#: Buckets: n-grams, then words, then one for a word that repeats the word before it.
REPEAT = 2 * NGRAMS
BUCKETS = REPEAT + 1
#: Longer texts are read in slices of this many characters, so memory doesn't follow a text's length.
SLICE = 1 << 20
FOLDS, KEPT_BACK, THRESHOLD = 5, 0, 0.3

_BASE, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_BASE32, _MIX32 = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    n = SLICE + 4
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all words and n-grams, slice by slice; what spans two slices is found as if there were none."""
    whole = f"\n{text}\n"
    up, down = _powers()
    open_sum, open_size, before = 0, 0, None  # the word that a slice leaves open, and the last one closed
    for at in range(0, len(whole), SLICE):
        letters = np.frombuffer(whole[at : at + SLICE + 3].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = min(SLICE, len(whole) - at)
        with np.errstate(over="ignore"):
            three = (letters[:-2] * _BASE32 + letters[1:-1]) * _BASE32 + letters[2:]
            four = three[:-1] * _BASE32 + letters[3:]
            near = [((h[:n] * _MIX32) >> np.uint32(32 - BITS)).astype(np.int32) for h in (three, four)]
            own = letters[:n]
            blank = (own == 32) | ((own >= 9) & (own <= 13))
            edge = np.flatnonzero(np.diff(blank, prepend=not open_size))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * up[:n], dtype=np.uint64)])
            first = None
            if open_size:  # goes on to the first edge
                end = int(edge[0]) if len(edge) else n
                open_sum = (open_sum + pow(int(_BASE), open_size, 1 << 64) * int(sums[end])) % (1 << 64)
                open_size += end
                if len(edge):
                    first, open_size = open_sum, 0
                edge = edge[1:]
            begin, end = edge[::2], edge[1::2]
            if len(begin) > len(end):
                k = int(begin[-1])
                open_sum, open_size = int((sums[n] - sums[k]) * down[k]), n - k
                begin = begin[:-1]
            words = (sums[end] - sums[begin]) * down[begin]
            if first is not None:
                words = np.concatenate([np.array([first], dtype=np.uint64), words])
            buckets = ((words * _MIX) >> np.uint64(64 - BITS)).astype(np.int32) + NGRAMS
        again = int((words[1:] == words[:-1]).sum())
        if len(words):
            again += before is not None and before == words[0]
            before = words[-1]
        yield np.concatenate([*near, buckets, np.full(again, REPEAT, dtype=np.int32)])


@dataclass(frozen=True)
class Model:
    """What scoring needs: a number a bucket, and the difference of the output biases."""

    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        """The softmax of label 1 for one text; a null or empty text gets the bias alone."""
        total, n = 0.0, 0
        for found in grams(text or ""):
            total += float(self.weight[found].sum(dtype=np.float64))
            n += len(found)
        z = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def train(
    rows: list[tuple[str, int]], dim: int = 10, steps: int = 20_000, rate: float = 0.5, seed: int = 7
) -> Model:
    """Fit vectors and softmax layer by stochastic gradient descent; the rate falls to zero linearly.

    There are about `steps` updates, in 8 to 60 passes over rows.
    With one class or none in rows, the model gives every text the share of label 1 (0.5 without rows).
    """
    ones = sum(y for _, y in rows)
    if not 0 < ones < len(rows):
        return Model(np.zeros(BUCKETS, dtype=np.float32), 0.0 if not rows else (5.0 if ones else -5.0))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), dtype=np.float32), np.zeros(2, dtype=np.float32)
    # All bags in two arrays, so that the driver gets their memory back.
    buckets, shares, ends = np.empty(1 << 20, dtype=np.int32), np.empty(1 << 20, dtype=np.float32), [0]
    for text, _ in rows:
        found = np.concatenate(list(grams(text)))
        bucket, count = np.unique(found, return_counts=True)
        while ends[-1] + len(bucket) > len(buckets):
            buckets, shares = (np.concatenate([x, np.empty_like(x)]) for x in (buckets, shares))
        mine = slice(ends[-1], ends[-1] + len(bucket))
        buckets[mine], shares[mine] = bucket, count / max(1, len(found))
        ends.append(mine.stop)
    epochs = min(60, max(8, steps // len(rows)))
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            bucket, share, label = buckets[ends[k] : ends[k + 1]], shares[ends[k] : ends[k + 1]], rows[k][1]
            now = rate * (1 - step / steps)
            step += 1
            mean = share @ vectors[bucket]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = layer.T @ p
            layer -= now * np.outer(p, mean)
            bias -= now * p
            vectors[bucket] -= now * np.outer(share, back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = labelled.PER_CLASS) -> Model:
    """Train on labels.quality of documents outside the fold that is kept back; see labelled.sample."""
    return train(labelled.sample(docs, labels, "quality", FOLDS, KEPT_BACK, per_class))


def score(text: Column, model: Model) -> Column:
    """The probability of label 1 for each whole text, as a column."""

    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(x) for x in texts.to_pylist()], pa.float64())

    return run(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every row of docs (doc_id, text): doc_id, held_out, score, predicted.

    Null and empty texts get the model's score of an empty text; texts of any length are read whole, in
    slices that leave the n-grams as they are; a null doc_id is not held out; repeated rows are scored
    alike, and a score that ties with the threshold counts as 1; without labels every score is 0.5; an
    empty table gives no rows; other columns are ignored.
    """
    bound_arrow_batches(docs.sparkSession)
    model = fit(docs, labels)
    doc_id = F.col("doc_id").cast("long")
    scored = docs.select(doc_id.alias("doc_id"), score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        labelled.held_out(F.col("doc_id"), FOLDS, KEPT_BACK).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
