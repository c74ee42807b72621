"""Packing documents into fixed-length training sequences by vector bin packing.

Every sequence is a bin with three limits at once: tokens, segments and loss-bearing tokens. Bins are
filled one after another; the next piece is the one with the largest dot product between its demand
and what the bin has left, both measured in shares of the limits. Where nothing whole fits any more, a
piece is cut to fill the bin exactly, and a bin that can't be filled is cut back to a power of two, so
that no sequence needs padding.

Nothing is shuffled: a task packs one Arrow batch after another, which bounds memory by one batch. What
is left for a bin that the batch can't fill goes on to the next batch, so a task cuts back one bin at its
end, not one a batch. A task that is run again deals out the same pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import bound_arrow_batches

CAPACITY = 2048
MAX_SEGMENTS = 64
END_OF_DOCUMENT = 1
SPECIAL = "<|endoftext|>"
#: Sequences of one task are numbered from its partition number times this.
SEQUENCES_PER_TASK = 1 << 33

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)


@lru_cache(maxsize=2)
def _encoders(path: str):
    """The vocabulary twice: as a fast rank encoder, and a loader of the tokenizer proper.

    Both give the same ids on ordinary text. Only the tokenizer knows its special strings, so texts that
    contain one go to it.
    """
    import base64

    import public_tokenizers
    import tiktoken

    ranks_path = path.removesuffix(".json") + ".tiktoken"
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @lru_cache(maxsize=1)
    def full():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    return fast, full


def encode(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Token ids of each text (null: empty), each followed by the end-of-document id."""
    fast, full = _encoders(path)
    out = []
    for text in texts:
        if text and SPECIAL in text:
            ids = full().encode(text, add_special_tokens=False).ids
        else:
            ids = fast.encode_ordinary(text or "")
        ids.append(END_OF_DOCUMENT)
        out.append(np.array(ids, dtype="<u4"))
    return out


def _power_of_two(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def pack_items(
    tokens: np.ndarray, prompt: np.ndarray, limits: tuple[int, int, int], more: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pack items of `tokens` tokens, of which the first `prompt` bear no loss, into bins under limits.

    limits are tokens, segments and loss-bearing tokens of a bin. Returns for every piece the item, the
    piece's start in it, its length, its bin, and its offset in the bin. Bins hold the full number of
    tokens or a power of two. Ties go to the item that came first. With more, items are yet to come: the
    pieces of the last bin, if only those could fill it, are left out, and are the ends of their items.
    """
    cap, max_segments, max_loss = limits
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    size = tokens.astype(np.int64).copy()
    head = prompt.astype(np.int64).copy()  # loss-free tokens at the start of what is left of an item
    first = np.zeros(len(size), dtype=np.int64)
    pieces: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def take(i: int, n: int) -> None:
        """Remove the first n tokens of item i."""
        first[i] += n
        size[i] -= n
        head[i] = max(0, head[i] - n)

    for i in np.flatnonzero(size >= cap):  # whole bins of one long item need no search
        while size[i] >= cap and cap - min(head[i], cap) <= max_loss:
            pieces.append((int(i), int(first[i]), cap, bins, 0))
            bins += 1
            take(i, cap)

    while True:
        alive = np.flatnonzero(size > 0)
        if not len(alive):
            break
        open_bin: list[tuple[int, int, int, int]] = []  # item, start, length, loss-free tokens at its start
        room, segments, loss = cap, max_segments, max_loss
        while room and segments and len(alive):
            bearing = np.maximum(size[alive] - head[alive], 0)
            score = size[alive] * (room / cap**2) + segments / max_segments**2 + bearing * (loss / max_loss**2)
            fits = (size[alive] <= room) & (bearing <= loss)
            if fits.any():
                i = int(alive[np.argmax(np.where(fits, score, -1.0))])
                n = int(size[i])
            else:
                i = int(alive[np.argmax(score)])
                n = min(room, int(head[i]) + loss, int(size[i]))
                if n <= 0:
                    break
            open_bin.append((i, int(first[i]), n, min(int(head[i]), n)))
            room, segments, loss = room - n, segments - 1, loss - max(0, n - int(head[i]))
            take(i, n)
            alive = alive[size[alive] > 0]
        filled = cap - room
        if filled == 0:
            raise ValueError("limits too small to place a token")
        if more and room and segments and not len(alive):
            break
        keep = filled if filled == cap else _power_of_two(filled)
        offset = 0
        for i, start, n, lead in open_bin:
            got = min(n, keep - offset)
            if got > 0:
                pieces.append((i, start, got, bins, offset))
                offset += got
            if got < n:  # what is over goes back; it is the end of what was taken of this item
                got = max(got, 0)
                first[i], size[i], head[i] = start + got, size[i] + n - got, head[i] + max(0, lead - got)
        bins += 1
    out = np.array(pieces, dtype=np.int64).reshape(-1, 5)
    return tuple(out[:, k] for k in range(5))  # type: ignore[return-value]


class _Pool:
    """Items of a task that wait for a bin: their ids, ids of documents, and what was dealt out of them before."""

    def __init__(self, limits: tuple[int, int, int], number: int):
        self.limits, self.number = limits, number
        self.doc: list[int | None] = []
        self.ids: list[np.ndarray] = []
        self.done: list[int] = []  # tokens dealt out before
        self.head: list[int] = []

    def add(self, doc: int | None, ids: np.ndarray, prompt: int) -> None:
        self.doc.append(doc), self.ids.append(ids), self.done.append(0), self.head.append(min(max(prompt, 0), len(ids)))

    def deal(self, more: bool) -> pa.RecordBatch:
        """Pack what waits; what is left waits on."""
        total = np.array([len(x) for x in self.ids], dtype=np.int64)
        done, head = np.array(self.done, dtype=np.int64), np.array(self.head, dtype=np.int64)
        item, start, length, bin_, offset = pack_items(total - done, np.maximum(head - done, 0), self.limits, more)
        start = start + done[item]
        places = zip(item.tolist(), start.tolist(), length.tolist(), strict=True)
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([self.doc[i] for i in item.tolist()], pa.int64()),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(self.ids[i][s : s + n]) for i, s, n in places], pa.int64()),
                pa.array(total[item]),
                pa.array(self.number + bin_),
                pa.array(offset),
            ],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )
        self.number += int(bin_.max(initial=-1)) + 1
        np.add.at(done, item, length)
        rest = np.flatnonzero(done < total).tolist()
        self.doc, self.ids, self.done, self.head = (
            [self.doc[i] for i in rest], [self.ids[i] for i in rest], done[rest].tolist(), [self.head[i] for i in rest]
        )
        return out


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    prompt_tokens: str | None = None,
    prompt: str | None = None,
) -> DataFrame:
    """Pack the texts of docs (doc_id, text) into sequences of at most `capacity` tokens.

    Of instruction data, prompt may name a column whose text comes before `text` and bears no loss, or
    prompt_tokens one with the number of tokens at a text's start that bear none; without them all tokens
    bear loss. Returns the columns of PIECES: each token lies in one piece, offsets in a sequence have no gap.

    A null text or prompt is empty, and an empty text still has its end-of-document token; a null or
    negative number of prompt tokens is none, and one over the text's length is all of it. A text longer
    than a sequence is cut into as many as it needs; of items that tie the one that came first goes first;
    null and repeated doc_ids are packed row by row; an empty table gives no pieces; other columns are
    ignored. Limits under one raise an error.
    """
    bound_arrow_batches(docs.sparkSession)
    limits = (capacity, max_segments, capacity if max_loss is None else max_loss)
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    heads = F.col(f"`{prompt_tokens}`").cast("long") if prompt_tokens else F.lit(0).cast("long")
    led = F.col(f"`{prompt}`").cast("string") if prompt else F.lit(None).cast("string")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _Pool(limits, TaskContext.get().partitionId() * SEQUENCES_PER_TASK)
        for batch in batches:
            doc, text, head, before = (batch.column(k).to_pylist() for k in range(4))
            for i, ids, n, lead in zip(doc, encode(text, tokenizer_path), head, before, strict=True):
                if lead:
                    own = encode([lead], tokenizer_path)[0][:-1]  # without an end-of-document token
                    ids, n = np.concatenate([own, ids]), len(own)
                pool.add(i, ids, n or 0)
            yield pool.deal(more=True)
        yield pool.deal(more=False)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), heads.alias("head"), led.alias("lead"))
    return rows.mapInArrow(pack, PIECES)
