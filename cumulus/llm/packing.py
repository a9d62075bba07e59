"""Best-fit packing of tokenized documents by the sum-of-squares rule.

A document becomes its token ids and an end id. Longer ones than a sequence
are cut into whole sequences, the first piece taking what is left over. A
piece goes where the sum, over the residual gaps, of the squared numbers of
open sequences with that gap becomes smallest - into an open sequence, or
into a new one if that leaves the sum smaller. Pieces are placed longest
first; sequences that did not close are opened again and their pieces
placed anew, as long as that saves sequences.

Pieces are dealt evenly over as many tasks as hold ITEMS pieces each, so a
task's memory is bounded whatever the keys, and only a few sequences per
ITEMS pieces stay partly empty.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LENGTH = 1024
END = 2
TOKENIZER = "byte_bpe_50k.json"
ITEMS = 50_000
PASSES = 5
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---------------------------------------------------------------- tokens


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file, run by tiktoken's faster merge loop.

    The ids are those of ``tokenizers`` (tested): in this vocabulary the
    order of the ids is the order of the merges. It knows no added tokens;
    ``ids_of`` tells them before.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes shown as themselves
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """A pattern of the added tokens of a ``tokenizers`` file (longest first) with one group, and their ids."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that look at the text around them are not supported")
    ids = {t["content"]: t["id"] for t in added}
    longest = sorted(ids, key=len, reverse=True)
    return (re.compile(f"({'|'.join(map(re.escape, longest))})") if ids else None), ids


def ids_of(text: str, path: str) -> list[int]:
    """The ids that ``tokenizers`` gives, added tokens included: the text is cut at these, each part encoded alone."""
    enc, (pattern, added) = encoder(path), added_tokens(path)
    parts = pattern.split(text) if pattern else [text]
    if len(parts) == 1:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for i, part in enumerate(parts):  # every second part is an added token
        if i % 2:
            ids.append(added[part])
        else:
            ids += enc.encode_ordinary(part)
    return ids


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than a sequence."""
    first = n if n <= length else n % length or length
    return [(0, first), *((at, length) for at in range(first, n, length))]


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs``; a null text is empty."""
    file = path or TOKENIZER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_file = path or public_tokenizers.path(file)
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*ids_of(text.as_py() or "", at_file), END], "<u4")
                for k, (at, n) in enumerate(cuts(len(ids), length)):
                    for column, x in zip(out, (doc_id, k, at, n, zlib.crc32(ids[at:at + n].tobytes()))):
                        column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


# ---------------------------------------------------------------- the sum-of-squares rule


def place(lengths: np.ndarray, length: int = LENGTH) -> list[list[int]]:
    """Positions of ``lengths`` by sequence, placed in the given order."""
    open_at: list[list[int]] = [[] for _ in range(length + 1)]
    count = np.zeros(length + 1)
    add = np.zeros(length + 1)  # what one more sequence with a gap adds to the sum; a closed one adds nothing
    add[1:] = 1
    bins: list[list[int]] = []
    for p, n in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(count[n:length])
        gap, least = length, add[length - n]
        if len(gaps):
            change = add[gaps] + 1 - 2 * count[gaps + n]
            k = int(np.argmin(change))
            if change[k] <= least:
                gap = n + int(gaps[k])
        if gap == length:
            b = len(bins)
            bins.append([p])
        else:
            b = open_at[gap].pop()
            bins[b].append(p)
            count[gap] -= 1
            add[gap] -= 2
        rest = gap - n
        if rest:
            open_at[rest].append(b)
            count[rest] += 1
            add[rest] += 2
    return bins


def packed(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece of at most ``length`` ids."""
    sequence, offset = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    done: list[list[int]] = []
    left, before = np.argsort(-lengths, kind="stable"), None
    for _ in range(PASSES):
        bins = [left[b] for b in place(lengths[left], length)]
        closed = [b for b in bins if lengths[b].sum() == length]
        opened = [b for b in bins if lengths[b].sum() < length]
        if before is not None and len(closed) + len(opened) >= len(before):
            opened = before  # placing anew saved nothing
            break
        done += closed
        before = opened
        if not opened:
            break
        left = np.concatenate(opened)
        left = left[np.argsort(-lengths[left], kind="stable")]
    for s, b in enumerate([*done, *opened] if len(lengths) else []):
        sequence[b] = s
        offset[b] = np.cumsum(lengths[b]) - lengths[b]
    return sequence, offset


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """One row per piece of every row of ``docs``: the piece, its sequence_id and its offset there.

    Null and empty texts are one piece of the end id; repeated rows are
    packed each; no rows give no rows.
    """
    cut = stored(pieces(docs, path, length), "pieces")
    tasks = max(1, -(-cut.count() // ITEMS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        sequence, offset = packed(rows.column("length").to_numpy(), length)
        base = TaskContext.get().partitionId() << 40
        yield from (rows.append_column("sequence_id", pa.array(sequence + base))
                    .append_column("offset", pa.array(offset)).to_batches())
    return cut.repartition(tasks).mapInArrow(run, f"{PIECES}, sequence_id long, offset long")
