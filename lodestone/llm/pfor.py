"""Patched frame-of-reference coding of token ids, and the shard file around it.

A block holds 128 ids: the block's minimum is taken off, the rest is packed at the bit width that a
chosen percentile of the block needs, and what is wider goes to the block's exception list. A file is

    magic "PFR1", block size u32, documents u64, ids u64, blocks u64
    doc_id i64 and doc_id-is-known u8 of each document, its number of ids u64
    place of each block in the body, u64, and of the end
    body: for each block minimum u32, width u8, exceptions u8, the packed residuals, exception places
    u8, exception values u32

so any block can be decoded alone. All numbers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 128
PERCENTILE = 0.90
_HEAD = struct.Struct("<4sIQQQ")
_CHUNK = 512  # blocks at a time, for a bounded working set


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each number needs, 0 for 0."""
    return np.frexp(x.astype(np.float64))[1]


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Block starts (one more than blocks) and body."""
    n = len(ids)
    rows = -(-n // BLOCK)
    starts, body, at = np.zeros(rows + 1, np.uint64), [], 0
    for lo in range(0, rows, _CHUNK):
        part = ids[lo * BLOCK : (lo + _CHUNK) * BLOCK].astype(np.uint32)
        m = -(-len(part) // BLOCK)
        part = np.pad(part, (0, m * BLOCK - len(part)), mode="edge").reshape(m, BLOCK)
        low = part.min(1)
        rest = part - low[:, None]
        k = min(BLOCK - 1, int(percentile * BLOCK))
        width = _bits(np.partition(rest, k, axis=1)[:, k]).astype(np.int64)
        wide = rest >> np.minimum(width, 31)[:, None].astype(np.uint32) > 0
        wide[width >= 32] = False
        exceptions = wide.sum(1)
        size = 6 + width * (BLOCK // 8) + exceptions * 5
        begin = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.uint8)
        out[begin[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(m, 4)
        out[begin + 4], out[begin + 5] = width, exceptions
        for w in np.unique(width[width > 0]):
            rows_w = np.flatnonzero(width == w)
            planes = np.unpackbits(rest[rows_w].astype("<u4").view(np.uint8).reshape(len(rows_w), BLOCK, 4), axis=2, count=int(w), bitorder="little")
            packed = np.packbits(planes.reshape(len(rows_w), -1), axis=1, bitorder="little")
            out[(begin[rows_w] + 6)[:, None] + np.arange(packed.shape[1])] = packed
        r, c = np.nonzero(wide)
        if len(r):
            rank = np.arange(len(r)) - (np.cumsum(exceptions) - exceptions)[r]
            place = begin[r] + 6 + width[r] * (BLOCK // 8)
            out[place + rank] = c
            values = rest[r, c].astype("<u4").view(np.uint8).reshape(-1, 4)
            out[(place + exceptions[r] + 4 * rank)[:, None] + np.arange(4)] = values
        starts[lo : lo + m] = at + begin
        at += len(out)
        body.append(out.tobytes())
    starts[rows] = at
    return starts, b"".join(body)


def decode_blocks(body: bytes, starts: np.ndarray, n: int) -> np.ndarray:
    """The first n ids of the blocks."""
    raw, rows = np.frombuffer(body, np.uint8), len(starts) - 1
    ids = np.empty((rows, BLOCK), np.uint32)
    every = starts[:-1].astype(np.int64)
    for lo in range(0, rows, _CHUNK):
        begin = every[lo : lo + _CHUNK]
        m = len(begin)
        low = raw[begin[:, None] + np.arange(4)].copy().view("<u4").reshape(m)
        width, exceptions = raw[begin + 4].astype(np.int64), raw[begin + 5].astype(np.int64)
        rest = np.zeros((m, BLOCK), np.uint32)
        for w in np.unique(width[width > 0]):
            rows_w = np.flatnonzero(width == w)
            packed = raw[(begin[rows_w] + 6)[:, None] + np.arange(w * BLOCK // 8)]
            planes = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows_w), BLOCK, w)
            value = np.zeros((len(rows_w), BLOCK), np.uint32)
            for b in range(w):
                value |= planes[:, :, b].astype(np.uint32) << np.uint32(b)
            rest[rows_w] = value
        r = np.repeat(np.arange(m), exceptions)
        if len(r):
            rank = np.arange(len(r)) - (np.cumsum(exceptions) - exceptions)[r]
            place = begin[r] + 6 + width[r] * (BLOCK // 8)
            values = raw[(place + exceptions[r] + 4 * rank)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
            rest[r, raw[place + rank]] = values
        ids[lo : lo + m] = rest + low[:, None]
    return ids.reshape(-1)[:n]


def dump(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A shard file."""
    starts, body = encode_blocks(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join(
        (
            _HEAD.pack(b"PFR1", BLOCK, len(doc_ids), len(ids), len(starts) - 1),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            known.tobytes(),
            np.array(lengths, "<u8").tobytes(),
            starts.astype("<u8").tobytes(),
            body,
        )
    )


def load(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, numbers of ids, ids of a shard file."""
    magic, block, docs, n, blocks = _HEAD.unpack_from(data)
    if magic != b"PFR1" or block != BLOCK:
        raise ValueError("not a token shard of this format")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, known, lengths, starts = take("<i8", docs), take("u1", docs), take("<u8", docs), take("<u8", blocks + 1)
    ids = decode_blocks(data[at:], starts, n)
    return [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], lengths.astype(np.int64), ids
