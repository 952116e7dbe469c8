"""Vectorised passes over UTF-8 text held in Arrow buffers.

All functions work on one flat byte buffer that holds the texts of a batch one
after the other, plus an offsets array; a word or a window never crosses a text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Odd multipliers between the steps of a hash.
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes up to which a span is hashed in steps of eight, all spans at once; longer ones go to XXH3.
_STEPPED = 64

#: Lower-cases A-Z alone.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

#: Bytes of words made of everything but ASCII white space.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words made of ASCII digits, letters (folded) and all non-ASCII characters.
ALNUM = np.ones(256, dtype=bool)
ALNUM[0x00:0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False

#: Keeps the first i bytes of a little-endian word.
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def trim() -> None:
    """Gives freed memory back to the system: a Python worker outlives its tasks, and what one stage has freed would count beside the next one's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffer(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of an Arrow string array or chunked array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0) if texts.num_chunks == 1 else pa.concat_arrays(texts.chunks)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def pieces(flat: np.ndarray, offsets: np.ndarray, target: int = 1 << 20, most: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past last text, bytes, offsets) of runs of at most most whole texts of about target bytes, so that temporaries stay small."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + target, "right")) - 1
        to = min(n, at + most, max(to, at + 1))
        yield at, to, flat[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian word; zeros follow the end.  A view, with a word for the end itself too."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(data) + 1,), strides=(1,))


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair.  Each step mixes what it has before it adds eight bytes, so no sum of bytes times powers can vanish; spans of at most eight bytes and of one length never share a hash."""
    size, words = ends - starts, eights(data)
    out = mix(mix(size.astype(np.uint64) + np.uint64(_BASE)) + (words[starts] & _KEEP[np.minimum(size, 8)]))
    live = np.flatnonzero((size > 8) & (size <= _STEPPED))
    for k in range(8, _STEPPED, 8):
        if not len(live):
            break
        out[live] = mix(out[live] * _STEP + (words[starts[live] + k] & _KEEP[np.minimum(size[live] - k, 8)]))
        live = live[size[live] > k + 8]
    if len(long := np.flatnonzero(size > _STEPPED)):
        view = memoryview(np.ascontiguousarray(data))
        out[long] = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return out


def same_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a + size] equals data[b:b + size], for each triple."""
    words, out = eights(data), np.ones(len(a), bool)
    live = np.flatnonzero((a != b) & (size <= _STEPPED))
    for k in range(0, _STEPPED, 8):
        if not len(live):
            break
        differ = (words[a[live] + k] ^ words[b[live] + k]) & _KEEP[np.minimum(size[live] - k, 8)] != 0
        out[live[differ]] = False
        live = live[~differ & (size[live] > k + 8)]
    for i in np.flatnonzero((a != b) & (size > _STEPPED)).tolist():
        out[i] = np.array_equal(data[a[i] : a[i] + size[i]], data[b[i] : b[i] + size[i]])
    return out


def order_of(h: np.ndarray) -> np.ndarray:
    """An order that sorts hashes; equal ones stay in theirs.  Sorts words of the leading hash bits and the place, and mends the few runs whose leading bits agree by chance."""
    bits = np.uint64(max(1, len(h) - 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((h & ~low) | np.arange(len(h), dtype=np.uint64)) & low).astype(np.int64)
    found = h[order]
    wrong = np.flatnonzero(found[1:] < found[:-1])
    if len(wrong):
        lead = found & ~low
        first, last = np.searchsorted(lead, lead[wrong], "left"), np.searchsorted(lead, lead[wrong], "right")
        for a, b in sorted(set(zip(first.tolist(), last.tolist(), strict=True))):
            order[a:b] = order[a:b][np.argsort(h[order[a:b]], kind="stable")]
    return order


def classes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the first place of each, and each place's index among them."""
    order = order_of(h)
    found = h[order]
    new = np.ones(len(h), bool)
    new[1:] = found[1:] != found[:-1]
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    return found[new], order[new], which


def counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and how often each occurs."""
    h = np.sort(h)
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.diff(np.append(first, len(h)))


def word_spans(data: np.ndarray, offsets: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text indices of all maximal runs of word bytes."""
    inside = of_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = edges[1:] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(flat: np.ndarray, offsets: np.ndarray, of_word: np.ndarray, fold: np.ndarray = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin (n + 1)."""
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for at, to, data, own in pieces(flat, offsets):
        data = fold[data]
        starts, ends, text = word_spans(data, own, of_word)
        hashes.append(spans_hash(data, starts, ends))
        counts[at:to] = np.bincount(text, minlength=to - at)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def ngrams(hashes: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n words and its text; a text of fewer words, but not none, has its whole sequence as one."""
    counts = np.diff(begins)
    text = np.repeat(np.arange(len(counts)), counts)
    if len(hashes) == 0:
        return hashes, text
    many = len(hashes) - n + 1
    out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if many > 0:
        h = np.full(many, n, np.uint64)
        for i in range(n):
            h = mix(h * np.uint64(_BASE) + hashes[i : i + many])
        whole = text[:many] == text[n - 1 :]
        out, owner = h[whole], text[:many][whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        h = counts[short].astype(np.uint64)
        for i in range(n - 1):
            has = counts[short] > i
            h[has] = mix(h[has] * np.uint64(_BASE) + hashes[begins[short[has]] + i])
        out, owner = np.concatenate([out, h]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def distinct_by_text(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, sorted by text and hash."""
    if len(hashes) == 0:
        return hashes, owner
    order = order_of(hashes)
    few = np.uint16 if int(owner.max()) < 1 << 16 else np.int64  # numpy sorts the short kind by radix
    order = order[np.argsort(owner[order].astype(few), kind="stable")]
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
