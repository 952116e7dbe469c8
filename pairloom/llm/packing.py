"""Best-fit packing of tokenised documents by the sum-of-squares rule.

A piece goes where the sum, over residual gaps, of the squared count of open bins with
that gap becomes smallest, and in a new bin only where no open one has room.  Pieces are dealt to
packs of some ten thousand by hash, longest first within a pack, and each pack is packed on
its own: only the last bins of a pack can be worse than with all pieces at once.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import settled, stored

#: Tokens of a sequence, and pieces of a pack.
CAPACITY = 2048
PACK = 12_000
#: Distinct words whose ids a worker keeps at once, and their bytes.
CACHE, CACHE_BYTES = 500_000, 12 << 20

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: 1: ASCII letters, 2: ASCII signs but those of contractions and special tokens.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<|>"]] = 2


class MergeTable:
    """Byte pair merges of many words at once."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        # the printable stand-ins of bytes in byte-level vocabularies
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        sign = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.inner = np.array([vocab[sign[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[sign[b] + model["end_of_word_suffix"]] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[x] << 32 | vocab[y] for x, y in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, np.array([vocab[x + y] for x, y in merges], np.int64)
        self.none = len(merges)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (not empty) words, and where each one's begin (n + 1): each round merges every word's pair of the lowest rank."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        sym, word = self.inner[data], np.repeat(np.arange(len(words)), lengths)
        tail = np.cumsum(lengths) - 1
        sym[tail] = self.final[data[tail]]
        rank = np.full(len(sym), self.none)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.rank(sym[inside], sym[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            best = np.minimum.reduceat(rank, first)
            ended = best == self.none
            if ended.any():
                out = np.repeat(ended, size)
                done.append((word[out], sym[out]))
                sym, word, rank = sym[~out], word[~out], rank[~out]
                best, size = best[~ended], size[~ended]
                if not len(sym):
                    break
            hit = np.flatnonzero((rank == np.repeat(best, size)) & (rank < self.none))
            joined = np.concatenate([[False], hit[1:] == hit[:-1] + 1])
            if joined.any():  # of overlapping equal pairs every other one merges, from the left
                start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(hit))))
                hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            moved = hit - np.arange(len(hit))
            sym, word, rank = sym[keep], word[keep], rank[keep]
            for at in (moved, moved[moved > 0] - 1):
                rank[at] = self.none
                pair = at[at + 1 < len(sym)]
                pair = pair[word[pair] == word[pair + 1]]
                rank[pair] = self.rank(sym[pair], sym[pair + 1])
        word, sym = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.uint32), np.searchsorted(word[order], np.arange(len(words) + 1))


class WordEncoder:
    """Ids of texts by a word-end BPE tokenizer that drops white space and never joins what white space parts: each distinct word is encoded once.

    Words of visible ASCII and of U+00C0 to U+00FF are normalised and split here (there, NFC
    changes nothing and each letter has one lower case) and merged many at once; all
    others go to the tokenizer's own library.
    """

    _SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+|\n")
    _ODD = re.compile(r"(?:[^!-~\xc0-\xff\n]|<\|)[^\n]*")  # one match for each word that has one

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.merges = MergeTable(json.load(f)["model"])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.begins, self.size, self.spelled = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0, 0

    def _learn(self, keys: list[bytes]) -> None:
        if not keys:
            return
        words = b"\n".join(keys).decode()
        lines = words.split("\n")
        begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)])
        odd = (np.searchsorted(begins, [m.start() for m in self._ODD.finditer(words)], "right") - 1).tolist()
        plain = lines.copy()
        for i in odd:
            plain[i] = ""
        parts = self._SPLIT.findall("\n".join(plain).lower() if odd else words.lower())
        number = {p: i for i, p in enumerate(dict.fromkeys(["\n", *parts]))}
        which = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        ends = np.flatnonzero(which == 0)
        ends = np.append(ends - np.arange(len(ends)), len(which) - len(ends))
        which = which[which > 0] - 1
        ids, at = self.merges.encode([p.encode() for p in number][1:])
        lengths = (at[1:] - at[:-1])[which] if len(which) else which
        stop = np.cumsum(lengths)
        flat = ids[np.repeat(at[which] - (stop - lengths), lengths) + np.arange(int(lengths.sum()))] if len(which) else ids
        edges = np.concatenate([[0], stop])[ends]
        if odd:
            found = np.split(flat, edges[:-1])
            for i in odd:
                found[i] = np.array(self.tokenizer.encode(lines[i], add_special_tokens=False).ids, np.uint32)
            flat, edges = np.concatenate(found), np.cumsum(list(map(len, found)))
        n, end = len(self.known), self.size + len(flat)
        while len(self.ids) < end:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.begins) < n + len(keys) + 1:
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.ids[self.size : end] = flat
        self.begins[n + 1 : n + len(keys) + 1] = self.size + edges
        self.known.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.size = end
        self.spelled += sum(map(len, keys))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (n + 1)."""
        raw = data.tobytes()
        if b"<|" not in raw:  # special tokens alone tell cases apart
            data = scan.FOLD[data]
            raw = data.tobytes()
        starts, ends, text = scan.word_spans(data, offsets, scan.NON_SPACE)
        # ASCII letters and signs never share a piece, but for what follows an apostrophe
        cut = np.flatnonzero(_KIND[data[1:]] + _KIND[data[:-1]] == 3) + 1
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        text = np.searchsorted(offsets, starts, "right") - 1
        size = ends - starts
        _, first, which = scan.classes(scan.spans_hash(data, starts, ends))
        alike = (size == size[first][which]) & scan.same_spans(data, starts, starts[first][which], size)
        if not alike.all():  # different words with one hash stand for themselves
            apart = np.flatnonzero(~alike)
            which[apart] = len(first) + np.arange(len(apart))
            first = np.concatenate([first, apart])
        if len(self.known) > CACHE or self.spelled > CACHE_BYTES:
            self.forget()
        names = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        self._learn(list(dict.fromkeys(w for w in names if w not in self.known)))
        at = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[which]
        lengths = self.begins[at + 1] - self.begins[at]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.begins[at] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        per_text = np.bincount(text, lengths, minlength=len(offsets) - 1).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The worker's encoder: the words that its earlier tasks met need not be encoded again."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and a 0, cut only where longer than capacity.  Null texts count as empty."""
    schema = _PIECES + (", ids binary" if with_ids else "")

    def cut(batches):
        scan.trim()
        encoder = encoder_of(tokenizer)
        for batch in batches:
            flat, offsets = scan.text_buffer(batch.column(1))
            for at, to, data, own in scan.pieces(flat, offsets, 2 << 20):
                ids, begins = encoder.encode(data, own)
                n = to - at
                full = np.zeros(len(ids) + n, "<u4")
                full[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(begins))] = ids
                begins = begins + np.arange(n + 1)
                lengths = np.diff(begins)
                many = -(-lengths // capacity)
                doc = np.repeat(np.arange(n), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * capacity
                length = np.minimum(capacity, lengths[doc] - start)
                raw, first = full.tobytes(), 4 * (begins[doc] + start)
                parts = [raw[a : a + 4 * k] for a, k in zip(first.tolist(), length.tolist(), strict=True)]
                out = {
                    "doc_id": batch.column(0).slice(at, n).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()), "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(out | ({"ids": pa.array(parts, pa.binary())} if with_ids else {}))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, placed in the given order.

    With N(g) open bins of gap g, a piece of length s changes the sum by 2 (N(g - s) - N(g)) + 2
    in a bin of gap g, and by 1 - 2 N(s) if it fills one; of equal changes the smallest gap is
    taken.  A new bin is opened only where no open one has room.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, s in enumerate(lengths.tolist()):
        gap, fits = capacity, count[s:capacity]
        if fits.any():
            delta = 2 * (count[: capacity - s] - fits) + 2
            delta[0] = 1 - 2 * fits[0]
            delta[fits == 0] = np.iinfo(np.int64).max
            gap = s + int(delta.argmin())
        if gap == capacity:
            bin_, made = made, made + 1
        else:
            bin_ = open_[gap].pop()
            count[gap] -= 1
        bins[k], offsets[k] = bin_, capacity - gap
        if gap > s:
            open_[gap - s].append(bin_)
            count[gap - s] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, each: int = PACK) -> DataFrame:
    """pieces (with a length from 1 to capacity) and sequence_id, offset: gapless from 0 in each sequence."""
    packs = max(1, round(pieces.count() / each))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def place(key, table: pa.Table) -> pa.Table:
        scan.trim()
        table = table.drop_columns("pack").sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array(bins + (key[0].as_py() << 32), pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return pieces.withColumn("pack", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(packs))).groupBy("pack").applyInArrow(lambda key, table: place(key, table), schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, little-endian 32-bit).

    An empty or null text is a piece of one id, 0.  Null and repeated doc_ids keep their
    rows; other columns are ignored; an empty table gives no rows.
    """
    settled(docs.sparkSession)
    return pack(stored(tokenized_pieces(docs, tokenizer, capacity, id_col, text_col, with_ids)), capacity)
