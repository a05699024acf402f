"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

A tokenizer file gives the vocabulary and the merges in order of rank. Words (pre-tokens) not seen
before in a task are encoded together: their byte symbols lie in one flat array, each round looks up
every neighbouring pair by binary search over the sorted pair keys, takes the lowest rank of each
word and merges all its places at once, left to right. Words without a mergeable pair leave the
array. Vocabularies are read, never trained; the path is a parameter.

Edge cases: a null text counts as empty and has no ids; ids that are not in the vocabulary raise.
A very long word is one more word of the flat array. Extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Fixed value: the splitting pattern that byte-level vocabularies of this kind are defined with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose ids a task remembers; beyond it, it forgets them all and goes on.
REMEMBERED = 200_000
#: Ids decoded in one go (a few bytes of text each).
DECODED_AT_ONCE = 200_000

_NONE = np.int64(np.iinfo(np.int64).max)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in such vocabularies: printable Latin-1
    bytes stand for themselves, the others take the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {}, 256
    for b in range(256):
        if b in shown:
            names[b] = chr(b)
        else:
            names[b], extra = chr(extra), extra + 1
    return [names[b] for b in range(256)]


class BytePairModel:
    """Tables of a byte-level BPE tokenizer: small, bounded by the vocabulary, sent to every task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE file without normalizer and prefix space is expected")
        vocab: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        to_byte = {s: b for b, s in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces: list[bytes | None] = [None] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            pieces[i] = bytes(to_byte[c] for c in token)
        for token, i in self.special.items():
            pieces[i] = token.encode()
        # the pieces' bytes end to end; -1 marks ids without a piece
        self.pool = np.frombuffer(b"".join(p or b"" for p in pieces), np.uint8)
        self.piece_length = np.array([-1 if p is None else len(p) for p in pieces], np.int64)
        self.piece_start = np.cumsum(np.maximum(self.piece_length, 0)) - np.maximum(self.piece_length, 0)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.merge_rank = np.append(self.ranks, _NONE)
        self.byte_merges = self._merge_of(np.repeat(self.first, 256), np.tile(self.first, 256))

    @classmethod
    def of(cls, tables: dict) -> BytePairModel:
        """From the plain tables (``vars(model)``) that a broadcast carries."""
        model = cls.__new__(cls)
        model.__dict__.update(tables)
        return model

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the merge of each pair, or that of no merge, by binary search."""
        key = (left << np.int64(32)) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, len(self.keys))

    def merge_rounds(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        word = np.repeat(np.arange(len(words)), np.array([len(w) for w in words], np.int64))
        symbols = self.first[raw]
        none = len(self.keys)
        # per place, the merge with the next symbol of its word
        merge = np.full(len(symbols), none)
        merge[:-1] = np.where(word[:-1] == word[1:], self.byte_merges[raw[:-1] << 8 | raw[1:]], none)
        while len(symbols):
            rank = self.merge_rank[merge]
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            done = least == _NONE
            for s, n in zip(starts[done].tolist(), sizes[done].tolist()):
                out[word[s]] = symbols[s : s + n]
            chosen = (rank == np.repeat(least, sizes)) & (rank != _NONE)
            # of overlapping places (a run of one symbol) every second one merges
            where = np.arange(len(symbols))
            begins = chosen & ~np.concatenate([[False], chosen[:-1]])
            run = np.maximum.accumulate(np.where(begins, where, 0))
            places = np.flatnonzero(chosen & ((where - run) % 2 == 0))
            symbols[places] = self.merged[merge[places]]
            keep = np.repeat(~done, sizes)
            keep[places + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[places] = True
            symbols, word, merge, changed = symbols[keep], word[keep], merge[keep], changed[keep]
            # only pairs with a new symbol have another merge than before
            changed[:-1] |= changed[1:]
            at = np.flatnonzero(changed)
            at = at[at < len(symbols) - 1]
            merge[at] = np.where(word[at] == word[at + 1], self._merge_of(symbols[at], symbols[at + 1]), none)
            if len(merge):
                merge[-1] = none
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids. Bytes that are not UTF-8 become replacement characters."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.piece_length) or (self.piece_length[ids] < 0).any()):
            raise ValueError("an id is not in the vocabulary")
        out = []
        for part in (ids[i : i + DECODED_AT_ONCE] for i in range(0, len(ids), DECODED_AT_ONCE)):
            length = self.piece_length[part]
            ends = np.cumsum(length)
            # every byte's place in the pool: its piece's start plus its place in the piece
            place = np.arange(ends[-1]) + np.repeat(self.piece_start[part] - ends + length, length)
            out.append(self.pool[place].tobytes())
        return b"".join(out).decode("utf-8", "replace")


class Encoder:
    """Encodes texts with a model; remembers the ids of words."""

    def __init__(self, model: BytePairModel):
        self.model = model
        self.words = regex.compile(PATTERN)
        special = sorted(model.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers

    def _split(self, text: str) -> list[str]:
        if self.special is None or not any(s in text for s in self.model.special):
            return self.words.findall(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                out.append(part)
                self.known[part] = np.int32(self.model.special[part]).tobytes()
            elif part:
                # a word may read like a special token only where the file splits it off first
                out.extend(self.words.findall(part))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [self._split(t) for t in texts]
        known = self.known
        new = list(set().union(*split).difference(known))
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            for w, ids in zip(part, self.model.merge_rounds([w.encode() for w in part])):
                known[w] = ids.astype(np.int32).tobytes()
        return [np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in split]


def _keep(batch: pa.RecordBatch, *drop: str) -> tuple[list, list[str]]:
    names = [n for n in batch.schema.names if n not in drop]
    return [batch.column(n) for n in names], names


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    tables = spark.sparkContext.broadcast(vars(BytePairModel(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(BytePairModel.of(tables.value))
        for b in batches:
            for part in (b.slice(i, 32) for i in range(0, b.num_rows, 32)):
                ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                cuts = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """All columns but the ids, and the decoded text."""
    spark = encoded.sparkSession
    small_batches(spark)
    tables = spark.sparkContext.broadcast(vars(BytePairModel(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = BytePairModel.of(tables.value)
        for b in batches:
            column = b.column(b.schema.get_field_index(ids_col))
            values, cuts = column.values.to_numpy(), column.offsets.to_numpy()
            texts = [model.decode(values[i:j]) for i, j in zip(cuts, cuts[1:])]
            columns, names = _keep(b, ids_col)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, out_col])

    rest = [f for f in encoded.schema.fields if f.name != ids_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return encoded.mapInArrow(run, f"{schema}, `{out_col}` string")
