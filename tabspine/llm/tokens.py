"""Byte-level BPE token ids of whole texts.

The pattern that splits text before merges never joins a character that is no white space with white space after it. So a text
can be cut at every single space between two other characters, each part encoded by itself, and the ids put together again.
Parts repeat: those of a block are hashed together, each is encoded once, and a bounded memory keeps what earlier blocks encoded.
Added tokens of the vocabulary are found in texts first; what lies between them is encoded as if it were a text of its own.
"""

from __future__ import annotations

import base64
import json
import re
from array import array

import numpy as np
import tiktoken

from tabspine.llm.blocks import Block, run_hashes
from tabspine.llm.workers import held

#: Parts that are remembered between blocks.
REMEMBERED = 200_000

_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
#: Bytes that may begin white space beyond ASCII, and the two before its last byte.
_LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
_TAIL = np.isin(np.arange(256), [0x80, 0x81, 0x9A])


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions of spaces with no white space on either side; doubtful bytes count as white space."""
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    fine = ~_WHITE[before] & ~_WHITE[after] & ~_LEAD[after]
    fine &= ~((two == 0xC2) & ((before == 0x85) | (before == 0xA0))) & ~(_LEAD[three] & _TAIL[two])
    return at[fine]


def added_tokens(path: str) -> dict[bytes, int]:
    """Added tokens of the tokenizer's JSON that lies beside a rank file, and their ids."""
    with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
        every = json.load(file).get("added_tokens") or []
    for token in every:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"added token {token['content']!r} takes white space or whole words only: not supported")
    return {token["content"].encode(): token["id"] for token in every}


class Encoder:
    """Encodes texts with a vocabulary stored as base64 ranks, and added tokens by the JSON of the same name beside it."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)
        self._added = added_tokens(path)
        # The longest of those that begin at one place.
        self._places = re.compile(b"|".join(map(re.escape, sorted(self._added, key=len, reverse=True)))) if self._added else None
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered; workers live on after a task and would hold it."""
        self._known, self._at, self._n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def _ordinary(self, text: str) -> np.ndarray:
        return np.frombuffer(array("I", self._bpe.encode_ordinary(text)), np.uint32)

    def _added_in(self, raw: bytes, low: int, high: int) -> list[tuple[int, int]]:
        return [m.span() for m in self._places.finditer(raw, low, high)] if self._places else []

    def ids(self, text: str) -> np.ndarray:
        raw, found, at = text.encode(), [], 0
        for low, high in self._added_in(raw, 0, len(raw)):
            found += [self._ordinary(raw[at:low].decode()), np.array([self._added[raw[low:high]]], np.uint32)]
            at = high
        return np.concatenate([*found, self._ordinary(raw[at:].decode())]) if found else self._ordinary(text)

    def _remember(self, hashes: np.ndarray, at: np.ndarray, n: np.ndarray, pool: np.ndarray) -> None:
        if len(self._known) + len(hashes) > REMEMBERED:
            self.forget()
        at = at + len(self._pool)
        self._pool = np.concatenate([self._pool, pool])
        known = np.concatenate([self._known, hashes])
        order = np.argsort(known, kind="stable")
        self._known = known[order]
        self._at, self._n = np.concatenate([self._at, at])[order], np.concatenate([self._n, n])[order]

    def _parts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For parts that begin with a space and end with none: ids end to end, and where each part's are."""
        hashes = run_hashes(data, starts, ends)
        own, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self._known, own)
        place[place == len(self._known)] = 0
        new = self._known[place] != own if len(self._known) else np.ones(len(own), bool)
        at, n = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        at[~new], n[~new] = self._at[place[~new]], self._n[place[~new]]
        pool, old = self._pool, len(self._pool)
        if new.any():
            low, high = starts[first[new]], ends[first[new]]
            ids = self._ordinary(b"".join([data[a:b].tobytes() for a, b in zip(low, high)]).decode())
            closes = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(high - low)) + 1
            begins = np.r_[0, closes[:-1]]
            at[new], n[new] = begins + old, closes - begins
            pool = np.concatenate([pool, ids])
            self._remember(own[new], begins, closes - begins, ids)
        return pool, at[which], n[which]

    def _added_of_rows(self, raw: bytes, offsets: np.ndarray) -> set[tuple[int, int]]:
        """Where added tokens lie, none across two rows."""
        if not self._added_in(raw, 0, len(raw)):
            return set()
        return {place for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for place in self._added_in(raw, low, high)}

    def block(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and where each row's begin (one more than rows)."""
        data, offsets, rows = block.data, block.offsets, len(block)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        head, first = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        first[offsets] = True
        head[offsets] = True
        head[cuts(data)] = True
        added = self._added_of_rows(data.tobytes(), offsets)
        for low, high in added:
            head[low:high] = False
            head[[low, high]] = first[[low, high]] = True
        starts = np.flatnonzero(head[:-1])
        ends = np.r_[starts[1:], len(data)]
        # The first part of a row begins with no space of its own, and the last may end in white space: these go by themselves. So
        # do the parts around added tokens.
        first[-1] = True
        alone = first[starts] | (first[ends] & (_WHITE[data[ends - 1]] | (data[ends - 1] >= 0x80)))
        pool, at, n = self._parts(data, starts[~alone], ends[~alone])
        own = [
            np.array([self._added[data[a:b].tobytes()]], np.uint32) if (a, b) in added else self._ordinary(data[a:b].tobytes().decode())
            for a, b in zip(starts[alone].tolist(), ends[alone].tolist())
        ]
        all_at, all_n = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        all_at[~alone], all_n[~alone] = at, n
        all_n[alone] = [len(x) for x in own]
        all_at[alone] = np.cumsum(all_n[alone]) - all_n[alone] + len(pool)
        pool = np.concatenate([pool, *own])
        upto = np.cumsum(all_n)
        ids = pool[np.repeat(all_at - (upto - all_n), all_n) + np.arange(upto[-1])]
        return ids, np.r_[0, upto][np.searchsorted(starts, offsets)]


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a vocabulary, held by each worker process."""
    return held(("encoder", path, pattern), lambda: Encoder(path, pattern))
