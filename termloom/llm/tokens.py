"""Token ids of whole texts from a public tokenizer file, fast on texts whose words repeat."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import Texts, range_hashes, text_groups

CACHE_PIECES = 600_000
CALL_BYTES = 1 << 16
BLANK, LINE_FEED = 0x20, 0x0A
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_WIDE_SPACES = ["\x85", "\xa0", " ", *map(chr, range(0x2000, 0x200B)), " ", " ", " ", " ", "　"]


def default_tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where this machine keeps a public tokenizer file; raises ImportError where the files are not installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a character that any tokenizer may take for white space."""
    space = _ASCII_SPACE[data]
    wide = [c.encode() for c in _WIDE_SPACES]
    for lead in {c[0] for c in wide}:
        at = np.flatnonzero(data == lead)
        for c in (c for c in wide if c[0] == lead):
            here = at[at + len(c) <= len(data)]
            for k, byte in enumerate(c):
                here = here[data[here + k] == byte]
            for k in range(len(c)):
                space[here + k] = True
    return space


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the pieces that can be encoded apart, and whether white space is only at their start.

    A byte-level tokenizer never joins a single blank or line feed between two other characters with what stands
    before it, so a text may be cut there.
    """
    data, n = texts.data, len(texts.data)
    space = white_space(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        single = space[1:-1] & ~space[:-2] & ~space[2:]
        cut[1 : n - 1] = single & ((data[1:-1] == BLANK) | (data[1:-1] == LINE_FEED))
        # A blank at either end of a text has no neighbour there.
        edges = texts.bounds[(texts.bounds > 0) & (texts.bounds < n)]
        cut[edges - 1] = False
    cut[texts.bounds] = True
    start = np.flatnonzero(cut[:n])
    end = np.append(start[1:], n)[: len(start)]
    text = np.searchsorted(texts.bounds, start, "right") - 1
    spaces = np.zeros(n + 1, np.int64)
    np.cumsum(space, out=spaces[1:])
    led = (data[start] == BLANK) | (data[start] == LINE_FEED) if n else np.zeros(0, bool)
    return start, end, text, led & (spaces[end] - spaces[start] == 1)


class Encoder:
    """Encodes texts with a byte-level tokenizer file: the same ids as encoding each text in one call.

    Pieces are looked up by hash in a bounded cache and only new ones are encoded, many to a call. Two pieces of one
    cache share a hash with a chance of one in ten million. Strings of added tokens in a text are ordinary text, or with
    ``added_tokens`` those tokens, as in a plain call of the library; texts that hold one are then encoded whole.
    """

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        tokens = self._tokenizer.get_vocab(with_added_tokens=True)
        added = self._tokenizer.get_added_tokens_decoder().values() if added_tokens else []
        self._added = [token.content.encode() for token in added if token.content]
        self._opens = np.zeros(max(tokens.values()) + 1, bool)
        self._opens[[i for token, i in tokens.items() if token.startswith(("Ġ", "Ċ"))]] = True
        self._limit = cache_pieces
        self._hash = np.zeros(0, np.uint64)
        self._uses = np.zeros(0, np.int64)
        self._bounds = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def _learn(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, plain: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for new pieces: plain ones many to a call, the others one by one."""
        ids: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(start)
        apart = np.flatnonzero(~plain).tolist()
        joint = np.flatnonzero(plain)
        call = np.cumsum(end[joint] - start[joint]) // CALL_BYTES
        strings = [data[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist())]
        for some in np.split(joint, np.flatnonzero(np.diff(call)) + 1) if len(joint) else []:
            found = self._encode(["".join([strings[i] for i in some.tolist()])])[0]
            opening = np.flatnonzero(self._opens[found])
            if len(opening) == len(some):
                for i, a, b in zip(some.tolist(), opening.tolist(), [*opening[1:].tolist(), len(found)]):
                    ids[i] = found[a:b]
            else:
                apart += some.tolist()
        for i, found in zip(apart, self._encode([strings[i] for i in apart])):
            ids[i] = found
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

    def _remember(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray, in_use: np.ndarray) -> None:
        """Merge new pieces (ascending hashes) into the cache; beyond its limit only the more used half stays.

        Pieces ``in_use`` just now stay as well.
        """
        order = np.argsort(np.concatenate([self._hash, hashes]), kind="stable")
        counts = np.concatenate([np.diff(self._bounds), counts])
        starts = np.cumsum(counts) - counts
        flat = np.concatenate([self._ids, ids])
        uses = np.concatenate([self._uses, np.zeros(len(hashes), np.int64)])
        if len(order) > self._limit:
            least = np.partition(uses, len(uses) // 2)[len(uses) // 2]
            needed = np.ones(len(uses), bool)
            needed[: len(self._hash)] = False
            needed[in_use] = True
            order = order[(uses > max(least, 1))[order] | needed[order]]
            uses = uses // 2
        self._ids = flat[_positions(starts[order], counts[order])]
        self._hash = np.concatenate([self._hash, hashes])[order]
        self._uses = uses[order]
        self._bounds = np.concatenate([[0], np.cumsum(counts[order])])

    def _holding(self, texts: Texts) -> list[int]:
        """Numbers of the texts that hold the string of an added token."""
        if not self._added:
            return []
        data = texts.data.tobytes()
        if not any(token in data for token in self._added):
            return []
        cuts = texts.bounds.tolist()
        return [i for i in range(len(texts)) if any(data.find(t, cuts[i], cuts[i + 1]) >= 0 for t in self._added)]

    def _encode_whole(self, text: bytes) -> np.ndarray:
        self._tokenizer.encode_special_tokens = False
        try:
            return self._encode([text.decode()])[0]
        finally:
            self._tokenizer.encode_special_tokens = True

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of texts end to end, and the bounds of each text in them."""
        holding = self._holding(texts)
        if not holding:
            return self._encode_pieces(texts)
        whole = {i: self._encode_whole(bytes(texts.bytes_of(i))) for i in holding}
        size = np.diff(texts.bounds)
        left = np.ones(len(texts), bool)
        left[holding] = False
        others = Texts(texts.first, texts.data[np.repeat(left, size)], np.r_[0, np.cumsum(size * left)])
        ids, bounds = self._encode_pieces(others)
        parts = [whole[i] if i in whole else ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.r_[0, np.cumsum([len(part) for part in parts])]

    def _encode_pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        start, end, text, plain = pieces(texts)
        distinct, first, which = np.unique(range_hashes(texts.data, start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self._hash, distinct)
        new = np.ones(len(distinct), bool)
        near = at < len(self._hash)
        new[near] = self._hash[at[near]] != distinct[near]
        if new.any():
            piece = first[new]
            learnt = self._learn(texts.data, start[piece], end[piece], plain[piece])
            self._remember(distinct[new], *learnt, in_use=at[~new])
            at = np.searchsorted(self._hash, distinct)
        self._uses[at] += 1
        at = at[which]
        counts = np.diff(self._bounds)[at]
        ids = self._ids[_positions(self._bounds[at], counts)]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.bincount(text, counts, len(texts)).astype(np.int64), out=bounds[1:])
        return ids, bounds


def _positions(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices of ragged ranges, one after the other."""
    total = np.cumsum(count)
    if not len(count):
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(start - (total - count), count)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encode_column(path: str, column: pa.Array, added_tokens: bool = False) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Ids of a column of texts (null: empty), as the number of the first text and the ids of the texts from there.

    Each worker process keeps one encoder per tokenizer file and way to read ``added_tokens``.
    """
    if (path, added_tokens) not in _encoders:
        _encoders[path, added_tokens] = Encoder(path, added_tokens=added_tokens)
    for texts in text_groups(column):
        ids, bounds = _encoders[path, added_tokens].encode(texts)
        yield texts.first, [ids[a:b] for a, b in zip(bounds, bounds[1:])]
