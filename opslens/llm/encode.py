"""Token ids of whole texts, with each distinct word encoded once per Python worker.

A byte-level BPE always cuts a text before a space that is followed by a visible character, between
an ASCII letter and another ASCII character, and after a lone line break, and never merges across such
a cut.  So the ids of a text are the ids of its pieces in a row, and a piece met before need not be
encoded again: the texts of a batch are cut with numpy on the Arrow bytes, pieces are looked up in a
cache, and only new ones go through the ``tokenizers`` library, many at a time.  Added tokens, such as an end mark, are
cut out of a text first, as the library does, and what stands between them is encoded on its own.  The result equals
``encode(text, add_special_tokens=False)`` (``tests/llm/test_tokens.py``).
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa

#: Id that ends each document.
END_ID = 0
#: Pieces that a worker remembers before it starts anew, about 150 bytes each.
CACHE_PIECES = 250_000
#: Bytes after which a space does not start a piece: they may begin a Unicode space.
_SPACE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)

_OPENS = np.zeros(256, dtype=bool)
_OPENS[0x21:] = True
_OPENS[list(_SPACE_LEADS)] = False
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_ASCII_OTHER = ~_LETTER
_ASCII_OTHER[0x80:] = False
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
#: The classes above as flags of a byte, so that a text's bytes are looked up once.
_SPACE, _BREAK, _OPENING, _LETTERS, _OTHERS, _SEEN = (np.uint8(1 << i) for i in range(6))
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x20], _CLASS[0x0A] = _SPACE, _BREAK
for _flag, _bytes in ((_OPENING, _OPENS), (_LETTERS, _LETTER), (_OTHERS, _ASCII_OTHER), (_SEEN, _VISIBLE)):
    _CLASS[_bytes] |= _flag
_CLASS[0x20] &= ~_OTHERS
#: New pieces that are encoded as one text.
_JOIN = 64


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of an Arrow string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def _bytes_list(pieces: pa.LargeBinaryArray) -> list[bytes]:
    """``to_pylist`` of an array without nulls, cut out of its bytes at once."""
    _, offsets, data = pieces.buffers()
    ends = np.frombuffer(offsets, np.int64, len(pieces) + 1 + pieces.offset)[pieces.offset :].tolist()
    whole = data.to_pybytes()
    return [whole[a:b] for a, b in zip(ends, ends[1:])]  # noqa: B905


class Encoder:
    """Encodes batches of texts; one per Python worker and vocabulary file (see ``encoder``)."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take in what stands around them are not supported")
        self.added = {t.content: i for i, t in added.items()}
        longest_first = sorted(filter(None, self.added), key=len, reverse=True)
        self.cut = re.compile("|".join(f"({re.escape(t)})" for t in longest_first)) if longest_first else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_ids = max(vocabulary.values()) + 1
        self.id_type = np.uint16 if self.n_ids <= 1 << 16 else np.uint32
        self.token_bytes = np.zeros(self.n_ids, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)  # a byte-level token has one character a byte
        self.cache_pieces = cache_pieces
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, self.id_type)
        self.starts = np.zeros(1 << 14, np.int64)  # piece i has ids starts[i] to starts[i + 1]

    def _remember(self, pieces: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, at = len(self.index), self.starts[len(self.index)]
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n + len(pieces) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
        self.ids[at : at + len(ids)] = ids
        self.starts[n + 1 : n + 1 + len(pieces)] = at + np.cumsum(lengths)
        self.index.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces, joined into texts that are cut again where they were joined."""
        spaced, bare, rest = [], [], []
        for p in pieces:
            if p[:1] == b" ":
                spaced.append(p)
            elif (text := p.decode()) == text.strip():
                bare.append(p)
            else:
                rest.append(p)
        for some, between, size in ((spaced, b"", _JOIN), (bare, b"\n", _JOIN), (rest, b"", 1)):
            if not some:
                continue
            texts = [between.join(some[i : i + size]).decode() for i in range(0, len(some), size)]
            many = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.array([i for e in many for i in e.ids], self.id_type)
            ends = np.cumsum(self.token_bytes[ids])
            # What stands between two pieces of a text is a token of its own and left out.
            gap = np.full(len(some), len(between))
            gap[::size] = 0
            lengths = np.fromiter(map(len, some), np.int64, len(some))
            stop = np.cumsum(lengths + gap)
            first = np.searchsorted(ends, stop - lengths, side="right")
            last = np.searchsorted(ends, stop) + 1
            if between:
                keep = np.ones(len(ids), dtype=bool)
                keep[first[gap > 0] - 1] = False
                ids = ids[keep]
            self._remember(some, ids, last - first)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids start and end (n + 1 offsets)."""
        data, offsets = text_buffers(texts)
        whole = data.tobytes() if self.added else b""
        if any(t.encode() in whole for t in self.added):
            return self._encode_around(texts)
        return self._encode_plain(data, offsets)

    def _encode_around(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts of which some hold added tokens."""
        between, marks, counts = [], [], []
        for text in texts.to_pylist():
            parts = [p for p in self.cut.split(text or "") if p is not None]
            between += [None if p in self.added else p for p in parts]
            marks += [self.added.get(p, -1) for p in parts]
            counts.append(len(parts))
        ids, offsets = self._encode_plain(*text_buffers(pa.array(between, pa.large_string())))
        mark = np.array(marks, np.int64)
        lengths = np.where(mark >= 0, 1, np.diff(offsets))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(ends[-1], self.id_type)
        special = np.zeros(ends[-1], dtype=bool)
        special[ends[:-1][mark >= 0]] = True
        out[special], out[~special] = mark[mark >= 0], ids
        return out, ends[np.concatenate([[0], np.cumsum(counts)])]

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, self.id_type), np.zeros(len(offsets), np.int64)
        kind = np.frombuffer(data.tobytes().translate(_CLASS.tobytes()), np.uint8)
        has = {f: (kind & f) != 0 for f in (_SPACE, _BREAK, _OPENING, _LETTERS, _OTHERS, _SEEN)}
        opens = np.zeros(len(data), dtype=bool)
        opens[:-1] = has[_SPACE][:-1] & has[_OPENING][1:]
        opens[1:] |= has[_LETTERS][:-1] & has[_OTHERS][1:]
        opens[2:] |= has[_BREAK][1:-1] & has[_SEEN][:-2] & has[_OPENING][2:]
        filled = np.flatnonzero(np.diff(offsets))
        opens[offsets[filled]] = True
        # A space that ends a text is followed by another text's byte; it opens no piece.
        ends = offsets[filled + 1] - 1
        opens[ends[(data[ends] == 0x20) & (ends != offsets[filled])]] = False
        cuts = np.append(np.flatnonzero(opens), len(data))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct = _bytes_list(pieces.dictionary)
        if len(self.index) + len(distinct) > self.cache_pieces:
            self._forget()
        known = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown]
            self._learn(new)
            known[unknown] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
        at = known[pieces.indices.to_numpy()]
        starts = self.starts[at]
        lengths = self.starts[at + 1] - starts
        out = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(starts - out[:-1], lengths) + np.arange(out[-1])]
        return ids, out[np.searchsorted(cuts, offsets)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> Encoder:
    """This worker's encoder for the vocabulary file at ``path``, which remembers ``cache_pieces`` from now on."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].cache_pieces = cache_pieces
    return _ENCODERS[path]


def with_end(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``END_ID`` after each document, and the new offsets."""
    n = len(offsets) - 1
    return np.insert(ids, offsets[1:], END_ID).astype(ids.dtype, copy=False), offsets + np.arange(n + 1)
