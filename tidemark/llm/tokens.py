"""Token ids by a tokenizers file, with bounded per-worker memories of white-space-free chunks and of pieces.

The tokenizer's pre-tokenizer never lets a piece cross white space and drops the white space itself, so the ids of a
text are the ids of its chunks in order, and those of a chunk are the ids that the model gives to its pieces. Chunks
are read by the file's own normaliser, pre-tokenizer and model; for printable ASCII without special strings the first
two are lower case and one expression. Plain chunks of a batch are cut into lower-case pieces all at once, and only the distinct
pieces are looked up one by one. The tests compare with whole-text encoding.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
from array import array

import numpy as np
import pyarrow as pa

#: Plain pieces and other chunks, and the latter's pieces, that a Python worker remembers in each of two generations, so both stay bounded.
CHUNKS, PIECES = 120_000, 30_000
#: Chunks of printable ASCII and Latin-1 letters: already NFC, lower case letter by letter; and their pieces.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: The pre-tokenizer that the expression stands for; a file with another one is refused.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# By rule: bytes that are printable in Latin-1 stand for themselves, the others for code points from 256 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

# Kinds of bytes; 0xC3 begins every Latin-1 letter, and two signs.
_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_KINDS = np.full(256, _ODD, np.uint8)
_KINDS[33:127] = _MARK
_KINDS[list(b" \t\n\r\x0b\x0c")], _KINDS[48:58], _KINDS[ord("'")] = _SPACE, _DIGIT, _ODD
_KINDS[[*range(65, 91), *range(97, 123), 0xC3]] = _LETTER


class _Memory(dict):
    """Ids by chunk; an unknown chunk is read when it is first asked for. What is asked for again outlives the generation before."""

    def __init__(self, read, before=None):
        super().__init__()
        self.read, self.before = read, before

    def __missing__(self, chunk):
        out = self.before.get(chunk) if self.before is not None else None
        if out is None:
            out = self.read(chunk)
        self[chunk] = out
        return out

    def following(self) -> "_Memory":
        """This memory as the generation before an empty one."""
        self.before = None
        return _Memory(self.read, self)


class ChunkEncoder:
    """Little-endian unsigned ids (16 bits where the vocabulary allows it, else 32) of texts given as UTF-8 bytes."""

    _by_path: dict[str, "ChunkEncoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(id_dtype(path, self.tokenizer))
        if _PATTERN not in str(self.tokenizer.pre_tokenizer).replace("\\\\", "\\"):
            raise ValueError("a tokenizer whose pieces may hold white space can't be read chunk by chunk")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()) or "(?!)")
        self.kinds = _KINDS.copy()
        self.kinds[[t.content.encode()[0] for t in self.tokenizer.get_added_tokens_decoder().values()]] = _ODD
        self.tokenize = self.tokenizer.model.tokenize
        self.known, self.known_pieces = _Memory(self._chunk), _Memory(self._piece)
        self.as_bytes = _Memory(lambda c: "".join(chr(BYTE_CHARACTERS.get(x, x)) for x in c.encode()))

    @classmethod
    def of(cls, path: str) -> "ChunkEncoder":
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    @classmethod
    def forget(cls) -> None:
        """Drop what this worker remembers: steps that follow the encoding call this, as Spark runs them in the same worker."""
        if cls._by_path:
            cls._by_path.clear()
            gc.collect()  # an encoder and its memories know each other, so it does not go by itself
            give_back()

    def _piece(self, piece: str) -> bytes:
        """Ids of a normalised piece, which the model reads with every byte as a character."""
        if not piece.isascii():
            piece = "".join(map(self.as_bytes.__getitem__, piece))
        return array(self.code, [t.id for t in self.tokenize(piece)]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # ASCII letters alone: one piece, and no special string
            return array(self.code, [t.id for t in self.tokenize(chunk.lower().decode())]).tobytes()
        text = chunk.decode("utf-8", "replace")
        if self.special.search(text):
            return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if _PLAIN.fullmatch(text):
            text = text.lower()
            if text.isalpha():
                return self._piece(text)
            return b"".join(map(self.known_pieces.__getitem__, _PIECE.findall(text)))
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return array(self.code, [t.id for p, _ in pieces for t in self.tokenize(p)]).tobytes()

    def rest(self) -> None:
        """Between tasks only the newer generation is kept."""
        self.known.before = self.known_pieces.before = None
        give_back()

    def _cut(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """Lower-case pieces of the plain chunks of all texts, the other chunks as they are, and each text's first place among them.

        A chunk is plain if it has letters, digits and marks of ASCII, and Latin-1 letters, alone: no apostrophe, and no sign
        that begins a special string.
        """
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        kind, after = self.kinds[data], np.zeros(len(data), bool)  # after: the second byte of a Latin-1 letter
        after[1:] = (data[:-1] == 0xC3) & (data[1:] & 0xC0 == 0x80) & (data[1:] & 0xDF != 0x97)
        kind[after] = _LETTER
        odd = kind == _ODD
        odd[:-1] |= (data[:-1] == 0xC3) & ~after[1:]
        low = data + ((data - 65 < 26) | after & (data < 0xA0) & (data != 0x9F)) * np.uint8(32)
        space = kind == _SPACE
        if odd.any():
            spaces, at = np.flatnonzero(space), np.flatnonzero(odd)
            end = np.unique(np.searchsorted(spaces, at))
            step = np.zeros(len(data), np.int8)
            step[np.where(end, spaces[end - 1] + 1, 0)], step[spaces[end]] = 1, -1
            whole = np.cumsum(step, dtype=np.int8).view(bool)
            kind[whole] = _ODD
            low = np.where(whole, data, low)
        first = ~space
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        kept = low[~space]
        places = np.append(np.flatnonzero(first[~space]), len(kept)).astype(np.int32)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(kept)]), np.searchsorted(np.flatnonzero(first), starts)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > CHUNKS:
            self.known = self.known.following()
        if len(self.known_pieces) > PIECES:
            self.known_pieces = self.known_pieces.following()
        pieces, starts = self._cut(texts)
        found = pieces.dictionary_encode()
        ids = pa.array(list(map(self.known.__getitem__, found.dictionary.to_numpy(zero_copy_only=False))), pa.binary()).take(found.indices)
        ends, data = (np.frombuffer(ids.buffers()[1], np.int32)[starts], memoryview(ids.buffers()[2])) if len(ids) else (starts, b"")
        return [bytes(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def id_dtype(path: str, tokenizer=None) -> str:
    if tokenizer is None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
    return "<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4"


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def small_batches(batches, rows: int = 256, size: int = 2 << 20):
    """Slices of Arrow batches: what a task holds at once depends on a few texts, not on the batch size.

    A slice has at most ``rows`` rows and ``size`` bytes, or one row. At the end what has been freed goes back to the
    system, as Spark keeps its Python workers for other tasks.
    """
    try:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                n = min(rows, batch.num_rows - at)
                while n > 1 and batch.slice(at, n).nbytes > size:
                    n = n // 2
                yield batch.slice(at, n)
                at += n
    finally:
        batch = None
        give_back()


def give_back() -> None:
    """Hand freed memory of this process back to the system, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def term_runs(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, times) of every distinct term of every document, by document and term, with one sort over all of them."""
    size, terms = [len(d) for d in docs], np.concatenate(docs) if docs else np.zeros(0, np.uint16)
    bits, kind = (16, np.uint32) if terms.dtype.itemsize == 2 and len(docs) <= 1 << 16 else (32, np.uint64)  # keys of half the size sort faster
    key = np.repeat(np.arange(len(docs), dtype=kind), size)
    key <<= kind(bits)
    key |= terms.astype(kind)
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([first, [len(key)]]))
    return (key[first] >> kind(bits)).astype(np.int64), (key[first] & kind((1 << bits) - 1)).astype(np.int64), times
