"""Exact ids of whole texts from the ``tokenizers`` library, each distinct piece of text encoded once.

The library encodes about 1 MB/s on a core here, mostly in bookkeeping. Both vocabularies split a text into
pieces that never cross from a non-space to a space, and no rule looks back, so a text's ids are those of its
chunks (a run of ASCII white space and the non-space run after it) in order. A worker keeps the ids of chunks it
has seen. A new chunk of plain characters is split by the vocabulary's own pattern and only pieces not seen yet
go to the library's model; a chunk with any other character goes to the library whole, and so does a text with
control characters or white space outside ASCII. Where white space is kept, a text's new words go to the
model in one call, as no merge crosses the space that each starts with, and a single line feed is a piece of its own.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex

#: Entries a worker keeps of chunks and of pieces; about 250 bytes each; of either, two generations.
CHUNK_ENTRIES, PIECE_ENTRIES = 300_000, 400_000
_CHUNK = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+\Z")
#: Without these, a space is never followed by white space.
_SPACE_RUNS = ("  ", " \t", " \n", " \r", " \x0b", " \x0c")
_LINE_RUNS = ("\n\n", "\n ", "\n\t", "\n\r", "\n\x0b", "\n\x0c", "\t\n", "\r\n", "\x0b\n", "\x0c\n")
#: New words that are taken together.
MANY_WORDS = 64
_SPACE = chr(288)
#: Letters here are stable under NFC and have the same lower case everywhere.
_PLAIN = re.compile("[\\x21-\\x7e\u00c0-\u012f\u0131-\u024f]+", re.ASCII)
_ODD = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\xa0\u0300-\u036f\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
# The split patterns of the two public vocabularies, and the bytes that byte-level vocabularies show as themselves.
_LOWER_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPACE_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b for b in _SHOWN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Recent(dict):
    """What was learnt lately, where ``learn`` gives anything: two generations of entries, of which the older one goes when the newer one is full."""

    def __init__(self, learn, limit: int) -> None:
        super().__init__()
        self.learn, self.limit, self.older = learn, limit, {}

    def __missing__(self, key: str) -> bytes:
        got = self.older.get(key)
        if got is None:
            got = self.learn(key)
            if got is None:
                return b""
        self.keep(key, got)
        return got

    def keep(self, key: str, got: bytes) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = got


class ChunkEncoder:
    """``encode(texts)`` gives, for each text, its ids as bytes (unsigned 32-bit, little-endian).

    ``drops_space``: the vocabulary that lower-cases and drops white space, else the one that keeps it."""

    def __init__(self, path: str, drops_space: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # strings of special tokens in a text are these tokens, as in a plain call: such a text goes to the library whole
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.drops_space = drops_space
        self.odd = False
        self.chunks = Recent(self._learn, CHUNK_ENTRIES)
        self.pieces = Recent(self._piece, PIECE_ENTRIES)
        # tokens that start with a space; none that plain words can make may hold one further on: they have no byte 0xC2
        # (shown as itself), which begins a no-break space, and no two spaces in a row
        shown = self.library.get_vocab()
        self.starts = np.zeros(max(shown.values(), default=0) + 1, bool)
        self.starts[[i for t, i in shown.items() if t[0] == _SPACE]] = True
        self.apart = not drops_space and not any(_SPACE in t[1:] and t.strip(_SPACE) and chr(0xC2) not in t for t in shown)
        # words learnt together are not kept as pieces too
        self.spaced = Recent(self._learn_part, CHUNK_ENTRIES + (PIECE_ENTRIES // 2 if self.apart else 0))
        self.marks = {x: self.pieces[x] for x in ".,!|:;"}

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _learn_words(self, new: set[str]) -> None:
        """Keeps the ids of those of the parts that are plain words, a mark behind them or not, as they are after a space."""
        spaced, known, marks = self.spaced, self.spaced.older, self.marks
        new = [w for w in new if w and w not in known]
        plain = lambda w: w.isalpha() and (w.isascii() or _PLAIN.fullmatch(w))
        marked = [w for w in new if w[-1] in marks and plain(w[:-1])]
        words = {w for w in new if plain(w)}
        words.update([w[:-1] for w in marked if w[:-1] not in spaced and w[:-1] not in known])
        words = list(words)
        for k in range(0, len(words), MANY_WORDS):
            some = words[k : k + MANY_WORDS]
            joined = " " + " ".join(some)
            ids = np.array([t.id for t in self.model.tokenize(joined.encode().decode("latin-1").translate(_BYTE_CHARS))], "<u4")
            ends = np.flatnonzero(self.starts[ids]) * 4
            data, ends = ids.tobytes(), [*ends.tolist(), len(ids) * 4]
            for i, w in enumerate(some):
                spaced.keep(w, data[ends[i] : ends[i + 1]])
        for w in marked:
            spaced.keep(w, spaced[w[:-1]] + marks[w[-1]])

    def _learn_part(self, part: str) -> bytes | None:
        """What a space or, at its start, a line feed parts from what is before it."""
        if part[:1] != "\n" or not self.apart:
            return self._learn(" " + part)
        rest = self._learn(part[1:]) if part[1:] else b""
        return None if rest is None else self.pieces["\n"] + rest

    def _learn(self, chunk: str) -> bytes | None:
        bare = chunk.strip(" \t\n\r\x0b\x0c")
        if not _PLAIN.fullmatch(bare):
            if _ODD.search(chunk):
                self.odd = True
                return None
            return self._whole(chunk)
        pieces = self.pieces
        own = chunk.lower() if self.drops_space else chunk
        if bare == (chunk[1:] if chunk[0] == " " else chunk):  # the common forms: a word, a word and a mark
            if bare.isalpha():
                return pieces[own]
            if bare[-1] in ".,!|:;" and bare[:-1].isalpha():
                return pieces[own[:-1]] + pieces[own[-1]]
        split = _LOWER_PATTERN if self.drops_space else _SPACE_PATTERN
        return b"".join([pieces[p] for p in split.findall(own)])

    def _spaced_parts(self, first: str, parts: list[str]) -> bytes:
        found = list(map(self.spaced.get, parts))
        if None in found:
            if self.apart:
                self._learn_words({w for w, got in zip(parts, found, strict=True) if got is None})
            spaced = self.spaced
            found = [spaced[w] if got is None else got for w, got in zip(parts, found, strict=True)]
        return self.chunks[first] + b"".join(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            self.odd = False
            if any(x in text for x in self.special):
                out.append(self._whole(text))
                continue
            if self.drops_space:
                found = b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))
            elif any(x in text for x in _SPACE_RUNS):
                found = b"".join(map(self.chunks.__getitem__, _CHUNK.findall(text)))
            else:  # each space starts a chunk, and so does a line feed alone
                first, *rest = (text if not self.apart or any(x in text for x in _LINE_RUNS) else text.replace("\n", " \n")).split(" ")
                found = self._spaced_parts(first, rest)
            out.append(self._whole(text) if self.odd else found)
        return out


_encoders: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, drops_space: bool) -> ChunkEncoder:
    if (path, drops_space) not in _encoders:
        _encoders[path, drops_space] = ChunkEncoder(path, drops_space)
    return _encoders[path, drops_space]


def small_batches(batches: Iterable[pa.RecordBatch], column: int = 1, max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``max_bytes`` of the text in ``column`` (or of one row)."""
    for batch in batches:
        sizes = np.cumsum([len(x) if (x := v.as_buffer()) else 0 for v in batch.column(column)]) if batch.num_rows else []
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def encoded(batch: pa.RecordBatch, path: str, drops_space: bool, end_id: int | None, column: int = 1) -> list[bytes]:
    texts = ["" if t is None else t for t in batch.column(column).to_pylist()]
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    return [x + tail for x in encoder(path, drops_space).encode(texts)]
