"""Ids of whole texts under a byte-level BPE file of the tokenizers library.

The file's splitting rule never carries a token across a single space between two other
characters: the space opens the next token. So texts are cut at their single spaces, every distinct
piece is encoded once by the library and remembered, and the ids of a text are the remembered ids
in a row. Arrow cuts the texts of a call and numbers their distinct pieces, so that a piece is looked
up once a call, and the ids are laid out by array arithmetic. A piece of letters is one word of the
splitting rule and goes straight to the library's BPE model; letters with closing punctuation are two
words; a line feed between two other characters is a word of its own, so texts are cut before it as
well; any other piece is encoded by the whole tokenizer. Texts where a space stands beside other white space, or which name an added
token, are encoded by the library as they are. The ids equal ``Tokenizer.encode``.
"""

from __future__ import annotations

import string
import sys
import types
from array import array
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
MAX_REMEMBERED = 1_000_000
MAX_MARKS = 10_000
BYTES_A_CALL = 3 << 20  # of texts whose distinct pieces are numbered together: some 50 MB

# Below this character (Latin to Cyrillic) all versions of Unicode in use have the same letters.
LAST_AGREED = "԰"
_ID = attrgetter("id")


def tokenizer_path(name: str) -> str:
    """A file's place: ``name`` itself if it is a path, else the installed public file."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def remembered(kind: str, key, make):
    """``make()``, kept for this Python worker's next tasks (Spark reuses workers)."""
    store = sys.modules.setdefault("_reshift_llm_kept", types.ModuleType("_reshift_llm_kept")).__dict__
    if (kind, key) not in store:
        store[kind, key] = make()
    return store[kind, key]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others are numbered from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    letter = {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


def _raw(ids) -> bytes:
    return array("I", ids).tobytes()


class PieceIds(dict):
    """Piece of a text -> its ids as little-endian uint32 bytes, learnt on first sight; None for an odd piece.

    An odd piece depends on its neighbours: its text is encoded as a whole.
    """

    def __init__(self, library, added: list[str], opening: str, first: PieceIds | None = None):
        super().__init__()
        self.library, self.added, self.opening = library, added, opening
        self.first = self if first is None else first  # of pieces that no space opens
        self.model = library.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.space = self._letters(opening)
        self.known_marks: dict[str, bytes] = {}

    def _letters(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.letters)

    def _word(self, word: str) -> bytes:
        return _raw(map(_ID, self.model(word)))

    def marks(self, word: str) -> bytes:
        """Of a word without letters that no space opens; few differ."""
        if word not in self.known_marks:
            ids = self._word(self._letters(word))
            if len(self.known_marks) >= MAX_MARKS:
                return ids
            self.known_marks[word] = ids
        return self.known_marks[word]

    def __missing__(self, piece: str) -> bytes | None:
        if piece.isalpha() and (piece.isascii() or max(piece) < LAST_AGREED):
            ids = self._word(self.space + (piece if piece.isascii() else self._letters(piece)))
        elif (letters := piece.rstrip(string.punctuation)).isalpha() and (piece.isascii() or max(piece) < LAST_AGREED):
            ids = self[letters] + self.marks(piece[len(letters):])
        elif piece[:1] == "\n" and len(piece) > 1:
            ids = self.first[piece[1:]]
            if ids is None:
                return None
            ids = self.marks("\n") + ids
        elif not piece or piece[0].isspace() or piece[-1].isspace() or any(a in piece for a in self.added):
            return None
        else:
            ids = _raw(self.library.encode(self.opening + piece, add_special_tokens=False).ids)
        if len(self) < MAX_REMEMBERED:  # frequent pieces come early; the rest is encoded again
            self[piece] = ids
        return ids


class Encoder:
    """``encode(texts)``: for each text (None: empty) its ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.first = PieceIds(self.library, added, "")
        self.later = PieceIds(self.library, added, " ", self.first)
        self.first[""] = b""

    def whole(self, text: str) -> bytes:
        return _raw(self.library.encode(text, add_special_tokens=False).ids)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
        """Where each text's pieces begin, for every piece its place among the distinct ones, and their ids."""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        heads, pieces = cut.offsets.to_numpy()[:-1], cut.flatten()
        later = np.ones(len(pieces), bool)
        later[heads] = False
        numbered = pieces.filter(pa.array(later)).dictionary_encode()
        place = np.empty(len(pieces), np.int32)  # the texts' first pieces come behind
        place[later] = numbered.indices.to_numpy()
        place[heads] = np.arange(len(heads), dtype=np.int32) + len(numbered.dictionary)
        raws = [*map(self.later.__getitem__, _strings(numbered.dictionary)),
                *map(self.first.__getitem__, _strings(pieces.take(pa.array(heads))))]
        return heads, place, raws

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        texts = texts.cast(pa.large_string())
        heads, place, raws = self._cut(texts)
        odd = [at for at, raw in enumerate(raws) if raw is None]
        for at in odd:
            raws[at] = b""
        source = np.frombuffer(b"".join(raws), "<u4")
        lengths = np.fromiter(map(len, raws), np.int32, len(raws)) >> 2
        begins = np.cumsum(lengths, dtype=np.int32) - lengths
        sizes = lengths.take(place)
        ends = np.cumsum(sizes)
        which = np.repeat((begins.take(place) - ends + sizes).astype(np.int32), sizes)
        which += np.arange(len(which), dtype=np.int32)
        ids = source.take(which, mode="clip").tobytes()
        bounds = [0, *(4 * ends[[*(heads[1:] - 1), len(place) - 1]]).tolist()]
        out = [ids[begin:end] for begin, end in zip(bounds, bounds[1:])]
        if odd:
            for row in np.flatnonzero(np.logical_or.reduceat(np.isin(place, odd), heads)).tolist():
                out[row] = self.whole(texts[row].as_py())
        return out


def _strings(pieces: pa.Array) -> list[str]:
    return pieces.to_numpy(zero_copy_only=False).tolist()


def encoder(name: str) -> Encoder:
    path = tokenizer_path(name)
    return remembered("encoder", path, lambda: Encoder(path))
