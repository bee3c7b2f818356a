"""Operator 10: BPE encoding and decoding by a tokenization automaton.

Compilation. The automaton reads tokens. It starts with one state that every base symbol leads back to,
and accepts any spelling. Merges are then worked in, in their order, each by one gadget: for the merge
``u v -> uv``, tokens ``u`` now lead to a copy of their state that lacks the arc ``v``, and every state
with an arc ``u`` gets an arc ``uv`` to the state behind ``v``. After the last merge exactly one path
spells a word, and its arc labels are the word's tokens. All arcs of one token lead to one state, so
states are named by tokens. A copied state shares its parent's arcs but one, and an arc made later exists
where the arc of its left half does; from these two facts the table (state, token) is filled entry by
entry when first asked for, so that compiling costs a step per merge.

Encoding. A pre-split word is read left to right; at every place the one token that ends there and whose
arc leaves the state at its beginning is kept, which gives the unique path. Words are remembered per
Python worker. Decoding emits the arc labels of the ids, as the tokenizers library does for a file
without a decoder: joined by spaces, word ends included.

The splitting rule of the file is NFC, white space as one space, lower case character by character, and
the words of its pattern; added tokens in a text are taken out first.

On Spark the texts stay where they are: one ``mapInArrow`` pass with bounded memory per worker, and a lost
executor only repeats its tasks. Defined cases: null or empty text has no ids; a null ``doc_id`` is kept;
repeated rows are encoded each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.llm.vocab import LAST_AGREED, byte_letters, remembered, tokenizer_path

WORD_BPE = "word_bpe_49k.json"
MAX_REMEMBERED = 500_000
MAX_ARCS = 2_000_000
TEXTS_A_BATCH = 512

# Unicode white space, and separators that only Python's own splitting takes for white space.
SPACES = "\t-\r \x85\xa0  -     　"
NOT_SPACES = "\x1c\x1d\x1e\x1f"


class Automaton:
    """The compiled merges of a vocabulary; a state is named by the token that leads to it.

    ``gadget[u, v]`` is the turn at which the state behind ``u`` lost its arc ``v``. The state behind
    ``uv`` is the one behind ``v`` as it stood before that turn, so it lacks what the tokens down the right
    side of ``uv`` had lost by then (``right_side``); the arc ``uv`` leaves a state if, at that turn, the arcs
    down the left side of ``uv`` did (``left_side``).
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self.label = {i: t for t, i in vocabulary.items()}
        self.size = max(vocabulary.values(), default=0) + 1
        self.longest = max(map(len, vocabulary), default=0)
        never = len(merges)
        self.gadget: dict[int, int] = {}
        self.right_side = {i: [(i, never)] for i in vocabulary.values()}
        self.left_side = {i: [(i, never)] for i in vocabulary.values()}
        reached = set(vocabulary.values()) - {vocabulary[a + b] for a, b in merges}
        self.arcs: dict[int, bool] = {}
        for turn, (left, right) in enumerate(merges):
            u, v, uv = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if not (u in reached and v in reached and self._arc(u, v)):
                continue  # earlier merges already keep this pair apart
            self.gadget[u * self.size + v] = turn
            self.right_side[uv] += [(v, turn), *self.right_side[v][1:]]
            self.left_side[uv] += [(u, turn), *self.left_side[u][1:]]
            reached.add(uv)
        self.usable = {t: i for t, i in vocabulary.items() if i in reached}

    def _arc(self, behind: int, token: int) -> bool:
        for w, lost_before in self.right_side[behind]:
            for x, made in self.left_side[token]:
                turn = self.gadget.get(w * self.size + x)
                if turn is not None and turn < lost_before and turn <= made:
                    return False
        return True

    def may_follow(self, behind: int, token: int) -> bool:
        """Whether the state behind a token has an arc labelled ``token``."""
        key = behind * self.size + token
        known = self.arcs.get(key)
        if known is None:
            known = self._arc(behind, token)
            if len(self.arcs) >= MAX_ARCS:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def path(self, symbols: list[str]) -> list[int]:
        """The tokens of a word given as base symbols (the last one with its end mark)."""
        n = len(symbols)
        find, arcs, size = self.usable.get, self.arcs, self.size
        last = [-1] * (n + 1)
        begin = [0] * (n + 1)
        for end in range(1, n + 1):
            text = ""
            for at in range(end - 1, -1, -1):
                text = symbols[at] + text
                token = find(text)
                if token is not None:
                    before = last[at]
                    if at == 0:
                        ok = True
                    elif before < 0:
                        ok = False
                    else:
                        ok = arcs.get(before * size + token)
                        if ok is None:
                            ok = self.may_follow(before, token)
                    if ok:
                        last[end], begin[end] = token, at
                        break
                if len(text) > self.longest:
                    break
        out = []
        at = n
        while at > 0:
            if last[at] < 0:
                raise ValueError(f"no path spells {symbols}")
            out.append(last[at])
            at = begin[at]
        return out[::-1]


class Pieces(dict):
    """Runs of characters without white space -> their ids as bytes and their labels."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> tuple[bytes, str]:
        got = self.make(piece)
        if len(self) < MAX_REMEMBERED:
            self[piece] = got
        return got


class WordEncoder:
    """Texts to ids and back, for a file with word ends and no decoder."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton.label |= {i: t for t, i in self.added.items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.cut = regex.compile(f"[{SPACES}]+")
        self.find_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.letters = byte_letters()
        self.known_words: dict[str, list[int]] = {}
        self.pieces = Pieces(self._piece)

    def word(self, word: str) -> list[int]:
        """Tokens of a word, given in the letters that stand for its bytes."""
        ids = self.known_words.get(word)
        if ids is None:
            symbols = list(word)
            symbols[-1] += self.suffix
            ids = self.automaton.path(symbols)
            if len(self.known_words) < MAX_REMEMBERED:
                self.known_words[word] = ids
        return ids

    def _split(self, piece: str) -> list[str]:
        """Words of a run of characters without white space, in the letters of their bytes."""
        if piece.isascii() and piece.isprintable():
            return self.words.findall(piece.lower())
        if max(piece) >= LAST_AGREED:  # character classes as the library's version of Unicode has them
            return [w for w, _ in self.split(self.normalize(piece))]
        folded = "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
        return ["".join([self.letters[b] for b in w.encode()]) for w in self.words.findall(folded)]

    def _piece(self, piece: str) -> tuple[bytes, str]:
        ids = [i for w in self._split(piece) for i in self.word(w)]
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        label = self.automaton.label
        return " ".join([label[i] for i in ids])

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        odd = any(ch in text for ch in NOT_SPACES)
        pieces = filter(None, self.cut.split(text)) if odd else text.split()
        return list(map(self.pieces.__getitem__, pieces))

    def text(self, text: str | None) -> tuple[bytes, str]:
        """Ids of a whole text as little-endian uint32 bytes, and its decoded form."""
        if not text:
            return b"", ""
        if self.find_added and any(a in text for a in self.added):
            got = []
            for part in self.find_added.split(text):
                if part in self.added:
                    got.append((struct.pack("<I", self.added[part]), part))
                else:
                    got += self._plain(part)
        else:
            got = self._plain(text)
        got = [g for g in got if g[0]]
        return b"".join(g[0] for g in got), " ".join(g[1] for g in got)


def word_encoder(name: str) -> WordEncoder:
    path = tokenizer_path(name)
    return remembered("word encoder", path, lambda: WordEncoder(path))


ENCODED = "doc_id long, ids binary, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digests(vocabulary: str):
    def run(batches):
        encode = word_encoder(vocabulary).text
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_A_BATCH):
                some = batch.slice(at, TEXTS_A_BATCH)
                done = [encode(t) for t in some.column(1).to_pylist()]
                sha = hashlib.sha256
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(ids) // 4 for ids, _ in done], pa.int64()),
                     pa.array([sha(ids).hexdigest() for ids, _ in done], pa.string()),
                     pa.array([sha(text.encode()).hexdigest() for _, text in done], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded(vocabulary: str):
    def run(batches):
        encode = word_encoder(vocabulary).text
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_A_BATCH):
                some = batch.slice(at, TEXTS_A_BATCH)
                done = [encode(t) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([ids for ids, _ in done], pa.binary()),
                     pa.array([text for _, text in done], pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, vocabulary: str = WORD_BPE) -> DataFrame:
    """Per document its ids (little-endian uint32 bytes) and its decoded text."""
    return _texts(docs).mapInArrow(_encoded(vocabulary), ENCODED)


def digests(docs: DataFrame, vocabulary: str = WORD_BPE) -> DataFrame:
    """Per document the number of ids, and SHA-256 of the ids and of the decoded text."""
    return _texts(docs).mapInArrow(_digests(vocabulary), DIGESTS)
