"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word the last token of its encoding is unique: among the vocabulary's tokens that end there (found
by a suffix automaton) it is the one that BPE never merges with the last token of the prefix before it. Back-pointers
from the whole word give the exact ids. Two tokens are tested for that by undoing their merges from the last to the first.

Missing and empty texts give no ids; repeated rows are encoded each; other columns are not read. A task keeps what it
encoded, by runs and words, up to about `CACHED_BYTES`, then starts anew: that bounds memory and changes no result.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .common import keyed_text, per_text
from .suffix_automaton import SuffixAutomaton

VOCABULARY = "word_bpe_49k.json"
LONGEST_CACHED_WORD = 64
CACHED_BYTES = 64 << 20
BATCH_BYTES = 2 << 20  # of text; its tokens take many times that while they are put together
RUN_BYTES = 150  # about what a run takes besides its characters and ids
CACHED_PAIRS = 500_000
LAST = 0x1000  # added to the last character of a word, which stands for the character with the end mark

# fixed values of the vocabulary's file format: the pieces of a text, and the end mark of a word
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPACE = regex.compile(r"\s+")
END = "</w>"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """Printable characters for the 256 bytes: Latin-1's own, and those from U+0100 on for the others, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def with_end(letters: str) -> str:
    return letters[:-1] + chr(ord(letters[-1]) + LAST)


class Encoder:
    """Encodes words of one vocabulary. Words come as strings of byte letters, the last one marked by `with_end`."""

    def __init__(self, vocabulary: dict[str, int], merges: Sequence[Sequence[str]]):
        self.text = {i: t for t, i in vocabulary.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_of: dict[int, tuple[int, int, int]] = {}  # token: rank, left part, right part
        for rank, (left, right) in enumerate(merges):
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.rank[a, b] = rank
            self.made_of.setdefault(made, (rank, a, b))
        self.pairs: dict[int, bool] = {}  # by left << 20 | right
        self.automaton = SuffixAutomaton(
            (with_end(t[: -len(END)]) if t.endswith(END) and t != END else t, i)
            for t, i in vocabulary.items() if self._reached(i))

    def _reached(self, token: int) -> bool:
        """Whether BPE ever makes this token: its two parts must still stand when their merge comes."""
        made = self.made_of.get(token)
        return made is None or self._stand(made[1], made[2], made[0])

    def _stand(self, left: int, right: int, before: float) -> bool:
        """Whether no merge of a rank below `before` joins across the border of two neighbouring tokens. Merges of one
        rank go from left to right, so one across the border comes before the equal one that made the right token."""
        while True:
            if self.rank.get((left, right), before) < before:
                return False
            l, r = self.made_of.get(left), self.made_of.get(right)
            if l is None and r is None:
                return True
            if r is None or l is not None and l[0] > r[0]:
                before, left = l[0], l[2]
            else:
                before, right = r[0] + 0.5, r[1]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get(left << 20 | right)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left << 20 | right] = self._stand(left, right, float("inf"))
        return known

    def word(self, letters: str) -> list[int]:
        pairs, compatible, step = self.pairs, self.compatible, self.automaton.walk_step
        node = self.automaton.walk_start
        end = 0
        last: list[int] = []      # of every prefix, the last token
        before: list[int] = []    # and where that token starts
        for letter in letters:
            node = node[0].get(letter) or step(node, letter)
            end += 1
            for length, token in node[1]:
                start = end - length
                if start == 0:
                    break
                left = last[start - 1]
                fits = pairs.get(left << 20 | token)
                if compatible(left, token) if fits is None else fits:
                    break
            else:
                raise ValueError(f"the vocabulary has no token for {letter!r}")
            last.append(token)
            before.append(start)
        ids = []
        while end:
            ids.append(last[end - 1])
            end = before[end - 1]
        return ids[::-1]


class Bounded(dict):
    """Computes missing entries; starts anew after so many, which bounds memory."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = found = self.compute(key)
        return found


class Codec:
    """Encodes and decodes whole texts as the vocabulary's file says: composed, lower-cased, white space dropped,
    special tokens in a text recognised; decoding joins the tokens by a space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.encoder = Encoder(model["vocab"], merges)
        self.text = self.encoder.text | {i: t for t, i in self.special.items()}
        self.bytes = {i: t.encode() for i, t in self.text.items()}
        self.letters = byte_letters()

    def word(self, word: str) -> list[int]:
        # printable ASCII stands for its own bytes
        letters = word if word.isascii() and word.isprintable() else word.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
        return self.encoder.word(with_end(letters))

    def pieces(self, run: str) -> list[str]:
        return [run] if run.isascii() and run.isalpha() else PIECES.findall(run)

    def run(self, run: str | tuple[str]) -> list[int]:
        """Ids of a run without white space, or of a special token."""
        if isinstance(run, tuple):
            return [self.special[run[0]]]
        return list(chain.from_iterable(map(self.word, self.pieces(run))))

    def forget(self) -> None:
        self.encoder.pairs.clear()

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join(map(self.text.__getitem__, ids))

    def runs(self, text: str) -> list[str | tuple[str]]:
        """The runs of a text in order; special tokens come as a tuple."""
        if self.parts is None or not any(s in text for s in self.special):
            return self.plain_runs(text)
        found: list[str | tuple[str]] = []
        for part in self.parts.split(text):
            found += [(part,)] if part in self.special else self.plain_runs(part)
        return found

    @staticmethod
    def plain_runs(text: str) -> list[str]:
        # lower-casing goes letter by letter, so a final sigma is no special case
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # str.split() also cuts at the four control characters below, which the pieces' pattern does not
        return SPACE.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def encode(self, text: str) -> tuple[list[int], str]:
        ids = list(chain.from_iterable(map(self.run, self.runs(text))))
        return ids, self.decode(ids)


class RunCache:
    """Runs that a task has met, each with its number; their ids and decoded texts lie one after the other, so that a batch
    is put together from run numbers by Arrow, without a Python object for each token."""

    def __init__(self, codec: Codec, most: int = CACHED_BYTES):
        self.codec, self.most = codec, most
        self.clear()

    def clear(self) -> None:
        self.number: dict[str | tuple[str], int] = {}
        self.ids, self.id_ends = array("i"), array("q", [0])
        self.texts, self.text_ends = bytearray(), array("q", [0])
        self.size = 0

    def add(self, run: str | tuple[str]) -> int:
        """A number for a run; of several words each has a number of its own, if it is short."""
        codec, known = self.codec, self.number
        pieces = codec.pieces(run) if isinstance(run, str) else []
        if len(pieces) < 2:
            ids = codec.word(run) if pieces == [run] else codec.run(run)
        else:
            ids = []
            for piece in pieces:
                if len(piece) > LONGEST_CACHED_WORD:
                    ids += codec.word(piece)
                else:
                    at = known.get(piece)
                    at = self.add(piece) if at is None else at
                    ids += self.ids[self.id_ends[at]:self.id_ends[at + 1]]
        self.ids.extend(ids)
        self.id_ends.append(len(self.ids))
        self.texts += b" ".join(map(codec.bytes.__getitem__, ids))
        self.text_ends.append(len(self.texts))
        self.size += RUN_BYTES + 4 * len(run) + 12 * len(ids)
        known[run] = found = len(known)
        return found

    def encode(self, texts: Sequence[str]) -> tuple[pa.Array, pa.Array]:
        """(token ids, decoded text) of every text."""
        if self.size > self.most:
            self.clear()
        known, add, numbers, ends = self.number.get, self.add, array("q"), array("q", [0])
        for text in texts:
            numbers.extend([n if (n := known(run)) is not None else add(run) for run in self.codec.runs(text)])
            ends.append(len(numbers))
        # views of the cache, not copies; they end with this call, so the cache can grow again
        runs, ends, id_ends = np.asarray(numbers), np.asarray(ends), np.asarray(self.id_ends)
        lengths = id_ends[runs + 1] - id_ends[runs]
        held = pa.ListArray.from_arrays(pa.array(id_ends, pa.int32()), pa.array(np.asarray(self.ids)))
        each = np.append(0, np.cumsum(lengths))
        ids = pa.ListArray.from_arrays(pa.array(each[ends], pa.int32()), held.take(pa.array(runs)).flatten())
        # runs without ids give no text, so they must not give a blank either
        some = lengths > 0
        places = np.append(0, np.cumsum(some))[ends]
        held = pa.Array.from_buffers(pa.large_binary(), len(self.number), [None, pa.py_buffer(self.text_ends), pa.py_buffer(self.texts)])
        parts = pa.ListArray.from_arrays(pa.array(places, pa.int32()), held.take(pa.array(runs[some])))
        return ids, pc.binary_join(parts, pa.scalar(b" ", pa.large_binary())).cast(pa.string())


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec in each Python process, for all its tasks; between them it holds no words."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


FIELDS = pa.schema([("id", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encode(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text: its id, `token_ids`, and `decoded`, the text that the ids decode to."""
    path = path or vocabulary_path()

    def make():
        used = codec(path)
        cache = RunCache(used)

        def work(ids, texts):
            return ids, *cache.encode(texts)

        work.done = used.forget
        return work

    texts = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return per_text(texts, make, FIELDS, "id long, token_ids array<int>, decoded string", BATCH_BYTES).withColumnRenamed("id", id_col)
