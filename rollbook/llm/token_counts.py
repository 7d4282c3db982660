"""Token counts of whole texts without token ids.

Texts are cut into pre-tokens. Documents are taken in blocks of about `BLOCK_BYTES` of text; a block is one row that holds its
distinct pre-tokens once and, for every document, the frequencies of its pre-tokens by their place in that list. All
blocks' pre-tokens are brought together by Spark, sorted, so that each distinct one is counted once; the counts go back to
their blocks in a join. A frequent pre-token is shuffled once a block, not once a document, so no key is hot. A document's count is
the sum of frequency times count. A pre-token's tokens are counted by dynamic programming over its prefixes (see `bpe`): each prefix keeps its
last token and the number of tokens, no list of ids.

Missing and empty texts have no tokens; repeated rows and ids, also missing ones, give a row each; other columns are not read.
Special strings of the vocabulary in a text are one token each. Texts with letters or digits that the tokenizer library does
not know as such (its Unicode tables are older than those here) are cut by the library itself. A text is never cut: one longer than a block is a block.
"""

from __future__ import annotations

import json
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .bpe import Encoder, byte_letters, vocabulary_path
from .common import keyed_text, small_batches, written

VOCABULARY = "byte_bpe_50k.json"
BLOCK_BYTES = 16 << 20
BLOCK_TEXTS = 1 << 16
HELD_COUNTS = 1 << 20

# fixed values: white space and the pattern of pre-tokens of byte-level vocabularies
WHITE = r"\t-\r\x20\x85\xa0  -     　"
PRE_TOKENS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def disputed(library) -> set[str]:
    """Letters and digits that the tokenizer library, whose tables are older, does not take for such."""
    found = set()
    for kind, known in ((r"\p{L}", "a"), (r"\p{N}", "1")):
        marks = regex.findall(kind, "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
        # between known letters (digits) all of the kind make one piece; another sign stands alone
        pieces = library.pre_tokenize_str(known + "".join(m + known for m in marks))
        found.update(marks[start // 2] for _, (start, end) in pieces if end - start == 1 and start % 2)
    return found


class Vocabulary:
    """What a vocabulary file says: special strings, and tokens with their merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.special = [t["content"] for t in said["added_tokens"]]
        self.parts = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.model = said["model"]
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.disputed = disputed(self.library)

    def cut(self, text: str) -> list[str]:
        if text.isascii() or self.disputed.isdisjoint(text):
            return PRE_TOKENS.findall(text)
        return [text[start:end] for _, (start, end) in self.library.pre_tokenize_str(text)]

    def pre_tokens(self, text: str) -> tuple[Counter, int]:
        """The frequencies of a text's pre-tokens, and how many special strings it has."""
        if not any(s in text for s in self.special):
            return Counter(self.cut(text)), 0
        parts = self.parts.split(text)
        found: Counter = Counter()
        for part in parts:
            found.update(self.cut(part))
        return found, len(parts) - 1


class PieceCounter:
    """Counts the tokens of pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        merges = [m.split(" ") if isinstance(m, str) else m for m in vocabulary.model["merges"]]
        self.encoder = Encoder(vocabulary.model["vocab"], merges)
        self.letters = byte_letters()

    def count(self, piece: str) -> int:
        letters = piece.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
        encoder, node = self.encoder, self.encoder.automaton.walk_start
        last: list[int] = []   # of every prefix, the last token
        tokens = [0]           # and the number of tokens
        for end, letter in enumerate(letters, 1):
            node = node[0].get(letter) or encoder.automaton.walk_step(node, letter)
            for length, token in node[1]:
                start = end - length
                if start == 0 or encoder.compatible(last[start - 1], token):
                    break
            else:
                raise ValueError(f"the vocabulary has no token for {letter!r}")
            last.append(token)
            tokens.append(tokens[start] + 1)
        return tokens[-1]


_vocabularies: dict[str, Vocabulary] = {}
_counters: dict[str, PieceCounter] = {}


def vocabulary(path: str) -> Vocabulary:
    """One in each Python process, for all its tasks."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def counter(path: str) -> PieceCounter:
    if path not in _counters:
        _counters[path] = PieceCounter(vocabulary(path))
    return _counters[path]


def packed(values: np.ndarray) -> bytes:
    """Integers by their bytes, all lowest ones first, and compressed: most of the higher ones are zero."""
    return pa.compress(values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    held = pa.decompress(data, 4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(held, np.uint8).reshape(4, n).T.copy().view("<i4").ravel()


BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("bytes", pa.list_(pa.int64())), ("special", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                   ("places", pa.binary()), ("frequencies", pa.binary()), ("pieces", pa.list_(pa.string()))])
BLOCK_DDL = "ids array<long>, bytes array<long>, special array<long>, ends array<long>, places binary, frequencies binary, pieces array<string>"


class Block:
    """Documents of about `BLOCK_BYTES` of text: their distinct pre-tokens, and each one's frequencies by place in them."""

    def __init__(self):
        self.ids, self.bytes, self.special, self.ends = [], [], [], []
        self.places, self.frequencies = array("i"), array("i")
        self.index: dict[str, int] = {}

    def add(self, key: int | None, n_bytes: int, special: int, found: Counter) -> None:
        self.ids.append(key)
        self.bytes.append(n_bytes)
        self.special.append(special)
        index = self.index
        self.places.extend([index.setdefault(piece, len(index)) for piece in found])
        self.frequencies.extend(found.values())
        self.ends.append(len(self.places))

    def row(self) -> pa.RecordBatch:
        places = np.array(self.places, np.int64)
        owner = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        order = np.argsort(owner * max(len(self.index), 1) + places)  # within each document ascending, so that steps are small
        values = [self.ids, self.bytes, self.special, self.ends, packed(np.diff(places[order], prepend=0)),
                  packed(np.array(self.frequencies, np.int64)[order]), list(self.index)]
        return pa.record_batch([pa.array([v], type=f.type) for v, f in zip(values, BLOCK)], schema=BLOCK)


def _blocks(path: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        block, size = Block(), 0
        for batch in small_batches(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, special = words.pre_tokens(text)
                n_bytes = len(text.encode("utf-8", "replace"))
                block.add(key, n_bytes, special, found)
                size += n_bytes
                if size >= block_bytes or len(block.ids) >= BLOCK_TEXTS:
                    yield block.row()
                    block, size = Block(), 0
        if block.ids:
            yield block.row()

    return run


COUNTED = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("places", pa.binary()), ("tokens", pa.binary())])


def _counted(path: str):
    """Rows come sorted by pre-token, so that each distinct one is counted once. Counts go back by block, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        known, tokens = None, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            block, place, n = map(np.concatenate, zip(*held))
            order = np.lexsort((place, block))
            block, place, n = block[order], place[order], n[order]
            starts = np.flatnonzero(np.append(True, np.diff(block) != 0))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
                row = [int(block[start])], [end - start], [packed(np.diff(place[start:end], prepend=0))], [packed(n[start:end])]
                yield pa.record_batch([pa.array(v, type=f.type) for v, f in zip(row, COUNTED)], schema=COUNTED)
            held.clear()

        size = 0
        for batch in small_batches(batches):
            found = np.empty(batch.num_rows, np.int64)
            for i, piece in enumerate(batch.column(2).to_pylist()):
                if piece != known:
                    known, tokens = piece, count(piece)
                found[i] = tokens
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), found))
            size += batch.num_rows
            if size >= HELD_COUNTS:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return run


SUMS = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, n_bytes, special, ends = (c[i].values for c in batch.columns[:4])
            places, frequencies, counted = (c[i].as_py() for c in batch.columns[4:])
            counted = counted or []
            ends = ends.to_numpy()
            tokens = np.zeros(sum(c["n"] for c in counted), np.int64)
            for c in counted:
                tokens[np.cumsum(unpacked(c["places"], c["n"]))] = unpacked(c["tokens"], c["n"])
            each = np.zeros(ends[-1] + 1, np.int64)
            np.cumsum(tokens[np.cumsum(unpacked(places, ends[-1]))] * unpacked(frequencies, ends[-1]), out=each[1:])
            sums = np.diff(each[ends], prepend=0) + special.to_numpy()
            yield pa.record_batch([ids, n_bytes, pa.array(sums)], schema=SUMS)


def count_tokens(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each text: its id, `n_bytes` in UTF-8 and `n_tokens`."""
    path = path or vocabulary_path(VOCABULARY)
    texts = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    blocks = texts.mapInArrow(_blocks(path, block_bytes), BLOCK_DDL).withColumn("block", F.monotonically_increasing_id())
    blocks = written(blocks, "token-blocks")
    pieces = blocks.select("block", F.posexplode("pieces").alias("place", "piece")).repartition("piece").sortWithinPartitions("piece")
    counted = pieces.mapInArrow(_counted(path), "block long, n int, places binary, tokens binary")
    lists = counted.groupBy("block").agg(F.collect_list(F.struct("n", "places", "tokens")).alias("counted"))
    whole = blocks.drop("pieces").join(lists, "block", "left")  # a block without any pre-token has no counts
    return whole.select(*BLOCK.names[:-1], "counted").mapInArrow(_summed, "id long, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
