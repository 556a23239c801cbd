"""Cost-balanced packing of token streams into fixed-length training sequences.

Each document is tokenised and closed with an end id. Whole multiples of the
sequence length become sequences of their own; the remainders are collected into
blocks of bounded size. A block opens exactly as many full sequences as its tokens
fill, plus sequences whose lengths are the powers of two in the rest, so none needs
padding. Pieces are then taken in descending length and each goes to the sequence
with the lowest estimated attention cost (linear plus quadratic in piece length)
that still has room for it; only a piece that fits nowhere is cut.

Blocks are formed inside each input partition, as rows stream through, so the
operator shuffles nothing, holds one block in memory, and a lost task is simply run
again. A sequence id is (partition, number within the partition).
"""

from __future__ import annotations

import array
import heapq
import json
import re
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.common import bounded_batches

SEQUENCE = 4096
END_ID = 2
#: Tokens of remainders that one block may hold, and documents: bounds of a task's memory.
BLOCK_TOKENS = 1 << 20
BLOCK_DOCS = 4096
#: Ids that one encoder keeps for repeated words; full, it computes the others anew.
CACHE_ENTRIES = 150_000
#: Attention cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / SEQUENCE

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long, sequence_cost double"
)
_ARROW = pa.schema(
    [(n, pa.float64() if n == "sequence_cost" else pa.int64()) for n in (x.split()[0] for x in SCHEMA.split(", "))]
)


#: The normaliser and splitter that ``WordEncoder`` takes apart; a tokenizer with others is used as a whole.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def splits_at_space(path: str) -> bool:
    """Whether the tokenizer file has these rules and adds no token but special ones in angle brackets."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    added = all(re.fullmatch(r"<\|\w+\|>", t["content"]) and not t["lstrip"] and not t["rstrip"] for t in rules.get("added_tokens") or [])
    plain = rules["model"]["type"] == "BPE" and not rules["model"].get("dropout") and not rules.get("truncation") and not rules.get("padding")
    return rules.get("normalizer") == NORMALIZER and rules.get("pre_tokenizer") == SPLITTER and added and plain


class WholeEncoder:
    """Encodes text with the tokenizer as it is, whatever its rules."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class WordEncoder:
    """Encodes text as a tokenizer of these rules does, remembering the ids of white-space-separated chunks.

    The tokenizer lower-cases, drops white space and never lets a token span it, so a
    text's ids are those of its chunks in a row. Plain Latin words go straight to the
    model; every other chunk is encoded by the full tokenizer.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.entries = entries
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        self.byte_char = [chr(b) if b in printable else chr(next(spare)) for b in range(256)]
        encoder = self

        class Chunks(dict):
            def __missing__(self, chunk: str) -> bytes:
                ids = encoder._chunk(chunk)
                if len(self) < entries:
                    self[chunk] = ids
                return ids

        self.chunks = Chunks()

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            text = word if word.isascii() else "".join([self.byte_char[b] for b in word.encode()])
            ids = array.array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
            if len(self.words) < self.entries:
                self.words[word] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        stem = chunk.rstrip(self._marks)
        if not stem or stem.isalpha() and ord(max(stem)) < 0x130:  # below it lower-casing is one to one, without context
            word = (stem if stem.isascii() else unicodedata.normalize("NFC", stem)).lower()
            mark = chunk[len(stem) :]
            return (self._word(word) if word else b"") + (self._word(mark) if mark else b"")
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return array.array("I", ids).tobytes()

    _marks = ".,;:!?#$%&*|()-"  # a run of these is one token group of its own
    _odd_space = regex.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the tokenizer does not

    def encode(self, text: str) -> bytes:
        """Ids as native unsigned 32-bit integers."""
        if self._odd_space.search(text):
            return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.chunks.__getitem__, text.split()))


_ENCODERS: dict[str, WordEncoder | WholeEncoder] = {}


def encoder_of(path: str) -> WordEncoder | WholeEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path) if splits_at_space(path) else WholeEncoder(path)
    return _ENCODERS[path]


def capacities(tokens: int, length: int = SEQUENCE) -> list[int]:
    """Full sequences, then the rest as powers of two: they sum to ``tokens``, so nothing is padded."""
    full, rest = divmod(tokens, length)
    return [length] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def attention_cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def assign(lengths: list[int], length: int = SEQUENCE) -> tuple[list[tuple[int, int, int, int, int]], list[int], list[float]]:
    """Place documents of the given lengths: (document, start, length, sequence, offset), capacities, costs.

    Descending by length, ties by position. Among the open sequences, the cheapest with
    room for the whole piece is taken; if there is none, the piece is cut to the room of the
    cheapest open one and its rest takes its turn again.
    """
    rooms = capacities(sum(lengths), length)
    left, cost, out = list(rooms), [0.0] * len(rooms), []
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    open_ = [(0.0, s) for s in range(len(rooms))]
    heapq.heapify(open_)
    while waiting:
        size, doc, start = heapq.heappop(waiting)
        size, passed, chosen = -size, [], None
        while open_:
            entry = heapq.heappop(open_)
            if left[entry[1]] >= size:
                chosen = entry
                break
            passed.append(entry)
        if chosen is None:  # fits nowhere whole: the one with most room, then the cheapest
            chosen = min(passed, key=lambda e: (-left[e[1]], e))
            passed.remove(chosen)
        for entry in passed:
            heapq.heappush(open_, entry)
        s = chosen[1]
        take = min(size, left[s])
        out.append((doc, start, take, s, rooms[s] - left[s]))
        left[s] -= take
        cost[s] += attention_cost(take)
        if left[s]:
            heapq.heappush(open_, (cost[s], s))
        if take < size:
            heapq.heappush(waiting, (take - size, doc, start + take))
    return out, rooms, cost


def _packer(path: str, length: int, end_id: int):
    end = array.array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        rows: list[tuple] = []
        held: list[tuple[int | None, int, bytes, int]] = []  # doc_id, start, ids, doc_tokens
        tokens = 0

        def flush() -> None:
            nonlocal next_id, tokens
            pieces, rooms, cost = assign([len(h[2]) // 4 for h in held], length)
            for doc, start, n, s, offset in pieces:
                doc_id, base, ids, total = held[doc]
                crc = zlib.crc32(ids[4 * start : 4 * (start + n)])
                rows.append((doc_id, base + start, n, crc, total, next_id + s, offset, rooms[s], cost[s]))
            next_id += len(rooms)
            held.clear()
            tokens = 0

        def emit() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
            rows.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                total = len(ids) // 4
                whole = total // length * length
                for start in range(0, whole, length):
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, total, next_id, 0, length, attention_cost(length)))
                    next_id += 1
                if whole < total:
                    held.append((doc_id, whole, ids[4 * whole :], total))
                    tokens += total - whole
                if tokens >= BLOCK_TOKENS or len(held) >= BLOCK_DOCS:
                    flush()
                if len(rows) >= 10_000:
                    yield emit()
        flush()
        if rows:
            yield emit()

    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text), placed in sequences of at most ``length`` tokens.

    A null or empty text is the end id alone; repeated rows are packed each; a null doc_id
    stays null. Of other columns none is read. An empty table gives no pieces.
    """
    assert sys.byteorder == "little" and length & (length - 1) == 0
    bounded_batches(docs.sparkSession)
    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.mapInArrow(_packer(tokenizer_path, length, end_id), SCHEMA)
