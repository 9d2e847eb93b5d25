"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best-fit: documents arrive in the order of their partition,
at most ``open_bins`` sequences are open at a time, and the open ones are kept in
a bitset keyed by free space: bit ``f`` is set while a sequence with ``f`` free
tokens is open. A piece goes into the fullest open sequence that still takes it
(lowest set bit at or above its length); when a new sequence would exceed the
bound, the fullest open one is closed first.

Two rounds. In the first each partition packs its own rows in one pass (no shuffle,
memory bounded by the caches and the pieces of ``open_bins`` sequences), and writes a
sequence's pieces once it is closed; the pieces of those still open at its end are
marked. The first round is staged. The marked pieces, numbers without texts, make the
second: dealt by hash into tasks of about ``ROUND_PIECES`` pieces and packed there,
longest first, with room for all their sequences open, so part-filled sequences do not
grow with the number of partitions. A lost executor only repeats its partitions, with
the same result. Sequence ids carry the partition number and the round in their upper bits.

Defined cases: null text is empty; an empty document is the single end id; equal
rows are separate documents; long texts are cut into pieces and never truncated;
extra columns of the input do not matter.
"""

from __future__ import annotations

import base64
import math
import os
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import stage

SEQUENCE_TOKENS = 2048
OPEN_BINS = 1024
ROUND_PIECES = 500_000
SECOND_ROUND = 1 << 62
BATCH_ROWS = 10_000
END_ID = 0
CACHE_ENTRIES = 500_000
PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

_ENCODERS: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Remembered(dict):
    """A bounded memo: ``self[key]`` computes what is missing; emptied when full."""

    def __init__(self, compute):
        self.compute = compute

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[key] = value
        return value


class _SpaceRun(Exception):
    """A chunk that touches further white space."""


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    A byte-level BPE never joins characters across its pre-token bounds, and a
    single space between two other characters always starts a pre-token. So a
    text is cut at such spaces, and the ids of each chunk are remembered. A
    vocabulary file in rank form beside the tokenizer's own (same name, same ids)
    encodes single pre-tokens faster; without one the tokenizer itself does.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = list({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.gap = regex.compile(r"(?<=\S) (?=\S)")
        self.pretokens = regex.compile(public_tokenizers.PATTERN).findall
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        self.piece = _single_pieces(ranks) if os.path.exists(ranks) else self.direct
        self.chunk = _Remembered(self._chunk)

    def direct(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """``chunk`` is a first word or a space and what follows it up to the next space. Letters are
        one pre-token only behind a space or a letter: a sign may split off, alone or as in 's."""
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            return self.piece(chunk)
        if chunk[-1:] in ".," and chunk[1:-1].isalpha():
            return self.chunk[chunk[:-1]] + self.piece(chunk[-1])
        if len(chunk) < 2 and chunk.strip() != chunk or chunk[1:].strip() != chunk[1:]:
            raise _SpaceRun
        return self._pieces(chunk)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pretokens(text)))

    def __call__(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return self.direct(text)
        try:
            return b"".join(map(self.chunk.__getitem__, _spaced(text.split(" "))))
        except _SpaceRun:
            return b"".join(map(self._pieces, _spaced(self.gap.split(text))))


def _spaced(chunks: list[str]) -> list[str]:
    chunks[1:] = [" " + c for c in chunks[1:]]
    return chunks


def _single_pieces(ranks_path: str):
    """Pre-token -> ids as bytes, by a vocabulary of ranks."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    single = encoding._core_bpe.encode_single_piece  # no regex and no special tokens
    return lambda piece: array("I", single(piece.encode())).tobytes() if piece else b""


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class OpenBins:
    """The open sequences: a bitset over free space and, per free space, a stack of ids.
    ``closed`` lists the sequences closed since the caller last emptied it."""

    def __init__(self, capacity: int, bound: int, first_id: int):
        self.capacity, self.bound, self.next_id = capacity, bound, first_id
        self.closed: list[int] = []
        self.bits, self.count = 0, 0
        self.ids: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(sequence id, offset) of a piece of ``length`` tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.next_id
            self.next_id += 1
            if length < free and self.count >= self.bound:
                self.closed.append(self._take((self.bits & -self.bits).bit_length() - 1))  # the fullest
        left = free - length
        if left:
            self.ids[left].append(sequence)
            self.bits |= 1 << left
            self.count += 1
        else:
            self.closed.append(sequence)
        return sequence, self.capacity - free

    def _take(self, free: int) -> int:
        sequence = self.ids[free].pop()
        self.count -= 1
        if not self.ids[free]:
            self.bits &= ~(1 << free)
        return sequence


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _second_round(marked: DataFrame, capacity: int) -> DataFrame:
    """The marked pieces placed anew: best fit, longest first, over as few tasks as hold them."""
    tasks = max(1, math.ceil(marked.count() / ROUND_PIECES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, 2 * ROUND_PIECES, SECOND_ROUND + (TaskContext.get().partitionId() << 40))
        for batch in batches:
            places = [bins.place(n) for n in batch.column("length").to_pylist()]
            bins.closed.clear()
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], *[pa.array(x, pa.int64()) for x in zip(*places)]] if places else batch.columns, names=names)

    dealt = marked.repartition(tasks, "sequence_id", "offset").sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    return dealt.mapInArrow(pack, marked.schema)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = SEQUENCE_TOKENS,
                   open_bins: int = OPEN_BINS, end_id: int = END_ID, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece: where it starts in its document and where it lies in which sequence."""
    path = tokenizer_path or default_tokenizer()
    end = int(end_id).to_bytes(4, "little")
    schema = PIECES.format(id=docs.schema[id_col].dataType.simpleString()) + ", still_open boolean"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, id_type = encoder(path), pa.null()
        bins = OpenBins(capacity, open_bins, TaskContext.get().partitionId() << 40)
        held: dict[int, list[tuple]] = {}

        def table(found: list[tuple], still_open: bool) -> pa.RecordBatch:
            ids, piece, *numbers = zip(*found) if found else [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in numbers],
                 pa.array([still_open] * len(found), pa.bool_())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "still_open"])

        for batch in batches:
            id_type, out = batch.schema.field(0).type, []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for p, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    sequence, at = bins.place(n)
                    held.setdefault(sequence, []).append((doc_id, p, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), sequence, at))
                    for done in bins.closed:
                        out += held.pop(done)
                    bins.closed.clear()
            yield table(out, False)
        rest = [row for found in held.values() for row in found]
        for at in range(0, len(rest), BATCH_ROWS):
            yield table(rest[at : at + BATCH_ROWS], True)

    placed = stage(docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(pack, schema), "pack")
    done, marked = (placed.filter(which).drop("still_open") for which in ("NOT still_open", "still_open"))
    return done.unionAll(_second_round(marked, capacity))
