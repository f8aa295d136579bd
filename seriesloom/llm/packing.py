"""Packing examples into training sequences: vector bin packing with the dot-product heuristic.

A sequence is a bin with three limits: tokens, segments and loss-bearing tokens. The bin at hand takes
the example that fits and whose demand has the largest dot product with the room left, each dimension
weighed by its mean demand, so the scarce dimension decides. Examples are packed in lots of bounded size
where they lie; a lot leaves one sequence or so unfilled. Where loss tokens equal tokens and segments are
far from their limit, as for plain documents, the heuristic comes down to the longest example that fits.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from seriesloom.llm.common import batches, ship
from seriesloom.llm.words import BYTE_VALUES, run_hashes, mixed

ship(__name__)

#: A lot is packed on its own: rows and filled sequences it holds at most, about, and rows looked at in a step.
LOT_ROWS, LOT_SEQUENCES, LOT_STEP = 16384, 512, 256
#: Spark's row ids hold the number of the row in its partition in so many bits.
PARTITION_BITS = 33
WORDS_KEPT = 1_000_000
BATCH_BYTES = 1 << 21
PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, ODD, dtype=np.uint8)
    kinds[33:127] = MARK
    kinds[48:58] = DIGIT
    kinds[65:91] = kinds[97:123] = LETTER
    kinds[[ord("'"), ord("<")]] = ODD
    kinds[[32, 9, 10, 11, 12, 13]] = BLANK
    return kinds


BLANK, LETTER, DIGIT, MARK, ODD = range(5)
KIND = _byte_kinds()
# Byte-level vocabularies write a byte as a character: itself if it shows, else one from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
WRITTEN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)}
SMALL_VALUES = BYTE_VALUES.copy()
SMALL_VALUES[65:91] = BYTE_VALUES[97:123]


def chunk_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte, end and kind of the chunks that can be tokenised on their own.

    White space, and the change between letters, marks and single digits, end a token of the vocabulary
    this is for, and capitals count as small letters. That is used for words of ASCII and of the accented
    letters of Latin-1. A word with anything else is one chunk: other characters may combine, an
    apostrophe belongs to what follows, and ``<`` may begin a special token.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    kinds = KIND[raw]
    # U+00C0 to U+00FF but for the signs of multiplication and division: C3 and one more byte.
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    after = raw[lead + 1]
    lead = lead[(after != 0x97) & (after != 0xB7)]
    kinds[lead] = kinds[lead + 1] = LETTER
    blank = kinds == BLANK
    begins = ~blank & np.concatenate([[True], blank[:-1]])
    words = np.flatnonzero(begins)
    if not len(words):
        return np.zeros(0, dtype=np.uint64), words, words, kinds[:0]
    values = SMALL_VALUES[raw]
    odd = np.flatnonzero(kinds == ODD)
    if len(odd):
        ends = np.append(words[1:], len(raw))
        for w in np.unique(np.searchsorted(words, odd, side="right") - 1).tolist():
            span = slice(words[w], ends[w])
            values[span] = BYTE_VALUES[raw[span]] * ~blank[span]
            kinds[span] = np.where(blank[span], BLANK, ODD)
    changes = (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    begins[1:] |= ~blank[1:] & changes
    starts = np.flatnonzero(begins)
    last = np.flatnonzero(~blank & np.concatenate([changes, [True]]))
    # Odd chunks have hashes of their own: their capitals stand.
    hashes = run_hashes(values[starts[0] :], starts - starts[0])
    kinds = kinds[starts]
    return np.where(kinds == ODD, mixed(hashes + np.uint64(1)), hashes), starts, last + 1, kinds


class WordIds:
    """Token ids by chunk of text, each chunk tokenised once while it stays in the table.

    Chunks are known by 64-bit hashes. The table starts anew at ``WORDS_KEPT`` chunks, which bounds
    its memory.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.starts, self.lengths = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _ids(self, chunk: bytes, odd: bool) -> list[int]:
        """A plain chunk is one word to the model and skips the tokenizer's splitting."""
        if odd:
            return self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
        if chunk.isascii():
            return [t.id for t in self.model.tokenize(chunk.lower().decode())]
        return [t.id for t in self.model.tokenize(chunk.decode().lower().encode().decode("latin-1").translate(WRITTEN))]

    def _learn(self, at: np.ndarray, hashes: np.ndarray, chunks: list[tuple[bytes, bool]]) -> None:
        """Adds chunks; ``at`` is where their hashes belong in the order of the known ones."""
        encoded = [self._ids(*c) for c in chunks]
        lengths = np.array([len(e) for e in encoded], dtype=np.int64)
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(encoded), dtype=np.uint32)])
        self.known = np.insert(self.known, at, hashes)
        self.starts, self.lengths = np.insert(self.starts, at, starts), np.insert(self.lengths, at, lengths)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        data = b" ".join(texts)
        hashes, firsts, lasts, kinds = chunk_hashes(data)
        if not len(hashes):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        if len(self.known) > WORDS_KEPT:
            self.clear()
        distinct, example, chunk = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            of = example[new]
            spans = zip(firsts[of].tolist(), lasts[of].tolist(), (kinds[of] == ODD).tolist())
            self._learn(at[new], distinct[new], [(data[a:b], odd) for a, b, odd in spans])
            at = np.searchsorted(self.known, distinct)
        starts, lengths = self.starts[at][chunk], self.lengths[at][chunk]
        behind = np.cumsum(lengths)
        ids = self.ids[np.arange(behind[-1]) + np.repeat(starts - behind + lengths, lengths)]
        ends = np.searchsorted(firsts, np.cumsum([len(t) + 1 for t in texts]))
        return ids, np.diff(np.concatenate([[0], behind])[ends], prepend=0)


def word_ids(path: str) -> WordIds:
    """The table of this worker process, so that its later tasks find the words of the earlier ones."""
    tables = sys.modules.setdefault("_seriesloom_word_ids", ModuleType("_seriesloom_word_ids")).__dict__
    if path not in tables:
        tables[path] = WordIds(path)
    return tables[path]


def piece_batches(tables: Iterator[pa.RecordBatch], key: str, tokenizer: str, limit: int, end_id: int, ids: bool) -> Iterator[pa.RecordBatch]:
    """The pieces of the texts in batches whose first columns are key and text."""
    words = word_ids(tokenizer)
    for batch in tables:
        table = pa.table([batch.column(0), batch.column(1).cast(pa.large_binary())], names=["key", "text"])
        for a, b in batches(table, BATCH_BYTES, "text"):
            some = table.slice(a, b - a)
            of, starts, lengths, sums, totals, values = [], [], [], [], [], []
            every, counts = words.encode([t or b"" for t in some.column("text").to_pylist()])
            for i, encoded in enumerate(np.split(every, np.cumsum(counts)[:-1])):
                found = np.append(encoded, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(found), limit):
                    piece = found[start : start + limit]
                    of.append(i)
                    starts.append(start)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(found))
                    if ids:
                        values.append(piece.astype(np.int32))
            keys = some.column("key").combine_chunks().take(pa.array(of, pa.int64()))
            columns = [keys, *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
            if ids:
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values))))
            yield pa.RecordBatch.from_arrays(columns, names=[key, "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(columns)])


def tokenised_pieces(docs: DataFrame, key: str, text: str, tokenizer: str, limit: int, end_id: int, ids: bool = True) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of at most ``limit`` ids.

    Columns: ``key``, ``start`` (ids before the piece), ``length``, ``ids_crc32``, ``doc_tokens`` and,
    if ``ids``, the piece's ``ids``. Null and empty texts are ``end_id`` alone; other columns are left
    out; ``tokenizer`` is the path of a vocabulary file that every executor has.
    """

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return piece_batches(tables, key, tokenizer, limit, end_id, ids)

    return docs.select(key, text).mapInArrow(run, piece_schema(docs, key, ids))


def piece_schema(docs: DataFrame, key: str, ids: bool) -> str:
    """Columns of the pieces of ``docs``."""
    return f"`{key}` {docs.schema[key].dataType.simpleString()}, {PIECE}" + ", ids array<int>" * ids


def fill_bins(demands: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and order in the bin of each row of ``demands`` (rows by dimensions).

    Examples of equal demand are interchangeable, so the heuristic looks at distinct demands only. No
    demand may exceed a limit.
    """
    kinds, kind_of, counts = np.unique(demands, axis=0, return_inverse=True, return_counts=True)
    kind_of = kind_of.reshape(-1)
    members = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(counts)[:-1])
    shares = kinds / limits
    weighed = shares * (counts @ shares / counts.sum())
    left = counts.copy()
    bins, order = np.empty(len(demands), dtype=np.int64), np.empty(len(demands), dtype=np.int64)
    number, open_kinds = 0, np.arange(len(kinds))
    while len(open_kinds):
        room, placed = limits.astype(np.float64).copy(), 0
        fits = open_kinds
        while len(fits):
            best = fits[np.argmax(weighed[fits] @ (room / limits))]
            again = int(min(left[best], 1))
            row = members[best][left[best] - 1]
            bins[row], order[row] = number, placed
            left[best] -= again
            placed += 1
            room = room - kinds[best]
            if not left[best]:
                fits = fits[fits != best]
            fits = fits[(kinds[fits] <= room).all(axis=1)]
        open_kinds = open_kinds[left[open_kinds] > 0]
        number += 1
    return bins, order


def packed_batches(
    tables: Iterator[pa.RecordBatch], keep: int, demands: Callable[[pa.RecordBatch], np.ndarray], most: np.ndarray, base: Callable[[], int]
) -> Iterator[pa.RecordBatch]:
    """The first ``keep`` columns of all rows with ``sequence_id`` and ``offset``, lot by lot.

    Sequences count on from ``base``, which is asked for when rows are there.
    """
    number = 0

    def placed(held: list[pa.RecordBatch], asked: np.ndarray) -> Iterator[pa.RecordBatch]:
        nonlocal number
        bins, order = fill_bins(asked.astype(np.int64), most)
        by_bin = np.lexsort((order, bins))
        length = asked[:, 0].astype(np.int64)[by_bin]
        ends = np.cumsum(length)
        first = np.r_[True, bins[by_bin][1:] != bins[by_bin][:-1]]
        before = np.repeat((ends - length)[first], np.diff(np.r_[np.flatnonzero(first), len(first)]))
        offset = np.empty(len(length), dtype=np.int64)
        offset[by_bin] = ends - length - before
        at, ids = 0, base() + number + bins
        number += int(bins.max()) + 1
        for batch in held:
            span = slice(at, at + batch.num_rows)
            at += batch.num_rows
            columns = [*batch.columns[:keep], pa.array(ids[span]), pa.array(offset[span])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:keep], "sequence_id", "offset"])

    held, asked, tokens = [], [], 0
    for batch in tables:
        for at in range(0, batch.num_rows, LOT_STEP):
            some = batch.slice(at, LOT_STEP)
            own = demands(some)
            if not (own <= most).all():  # also false for a missing demand
                raise ValueError(f"an example exceeds the limits {most.tolist()}")
            held.append(some)
            asked.append(own)
            tokens += int(own[:, 0].sum())
            if len(held) * LOT_STEP >= LOT_ROWS or tokens >= LOT_SEQUENCES * most[0]:
                yield from placed(held, np.concatenate(asked))
                held, asked, tokens = [], [], 0
    if held:
        yield from placed(held, np.concatenate(asked))


def _first_number(row_id: int) -> int:
    """Least sequence number of the partition in which Spark gave ``row_id``."""
    return row_id >> PARTITION_BITS << PARTITION_BITS


def pack(pieces: DataFrame, limits: dict[str, int]) -> DataFrame:
    """``pieces`` with the ``sequence_id`` and ``offset`` of each, under the ``limits`` by column.

    The first limit is on tokens: its column gives the offsets, without gaps. Pieces are packed where they
    lie: consecutive rows of a partition make a lot, and rows, places and ids leave in one pass without a
    shuffle; each lot leaves a sequence or so unfilled. Each row is an example of its own, so repeated
    rows and keys are packed apart. A row above a limit or with a null demand raises an error; an empty
    table gives no rows. Other columns are kept, but for any that are called ``sequence_id`` or
    ``offset``, which are replaced.
    """
    most = np.array(list(limits.values()), dtype=np.int64)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[int] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in tables:
                if batch.num_rows and not seen:
                    seen.append(_first_number(batch.column(1)[0].as_py()))
                yield batch

        def demands(batch: pa.RecordBatch) -> np.ndarray:
            return np.stack([batch.column(2 + i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(most))], axis=1)

        return packed_batches(noted(), 1, demands, most, lambda: seen[0])

    demand = [F.col(c).cast("long").alias(f"d{i}") for i, c in enumerate(limits)]
    rows = pieces.drop("sequence_id", "offset").select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id"), *demand)
    schema = StructType([rows.schema["row"], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return rows.mapInArrow(run, schema).select("row.*", "sequence_id", "offset")


def packed_documents(
    docs: DataFrame, key: str, text: str, tokenizer: str, limit: int = 4096, end_id: int = 2, segments: int = 256, ids: bool = True
) -> DataFrame:
    """Documents tokenised, cut into pieces and packed as by :func:`pack`; every token of a document bears loss.

    Both steps share one Python worker per task. Null and empty texts are ``end_id`` alone, texts of any
    length are cut into pieces, repeated rows are packed apart, other columns are left out, and an empty
    table gives no rows.
    """
    most = np.array([limit, segments, limit], dtype=np.int64)

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[int] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in tables:
                if batch.num_rows and not seen:
                    seen.append(_first_number(batch.column(2)[0].as_py()))
                yield batch

        def demands(batch: pa.RecordBatch) -> np.ndarray:
            length = batch.column(2).to_numpy().astype(np.float64)
            return np.stack([length, np.ones(len(length)), length], axis=1)

        pieces = piece_batches(noted(), key, tokenizer, limit, end_id, ids)
        return packed_batches(pieces, 5 + ids, demands, most, lambda: seen[0])

    rows = docs.select(key, text, F.monotonically_increasing_id().alias("_id"))
    return rows.mapInArrow(run, piece_schema(docs, key, ids) + ", sequence_id long, offset long")
