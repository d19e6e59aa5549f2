"""Packing by minimum bin slack.

A document's ids are cut at every full window; what remains is packed.  For
each window a subset-sum over the lengths at hand (one bit per reachable sum,
lengths with their counts) finds the multiset that comes closest to the
capacity; the counts are read back from the bitsets.  Slack that no multiset
fills is filled by cutting a remaining piece.  Each task packs the documents of
its input partition through a pool of bounded size, so nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strata.llm.common import column
from strata.llm.tokens import WordIds

POOL = 2048              # pieces that wait for a window
ROWS_OUT = 1024          # pieces of an output batch


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (at most ``counts`` of each) with the largest sum
    not over ``capacity``; longer lengths are preferred.  Bit s of a bitset:
    sum s can be reached; a length's count enters in powers of two."""
    reach, full, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        n, part = min(counts[length], capacity // length), 1
        while n > 0:
            take = min(part, n)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            n, part = n - take, part * 2
        if reach >> capacity:
            break
    at, chosen = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return dict(chosen)


class Packer:
    """Windows of pieces (document, start, ids); sequence numbers begin at ``base``."""

    def __init__(self, capacity: int, base: int):
        self.capacity, self.sequence = capacity, base
        self.pool: dict[int, list] = defaultdict(list)
        self.waiting = 0

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._window([(doc, start, ids[4 * start:4 * (start + self.capacity)], total)])
        if total > whole:
            self.pool[total - whole].append((doc, whole, ids[4 * whole:], total))
            self.waiting += 1
        if self.waiting >= POOL:
            while self.waiting > POOL // 2:
                yield from self._packed()

    def close(self) -> Iterator[tuple]:
        while self.waiting:
            yield from self._packed()

    def _window(self, pieces) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids) // 4, ids, total, self.sequence, offset
            offset += len(ids) // 4
        self.sequence += 1

    def _take(self, length: int):
        piece = self.pool[length].pop()
        if not self.pool[length]:
            del self.pool[length]
        self.waiting -= 1
        return piece

    def _put(self, piece) -> None:
        self.pool[len(piece[2]) // 4].append(piece)
        self.waiting += 1

    def _packed(self) -> Iterator[tuple]:
        chosen = fill({n: len(x) for n, x in self.pool.items()}, self.capacity)
        pieces = [self._take(n) for n in sorted(chosen, reverse=True) for _ in range(chosen[n])]
        slack = self.capacity - sum(len(p[2]) // 4 for p in pieces)
        if slack and self.waiting:      # every piece left is longer than the slack
            doc, start, ids, total = self._take(max(self.pool))
            pieces.append((doc, start, ids[:4 * slack], total))
            self._put((doc, start + slack, ids[4 * slack:], total))
        elif slack:                     # the task's last ids: sequences of powers of two
            yield from self._last(pieces)
            return
        yield from self._window(pieces)

    def _last(self, pieces) -> Iterator[tuple]:
        left = sum(len(p[2]) // 4 for p in pieces)
        pieces = pieces[::-1]
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                doc, start, ids, total = pieces.pop()
                n = min(size, len(ids) // 4)
                window.append((doc, start, ids[:4 * n], total))
                if n < len(ids) // 4:
                    pieces.append((doc, start + n, ids[4 * n:], total))
                size -= n
            yield from self._window(window)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    A document is its token ids and the end id.  A null or empty text is the end
    id alone; null and repeated ids of documents are ordinary rows; other
    columns are ignored; an empty table gives no pieces.  A sequence holds
    ``capacity`` ids, but for the last ones of an input partition, whose lengths
    are powers of two.
    """
    words = WordIds(docs.sparkSession, tokenizer_path)
    kind = dict(docs.dtypes)[id_col]
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, (TaskContext.get().partitionId() + 1) << 32)
        encode, out, schema = words.encoder(), [], None

        def batch():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], schema), *(pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                              for n, c in zip(names[1:], cols[1:]))], names)

        for b in batches:
            docs_ids, texts = column(b, id_col), column(b, text_col)
            schema = docs_ids.type
            for doc, text in zip(docs_ids.to_pylist(), texts):
                for piece in packer.add(doc, encode(text.as_py() or "") + end):
                    out.append(piece)
                    if len(out) >= ROWS_OUT:
                        yield batch()
        for piece in packer.close():
            out.append(piece)
            if len(out) >= ROWS_OUT:
                yield batch()
        if out:
            yield batch()

    return docs.select(id_col, text_col).mapInArrow(
        rows, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
