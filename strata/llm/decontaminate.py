"""Benchmark decontamination by the q-gram lemma.

A region of a document within k edits of a benchmark item of m characters
shares at least m - q + 1 - k * q of the item's q-grams, on diagonals that lie
at most k apart.  Three steps follow from that, each keeping every such region:
windows with too few q-grams of any item are skipped; shared q-grams are counted
per item in overlapping diagonal bands; bands that reach the bound are verified
by banded alignment.

Benchmark items are handled in blocks of bounded size, each broadcast to one
pass over the documents.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import column

Q = 8                    # characters of a gram
MAX_ERROR = 0.06         # edits allowed per character of an item
ITEM_BLOCK = 2_000_000   # characters of benchmark text that one pass holds
TEXT_BLOCK = 1 << 20     # characters of documents that are scanned at once
_STOP = 1                # code between documents, part of no gram

_BMP = [chr(c) for c in range(0x10000)]
_ALNUM = np.array([c.isalnum() for c in _BMP])
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in _BMP], np.uint32)
del _BMP


def normalise(codes: np.ndarray, stops: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(codes, source positions): letters and digits lowered, any run of other
    characters as one space.  ``stops``: positions that become _STOP."""
    if len(codes) and codes.max() < 0x10000:
        solid, out = _ALNUM[codes], _LOWER[codes]
    else:
        basic = codes < 0x10000
        low = np.where(basic, codes, 0)
        solid, out = _ALNUM[low] | ~basic, np.where(basic, _LOWER[low], codes)
    gap = ~solid
    gap[1:] &= solid[:-1]
    gap[:1] = False
    out[~solid] = 32
    keep = solid | gap
    if stops is not None:
        out[stops] = _STOP
        keep[stops] = True
    at = np.flatnonzero(keep)
    return out[at], at


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every q-gram (q a power of two), by doubling."""
    h = (codes.astype(np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
    n = 1
    while n < q:
        h = h[:-n] * np.uint64(0xD6E8FEB86659FD93 + 2 * n) + h[n:] if len(h) > n else h[:0]
        h ^= h >> np.uint64(32)
        n *= 2
    return h


def edit_budget(m: int, q: int = Q, rate: float = MAX_ERROR) -> int:
    """Edits allowed for an item of m characters; at least one shared gram stays necessary."""
    return max(0, min(int(m * rate), (m - q) // q))


class Items:
    """Grams of a block of items: hash table, postings, and size classes."""

    def __init__(self, items: list[tuple], q: int, rate: float):
        self.q = q
        self.items = []
        for item_id, text in items:
            codes, _ = normalise(codes_of(text or ""))
            if len(codes) and codes[-1] == 32:
                codes = codes[:-1]
            if len(codes) >= q:      # shorter items are no evidence
                self.items.append((item_id, codes, edit_budget(len(codes), q, rate)))
        grams = [gram_hashes(c, q) for _, c, _ in self.items]
        every = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.grams, first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.owner, self.place = first, owner[order], place[order]
        self.shift = np.uint64(64 - max(12, math.ceil(math.log2(max(1, len(self.grams)) * 64))))
        self.known = np.zeros(1 << (64 - int(self.shift)), bool)
        self.known[(self.grams >> self.shift).astype(np.int64)] = True
        by = defaultdict(list)
        for i, (_, c, _) in enumerate(self.items):
            by[int(math.log(len(c)) / math.log(1.25))].append(i)
        # per class: items, grams of its widest region, fewest grams that must be shared
        self.classes = [(np.isin(np.arange(len(self.items)), x),
                         max(len(self.items[i][1]) + self.items[i][2] for i in x) - q + 1,
                         min(self.need(i) for i in x)) for x in by.values()]

    def need(self, i: int) -> int:
        _, c, k = self.items[i]
        return len(c) - self.q + 1 - k * self.q


STRIDE = 16              # windows are tested at every 16th gram, widened by as much


def _regions(total: np.ndarray, width: int, need: int) -> list[tuple[int, int]]:
    """Merged windows that cover every window of ``width`` grams with at least
    ``need`` known ones; total[i] known grams lie before i."""
    n = len(total) - 1
    begin = np.arange(0, n, STRIDE)
    end = np.minimum(begin + width + STRIDE, n)
    dense = begin[total[end] - total[begin] >= need]
    if not len(dense):
        return []
    cut = np.flatnonzero(np.diff(dense) > width) + 1
    return [(int(x[0]), min(int(x[-1]) + width + STRIDE, n)) for x in np.split(dense, cut)]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """Fewest edits (at most k) that turn a substring of ``text`` into ``item``
    along diagonals low..high (text position - item position): (edits, start,
    end), or None.  One numpy row per character of the item."""
    low, high = low - k, high + k
    n, far = high - low + 1, 1 << 20
    diagonal = np.arange(low, high + 1)
    ramp = np.arange(n)
    inside = (diagonal >= 0) & (diagonal <= len(text))
    cost = np.where(inside, 0, far)
    start = diagonal.copy()
    for i, c in enumerate(item.tolist()):
        at = diagonal + i                       # text character compared on each diagonal
        ok = (at >= 0) & (at < len(text))
        same = np.zeros(n, bool)
        same[ok] = text[at[ok]] == c
        best = np.where(ok, cost + ~same, far)               # match or replace
        source = start.copy()
        skip = np.append(cost[1:], far) + 1                  # the item's character is missing
        skip[(at + 1 < 0) | (at + 1 > len(text))] = far
        better = skip < best
        best[better], source[better] = skip[better], np.append(start[1:], 0)[better]
        reach = best - ramp                                  # extra text characters: along the row
        run = np.minimum.accumulate(reach)
        came = np.maximum.accumulate(np.where(reach == run, ramp, 0))
        cost, start = run + ramp, source[came]
        cost[at + 1 > len(text)] = far
        if cost.min() > k:
            return None
    j = int(np.argmin(cost))
    if cost[j] > k:
        return None
    return int(cost[j]), int(start[j]), int(diagonal[j] + len(item))


def matches(codes: np.ndarray, items: Items) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) of every passage in normalised codes, each within
    one document (between two _STOPs or an end); of overlapping passages of an
    item the one with fewer edits, then the first."""
    h = gram_hashes(codes, items.q)
    if not len(h) or not items.items:
        return []
    flags = items.known[(h >> items.shift).astype(np.int64)]
    total = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=total[1:])
    stops = np.flatnonzero(codes == _STOP)
    bounds = np.concatenate(([0], stops + 1, [len(codes) + 1]))    # document d: bounds[d] to bounds[d + 1] - 1
    found: dict[int, list] = defaultdict(list)
    for members, width, need in items.classes:
        for a, z in _regions(total, width, need):
            at = np.flatnonzero(flags[a:z]) + a
            slot = np.minimum(np.searchsorted(items.grams, h[at]), len(items.grams) - 1)
            real = items.grams[slot] == h[at]
            at, slot = at[real], slot[real]
            times = items.times[slot]
            post = np.repeat(items.first[slot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            # hits are counted per item and document, on diagonals within the document
            doc = np.searchsorted(stops, at)
            owner = items.owner[post]
            diagonal = np.repeat(at - bounds[doc], times) - items.place[post]
            mine = members[owner]
            pair, diagonal = (np.repeat(doc, times) * len(items.items) + owner)[mine], diagonal[mine]
            order = np.lexsort((diagonal, pair))
            pair, diagonal = pair[order], diagonal[order]
            pairs, first = np.unique(pair, return_index=True)
            for x, lo, hi in zip(pairs.tolist(), first.tolist(), [*first[1:].tolist(), len(pair)]):
                d, i = divmod(x, len(items.items))
                if hi - lo < items.need(i):
                    continue
                begin = int(bounds[d])
                passages = _passages(codes[begin:int(bounds[d + 1]) - 1], items, i, diagonal[lo:hi])
                found[i] += [(edits, start + begin, end + begin) for edits, start, end in passages]
    out = []
    for i, spans in found.items():
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(set(spans)):
            if all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                out.append((i, start, end, edits))
    return out


def _passages(codes, items: Items, i: int, diagonals: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Verified (edits, start, end) of one item in one document's codes; bands of
    2 * (k + 1) diagonals, one beginning every k + 1."""
    _, item, k = items.items[i]
    step, need = k + 1, items.need(i)
    band = (diagonals // step)
    last = -1
    for b in np.unique(np.concatenate((band, band - 1))).tolist():
        lo, hi = np.searchsorted(diagonals, [b * step, (b + 2) * step])
        if hi - lo < need or (lo, hi) == last:
            continue
        last = (lo, hi)
        low, high = int(diagonals[lo]), int(diagonals[hi - 1])
        a, z = max(0, low - k), min(len(codes), high + len(item) + k)
        piece = codes[a:z]
        for d in np.unique(diagonals[lo:hi]).tolist():
            if d >= 0 and np.array_equal(codes[d:d + len(item)], item):
                yield 0, d, d + len(item)
                break
        else:
            got = align(item, piece, low - a, high - a, k)
            if got:
                yield got[0], got[1] + a, got[2] + a


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", q: int = Q,
                 max_error: float = MAX_ERROR) -> DataFrame:
    """One row per passage: id, item_id, start, end (code points of the text, end
    exclusive), edits.  Ids of both sides may have any type and keep it; where the
    documents' id column is itself called item_id, start, end or edits, it comes out
    as document_id.

    Case, punctuation and spacing don't count; an item matches with at most
    max_error edits per character.  Null and empty texts match nothing, nor do
    items of fewer than q letters and spaces; equal items each give their rows,
    repeated documents too; other columns are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / ITEM_BLOCK))
    out_col = "document_id" if id_col in ("item_id", "start", "end", "edits") else id_col
    docs = docs.select(F.col(id_col).alias(out_col), F.col(text_col).cast("string").alias("__text"))
    kind, item_kind = dict(docs.dtypes)[out_col], dict(items.dtypes)["item_id"]
    item_type = items.select("item_id").limit(0).toArrow().schema.field(0).type
    schema = f"`{out_col}` {kind}, item_id {item_kind}, start long, end long, edits long"

    def scan(held):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = Items(held.value, q, max_error)
            for b in batches:
                ids, texts = column(b, out_col), column(b, "__text")
                out, group, size = [], [], 0
                for n, t in enumerate(texts):
                    t = t.as_py() or ""
                    group.append((n, t))
                    size += len(t)
                    if size >= TEXT_BLOCK:
                        out += _scan_group(group, table)
                        group, size = [], 0
                out += _scan_group(group, table)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([x[0] for x in out])),
                         pa.array([table.items[x[1]][0] for x in out], item_type),
                         *(pa.array([x[i] for x in out], pa.int64()) for i in (2, 3, 4))],
                        [out_col, "item_id", "start", "end", "edits"])
        return rows

    result = None
    for b in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        held = spark.sparkContext.broadcast([(r.item_id, r.text) for r in mine])
        part = docs.mapInArrow(scan(held), schema)
        result = part if result is None else result.union(part)
    return result


def _scan_group(group: list[tuple[int, str]], table: Items) -> list[tuple]:
    """(row, item, start, end, edits) over documents that are scanned together."""
    if not group:
        return []
    lengths = np.array([len(t) + 1 for _, t in group])
    begin = np.concatenate(([0], np.cumsum(lengths)))
    codes = codes_of("\x00".join([t for _, t in group]) + "\x00")
    norm, at = normalise(codes, begin[1:] - 1)
    out = []
    for i, start, end, edits in matches(norm, table):
        a, z = int(at[start]), int(at[end - 1]) + 1
        row = int(np.searchsorted(begin, a, side="right")) - 1
        out.append((group[row][0], i, a - int(begin[row]), z - int(begin[row]), edits))
    return out
