"""N-gram Jaccard join by universe partition (pigeonhole).

The hash universe of shingles is cut into equal segments, by size band.  Two
sets that link differ in at most H shingles, which bounds the segments in which
they differ; what is probed is decided by cost:

* with M > H segments at least M - H are equal, and equal segments meet through
  one signature each;
* in bands of small sets, where empty segments use up M - H, half as many
  segments are indexed together with their one-deletion neighbourhoods: some
  segment differs in at most one shingle;
* empty segments are never indexed as such, a segment that more than ``HOT``
  sets share is compared with one hub only, and a pair is verified if it meets
  in enough of the others;
* a set whose empty and hot segments could hide a partner is *short*.  Both
  sets of a hidden pair are short, so short sets alone are joined once more by
  the finest partition, a shingle a segment, each probing its cheapest (rarest)
  n - ceil(0.75 n) + 1 segments, of which a pair must share one.

Candidates pass a lower bound of their difference (parities by slot) and are then
verified on their whole shingle sets (64-bit hashes).
Signatures travel as packed numpy blobs: a shuffle row per task and bucket.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import column, likely_in, release, saved
from strata.llm.components import components
from strata.llm.packed import joined, split, spread, spread_sorted, squeeze, squeeze_sorted
from strata.llm.shingles import mix64, set_hash, shingle_sets

HOT = 10                 # sets per signature that are compared pairwise
SPREAD = 0.55            # segments as a share of the band's upper size
BUCKET_ENTRIES = 1_000_000  # signatures that one reduce group holds
COUNTERS = 1 << 22       # of the sketch that ranks shingles of short sets: 4 MB, whatever the data
BLOCK_SHINGLES = 1_000_000  # shingles whose signatures a task packs together
TASK_ROWS = 50_000       # rows of a few numbers that a task reads, where their number is known
THRESHOLD = 75           # per cent
_MULT = np.uint64(0x9E3779B97F4A7C15)
_U32 = np.uint64(32)


class Bands:
    """Sizes cut so that a set links only with its own band and the next."""

    def __init__(self, threshold: int):
        self.t = threshold
        self.low = [1, 2]

    def _grow(self, n: int) -> None:
        while self.low[-1] <= n or len(self.low) < 3 or self.low[-2] <= n:
            self.low.append(max(self.low[-1] + 1, (self.low[-1] - 1) * 100 // self.t + 1))

    def of(self, n: int) -> int:
        self._grow(n)
        return bisect_right(self.low, n) - 1

    def top(self, band: int) -> int:
        """Largest size in a band."""
        while len(self.low) <= band + 1:
            self._grow(self.low[-1])
        return self.low[band + 1] - 1

    def difference(self, n: int, m: int) -> int:
        """Largest symmetric difference of linked sets of n and m shingles."""
        return (n + m) * (100 - self.t) // (100 + self.t)

    def worst(self, n: int, band: int) -> int:
        """Largest difference of a set of n with any partner under a band's scheme."""
        own = self.of(n) == band
        most = min(n * 100 // self.t, self.top(band + 1)) if own else self.top(band)
        return self.difference(n, most)

    def segments(self, band: int) -> int:
        top = self.top(band)
        return max(math.ceil(SPREAD * top), self.difference(top, top * 100 // self.t) + 3)

    def wide_segments(self, band: int) -> int:
        """One shared or nearly shared segment is certain among these."""
        top = self.top(band)
        return self.difference(top, top * 100 // self.t) // 2 + 1

    def neighbourhoods(self, band: int) -> bool:
        """Allocation by cost: one deletion on half the segments, where the empty
        ones among M (two deviations over their mean) would use up M - H."""
        m, low = self.segments(band), self.low[band]
        empty = m * math.exp(-low / m)
        return empty + 2 * math.sqrt(empty) >= m - self.worst(low, band)

    def spare(self, n: int, band: int) -> int:
        """Segments in which a set of n surely meets any partner under a scheme."""
        h = self.worst(n, band)
        return self.wide_segments(band) - h // 2 if self.neighbourhoods(band) else self.segments(band) - h

    def schemes(self, n: int) -> list[int]:
        b = self.of(n)
        return [b] if b == 0 else [b, b - 1]


class _Schemes:
    """``Bands.neighbourhoods``, remembered."""

    def __init__(self, bands: Bands):
        self.bands, self.known = bands, {}

    def neighbourhoods(self, band: int) -> bool:
        if band not in self.known:
            self.known[band] = self.bands.neighbourhoods(band)
        return self.known[band]


def _segment_starts(s: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    seg = ((s >> _U32) * np.uint64(m)) >> _U32
    return seg, np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))


def _segment(s: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment numbers, start offsets, signatures' inner sums) of non-empty segments."""
    seg, start = _segment_starts(s, m)
    return seg[start], start, np.add.reduceat(mix64(s + np.uint64(77)), start)


def _signature(seg: np.ndarray, inner: np.ndarray, scheme: int) -> np.ndarray:
    return mix64(inner + (seg + np.uint64(1)) * _MULT + np.uint64(scheme * 1_000_003 + 1))


def parity_bits(s: np.ndarray, n_bits: int) -> np.ndarray:
    """One bit per slot of the hash universe: is the number of shingles odd?
    Sets differ in at least as many shingles as their bits differ."""
    slot = ((s >> _U32) * np.uint64(n_bits)) >> _U32
    return (np.bincount(slot.astype(np.int64), minlength=n_bits) & 1).astype(np.uint8)


def parities(s: np.ndarray, band: int, bands: Bands) -> bytes:
    """``parity_bits``, about four per shingle, equally many for a band's partners."""
    return np.packbits(parity_bits(s, 8 * (bands.top(band) // 2 + 1))).tobytes()


def exact_signatures(s: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    seg, _, inner = _segment(s, bands.segments(band))
    return _signature(seg, inner, band)


def neighbourhood_signatures(s: np.ndarray, band: int, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signatures of all wide segments, those of their one-deletion sets)."""
    m = bands.wide_segments(band)
    seg, start, inner = _segment(s, m)
    whole = np.zeros(m, np.uint64)
    whole[seg.astype(np.int64)] = inner
    sizes = np.diff(start, append=len(s))
    less = np.repeat(inner, sizes) - mix64(s + np.uint64(77))
    scheme = 500_000_000 + band
    return (_signature(np.arange(m, dtype=np.uint64), whole, scheme),
            _signature(np.repeat(seg, sizes), less, scheme))


# ---------------------------------------------------------------- packed entries
# An entry is (signature, node, flag).  Entries with flag 1 (a size band's lower
# neighbour, a one-deletion set) meet only entries with flag 0; flag 2 is added
# to what is left of a signature that one block of rows shared too often.
def _gid(bucket, low):
    return low.astype(np.int64) | np.int64(1 << 32) | (bucket << np.int64(33))


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _width(nodes: int):
    return np.uint16 if nodes < 1 << 14 else np.uint64


def _pack(groups: dict, n_buckets: int) -> Iterator[dict]:
    """groups: scheme -> [(signatures, node, flag)]; one row per bucket with
    node table, signatures and node numbers, compressed.  A signature that more than HOT
    nodes of the block share leaves one hub; the others go out as star rows."""
    parts: dict[int, list] = {}
    stars: dict[int, list] = {}
    for scheme, items in groups.items():
        sizes = [len(x[0]) for x in items]
        sig = np.concatenate([x[0] for x in items])
        node = np.repeat(np.array([x[1] for x in items], np.int64), sizes)
        flag = np.repeat(np.array([x[2] for x in items], np.uint8), sizes)
        order = np.lexsort((node, flag, sig))
        sig, node, flag = sig[order], node[order], flag[order]
        bucket = ((sig >> _U32) * np.uint64(n_buckets) >> _U32).astype(np.int64)
        start = _starts(sig)
        size = np.diff(start, append=len(sig))
        many = np.repeat((size > HOT) & (flag[start] == 0), size)
        if many.any():
            hub = np.repeat(node[start], size)
            rest = many & (node != hub)
            star = np.stack([_gid(bucket[rest], sig[rest] & np.uint64(0xFFFFFFFF)), hub[rest], node[rest]], 1)
            spread_to = (mix64(star[:, 2].astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
            for b in np.unique(spread_to).tolist():
                stars.setdefault(-1 - b, []).append((scheme, star[spread_to == b]))
            flag = flag | (many.astype(np.uint8) << 1)
            keep = ~many | (node == hub)
            sig, node, flag, bucket = sig[keep], node[keep], flag[keep], bucket[keep]
        cut = _starts(bucket)
        for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(sig)]):
            # inside a bucket the low half of a signature tells it apart
            low = sig[a:z].astype(np.uint32)
            order = np.argsort(low, kind="stable")
            parts.setdefault(int(bucket[a]), []).append((scheme, low[order], node[a:z][order], flag[a:z][order]))
    for b, found in parts.items():
        names, number = np.unique(np.concatenate([x[2] for x in found]), return_inverse=True)
        # the flags are the low bits of the node number
        number = (number << 2 | np.concatenate([x[3] for x in found])).astype(_width(len(names)))
        sizes = np.array([len(names), *[n for x in found for n in (x[0], len(x[1]))]], np.int64).tobytes()
        steps = np.concatenate([np.diff(x[1], prepend=np.uint32(0)) for x in found])
        yield {"bucket": b, "blob": joined([sizes, squeeze_sorted(names.view(np.uint64)), squeeze(steps), squeeze(number)])}
    for b, found in stars.items():
        schemes = np.array([n for x in found for n in (x[0], len(x[1]))], np.int64).tobytes()
        yield {"bucket": b, "blob": joined([schemes, squeeze(np.concatenate([x[1] for x in found]).T)])}


def _unpack(blobs: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    found: dict[int, list] = {}
    for blob in blobs:
        sizes, names, steps, number = split(blob)
        k, *sizes = np.frombuffer(sizes, np.int64).tolist()
        names, steps, number = spread_sorted(names).view(np.int64), spread(steps, np.uint32), spread(number, _width(k))
        at = 0
        for scheme, n in zip(sizes[::2], sizes[1::2]):
            own = number[at:at + n]
            found.setdefault(scheme, []).append(
                (np.cumsum(steps[at:at + n], dtype=np.uint32), names[own >> 2], (own & 3).astype(np.uint8)))
            at += n
    return {s: tuple(np.concatenate([x[i] for x in v]) for i in range(3)) for s, v in found.items()}


ENTRY_SCHEMA = "bucket long, blob binary"
MEET_SCHEMA = "scheme long, gid long, u long, v long, n long"


def _rows(scheme: int, gid, u: np.ndarray, v: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"scheme": pa.array(np.full(len(u), scheme, np.int64)),
                     "gid": pa.nulls(len(u), pa.int64()) if gid is None else pa.array(gid),
                     "u": pa.array(u), "v": pa.array(v), "n": pa.array(n)})


def _meetings(bucket: int, blobs: list[bytes]) -> Iterator[pa.Table]:
    """Rows (scheme, gid, u, v, n): pairs of a small group (gid null, n groups
    of this bucket) and hub-member rows of a hot one (gid set)."""
    if bucket < 0:
        for blob in blobs:
            schemes, star = split(blob)
            schemes, star, at = np.frombuffer(schemes, np.int64).tolist(), spread(star, np.int64).reshape(3, -1), 0
            for scheme, n in zip(schemes[::2], schemes[1::2]):
                yield _rows(scheme, *star[:, at:at + n], np.ones(n, np.int64))
                at += n
        return
    for scheme, (sig, node, flag) in _unpack(blobs).items():
        order = np.lexsort((flag, node, flag & 1, sig))
        sig, node, flag = sig[order], node[order], flag[order]
        was_hot = np.repeat(np.maximum.reduceat(flag, (start := _starts(sig))) >= 2, np.diff(start, append=len(sig)))
        once = _starts(sig, node, flag & 1)
        sig, node, flag, was_hot = sig[once], node[once], flag[once] & 1, was_hot[once]
        start = _starts(sig)
        size = np.diff(start, append=len(sig))
        hot = np.repeat(((size > HOT) & (flag[start] == 0)), size) | was_hot
        if hot.any():
            hub = np.repeat(node[start], size)
            yield _rows(scheme, _gid(np.int64(bucket), sig[hot]), hub[hot], node[hot],
                        np.ones(int(hot.sum()), np.int64))
        left, right = [], []
        for step in range(1, HOT):
            i = np.flatnonzero((sig[step:] == sig[:-step]) & ~hot[step:] & (flag[:len(sig) - step] == 0))
            if not len(i):
                break
            i = i[node[i] != node[i + step]]
            left.append(np.minimum(node[i], node[i + step]))
            right.append(np.maximum(node[i], node[i + step]))
        if left:
            u, v = np.concatenate(left), np.concatenate(right)
            order = np.lexsort((v, u))
            u, v = u[order], v[order]
            first = _starts(u, v)
            if len(first):
                yield _rows(scheme, None, u[first], v[first], np.diff(first, append=len(u)))


def _met(entries: DataFrame) -> DataFrame:
    empty = pa.table({c: pa.array([], pa.int64()) for c in ("scheme", "gid", "u", "v", "n")})

    def reduce(key, table):
        blobs = column(table, "blob").to_pylist()
        return pa.concat_tables([empty, *_meetings(key[0].as_py(), blobs)])

    return entries.groupBy("bucket").applyInArrow(reduce, MEET_SCHEMA)


# ---------------------------------------------------------------- the join
def shingle_nodes(docs: DataFrame, threshold: int) -> DataFrame:
    """Per row: id, key, n, node (hash of its set), band, and the number of segments
    that are not indexed (empty) under the schemes of its band and the one below."""
    bands = Bands(threshold)
    schemes = _Schemes(bands)

    def empty(s: np.ndarray, scheme: int) -> int:
        if schemes.neighbourhoods(scheme):
            return 0
        m = bands.segments(scheme)
        return m - len(_segment_starts(s, m)[1])

    def rows(batches):
        for b in batches:
            n, node, band, gaps, low_gaps = [], [], [], [], []
            for s in shingle_sets(column(b, "text")):
                own = bands.of(len(s)) if len(s) else None
                n.append(len(s))
                node.append(set_hash(s))
                band.append(own)
                gaps.append(empty(s, own) if len(s) else None)
                low_gaps.append(empty(s, own - 1) if own else None)
            yield pa.RecordBatch.from_arrays(
                [column(b, "id"), column(b, "key"), *(pa.array(x, pa.int64()) for x in (n, node, band, gaps, low_gaps))],
                ["id", "key", "n", "node", "band", "gaps", "low_gaps"])

    return docs.select("id", "text", "key").mapInArrow(
        rows, f"id {dict(docs.dtypes)['id']}, key long, n long, node long, band long, gaps long, low_gaps long")


def _entries(docs: DataFrame, n_buckets: int, threshold: int) -> DataFrame:
    """Packed signatures of all rows under the schemes of their bands."""
    bands = Bands(threshold)
    schemes = _Schemes(bands)

    def signatures(s: np.ndarray, h: int):
        for k in bands.schemes(len(s)):
            if schemes.neighbourhoods(k):
                whole, less = neighbourhood_signatures(s, k, bands)
                yield k, (whole, h, 0)
                yield k, (less, h, 1)
            else:
                yield k, (exact_signatures(s, k, bands), h, int(k != bands.of(len(s))))

    return _packed_rows(docs.where("text is not null").select("text"), lambda b: b, signatures, n_buckets)


def _packed_rows(texts: DataFrame, near, signatures, n_buckets: int) -> DataFrame:
    def rows(batches):
        groups, seen, waiting = {}, set(), 0
        for b in batches:
            for s in shingle_sets(column(near(b), "text")):
                h = set_hash(s)
                if not len(s) or h in seen:
                    continue
                seen.add(h)
                for scheme, item in signatures(s, h):
                    groups.setdefault(scheme, []).append(item)
                waiting += len(s)
                if waiting > BLOCK_SHINGLES:
                    yield from _batch(_pack(groups, n_buckets))
                    groups, seen, waiting = {}, set(), 0
        yield from _batch(_pack(groups, n_buckets))

    return texts.mapInArrow(rows, ENTRY_SCHEMA)


def _batch(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("blob", pa.binary())]))


def _parities(docs: DataFrame, wanted: DataFrame, threshold: int) -> DataFrame:
    """(node, own, low): parities of at least the wanted keys."""
    bands, (slot, near) = Bands(threshold), likely_in(wanted, "key")

    def rows(batches):
        for b in batches:
            sets = [s for s in shingle_sets(column(near(b), "text")) if len(s)]
            own = [bands.of(len(s)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_hash(s) for s in sets], pa.int64()),
                 pa.array([parities(s, k, bands) for s, k in zip(sets, own)], pa.binary()),
                 pa.array([parities(s, k - 1, bands) if k else None for s, k in zip(sets, own)], pa.binary())],
                ["node", "own", "low"])

    return (docs.select("text", slot).mapInArrow(rows, "node long, own binary, low binary")
            .dropDuplicates(["node"]))


def _parity_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, bits): 1024 parities as 16 longs, of at least the wanted keys; for
    conditions of joins among small sets."""
    slot, near = likely_in(wanted, "key")

    def rows(batches):
        for b in batches:
            sets = [s for s in shingle_sets(column(near(b), "text")) if len(s)]
            words = [np.packbits(parity_bits(s, 1024)).view(np.int64).tolist() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in sets], pa.int64()),
                                              pa.array(words, pa.list_(pa.int64()))], ["node", "bits"])

    return docs.select("text", slot).mapInArrow(rows, "node long, bits array<long>").dropDuplicates(["node"])


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, items): whole shingle sets of at least the wanted keys."""
    slot, near = likely_in(wanted, "key")

    def rows(batches):
        for b in batches:
            sets = list(shingle_sets(column(near(b), "text")))
            yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "items"])

    return docs.select("text", slot).mapInArrow(rows, "node long, items binary").dropDuplicates(["node"])


def _sided(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pairs (u, v) plus key, n and band of both."""
    side = lambda s: classes.select(F.col("node").alias(s), *[F.col(c).alias(s + c) for c in ("key", "n", "band")])
    return pairs.join(side("u"), "u").join(side("v"), "v")


def _read_by(df: DataFrame, rows: int) -> DataFrame:
    """The table read by as many tasks as its rows need, however many wrote it."""
    return df.coalesce(max(1, math.ceil(rows / TASK_ROWS)))


def _links(pairs: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """The links (u, v) among pairs (scheme, u, v and what ``_sided`` adds): sizes
    and parities must allow one, then the whole sets decide."""
    bands = Bands(threshold)

    def possible(batches):
        for b in batches:
            keep = []
            for n, m, x, y in zip(*(column(b, c).to_pylist() for c in ("un", "vn", "ubytes", "vbytes"))):
                p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                keep.append(len(p) == len(q) and int(np.bitwise_count(p ^ q).sum()) <= bands.difference(n, m))
            yield b.filter(pa.array(keep, pa.bool_())).select(["u", "v", "ukey", "vkey"])

    def linked(batches):
        for b in batches:
            keep = []
            for x, y in zip(column(b, "a").to_pylist(), column(b, "b").to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                common = int(np.count_nonzero(q[at] == p))
                keep.append(100 * common >= threshold * (len(p) + len(q) - common))
            yield b.filter(pa.array(keep, pa.bool_())).select(["u", "v"])

    pairs = saved(pairs.where(((F.least("uband", "vband") == F.col("scheme")) | (F.col("scheme") < 0))
                        & (F.least("un", "vn") * 100 >= F.greatest("un", "vn") * threshold))
                  .withColumn("scheme", F.least("uband", "vband")))
    release(docs.sparkSession)       # of what ended a step ago: Spark holds the last query a little longer
    keys = lambda p: p.select(F.explode(F.array("ukey", "vkey")).alias("key"))
    held = saved(_parities(docs, keys(pairs), threshold))
    release(docs.sparkSession)
    part = lambda s: held.select(F.col("node").alias(s), F.col("own").alias(f"{s}own"), F.col("low").alias(f"{s}low"))
    which = lambda s: F.when(F.col(f"{s}band") == F.col("scheme"), F.col(f"{s}own")).otherwise(F.col(f"{s}low"))
    likely = saved(pairs.join(part("u"), "u").join(part("v"), "v")
                   .select("u", "v", "ukey", "vkey", "un", "vn", which("u").alias("ubytes"), which("v").alias("vbytes"))
                   .mapInArrow(possible, "u long, v long, ukey long, vkey long"))
    sets = saved(_sets(docs, keys(likely)))
    release(docs.sparkSession)
    found = saved(likely.join(sets.select(F.col("node").alias("u"), F.col("items").alias("a")), "u")
                  .join(sets.select(F.col("node").alias("v"), F.col("items").alias("b")), "v")
                  .select("u", "v", "a", "b").mapInArrow(linked, "u long, v long"))
    release(docs.sparkSession)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Linked: 100 * |A n B| >= threshold * |A u B|; component_id is the smallest
    id reachable by links, the row's own included.  A text without words (or
    null) has no shingles and is its own component; rows with equal sets share
    a component; a null id is kept, counts as no id for others, and gets its
    component's smallest id (null if there is none).  Other columns are ignored.
    """
    bands = Bands(threshold)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # names a class's text before it is shingled: never null, unlike its id
    docs = docs.withColumn("key", F.xxhash64("id", "text"))
    nodes = saved(shingle_nodes(docs, threshold))
    rest = ["n", "band", "gaps", "low_gaps"]
    classes = saved(nodes.where("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.min("key").alias("key"), *[F.first(c).alias(c) for c in rest]))
    total, n_classes = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    classes = _read_by(classes, n_classes)
    n_buckets = max(4, math.ceil(total / BUCKET_ENTRIES))
    met = saved(_met(_entries(docs, n_buckets, threshold)))
    met = _read_by(met, met.count())
    release(docs.sparkSession)

    # a hub and its member have met in no segment that counts, unless also as a pair
    pairs = (met.where("u <> v").select("scheme", F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"),
                                        F.when(F.col("gid").isNull(), F.col("n")).otherwise(0).alias("n"))
             .groupBy("scheme", "u", "v").agg(F.sum("n").alias("n")))
    stars = met.where("gid is not null")
    hot = stars.select("scheme", F.col("v").alias("node")).groupBy("scheme", "node").agg(
        F.count(F.lit(1)).alias("hot"))
    # segments in which a linked pair must meet besides the empty and hot ones
    # it may share; pairs, hubs and members below that number of meetings cannot link
    own = ["node", "key", "n", "band"]
    room = (classes.select(*own, F.col("band").alias("scheme"), F.col("gaps").alias("empty"))
            .union(classes.where("band > 0").select(*own, F.col("band") - 1, "low_gaps"))
            .join(hot, ["scheme", "node"], "left")
            .select("scheme", *own, (F.col("empty") + F.coalesce("hot", F.lit(0))).alias("lost")))
    top_band = classes.agg(F.max("band")).first()[0]
    all_bands = range((top_band or 0) + 1)
    segments = F.array(*[F.lit(bands.segments(b)) for b in all_bands])
    by_neighbour = F.array(*[F.lit(bands.neighbourhoods(b)) for b in all_bands])
    of_band = lambda a: F.element_at(a, (F.col("scheme") + 1).cast("int"))
    side = lambda s: room.select("scheme", F.col("node").alias(s),
                                 *[F.col(c).alias(s + c) for c in ("key", "n", "band", "lost")])
    need = F.when(of_band(by_neighbour), F.lit(0)).otherwise(
        of_band(segments) - F.floor((F.col("un") + F.col("vn")) * (100 - threshold) / (100 + threshold))
        - F.least("ulost", "vlost"))
    pairs = (pairs.join(side("u"), ["scheme", "u"]).join(side("v"), ["scheme", "v"])
             .where(F.col("n") >= need).drop("n", "ulost", "vlost"))
    links = _links(pairs, docs, threshold)
    groups = components(links)
    release(docs.sparkSession)

    # short sets: what is lost in empty segments and in hot ones whose members
    # are still in different components could hide a partner
    label = F.coalesce("component", "node")
    hub_row = stars.select("scheme", "gid", F.col("u").alias("node")).distinct()
    members = (stars.select("scheme", "gid", F.col("v").alias("node")).union(hub_row).distinct()
               .join(groups, "node", "left").select("scheme", "gid", "node", label.alias("label")))
    mixed = members.groupBy("scheme", "gid").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    open_hot = (members.join(mixed.select("scheme", "gid"), ["scheme", "gid"], "left_semi")
                .groupBy("scheme", "node").agg(F.count(F.lit(1)).alias("open")))
    wide = F.array(*[F.lit(bands.wide_segments(b)) for b in all_bands])
    tops = F.array(*[F.lit(bands.top(b)) for b in range((top_band or 0) + 2)])
    own = F.col("scheme") == F.col("band")
    largest = F.when(own, F.least(F.floor(F.col("n") * 100 / threshold), F.element_at(tops, (F.col("band") + 2).cast("int")))
                     ).otherwise(F.element_at(tops, F.greatest(F.col("band"), F.lit(1)).cast("int")))
    worst = F.floor((F.col("n") + largest) * (100 - threshold) / (100 + threshold))
    spare = F.when(of_band(by_neighbour), of_band(wide) - F.floor(worst / 2)).otherwise(of_band(segments) - worst)
    short = saved(room.join(open_hot, ["scheme", "node"], "left").join(hot, ["scheme", "node"], "left")
                  .where(spare <= F.col("lost") - F.coalesce("hot", F.lit(0)) + F.coalesce("open", F.lit(0)))
                  .select("node", "key").distinct())
    extra = _short_links(docs, short, classes, groups, links, threshold)
    if extra is not None:
        groups = components(links.union(extra))
    release(docs.sparkSession)

    edge = classes.select("node", "id").join(groups, "node")
    smallest = edge.groupBy("component").agg(F.min("id").alias("least"))
    named = edge.join(smallest, "component").select("node", "least")
    own = classes.select("node", F.col("id").alias("first_id"))
    return (nodes.select(F.col("id"), F.col("n").alias("n_shingles"), "node")
            .join(own, "node", "left").join(named, "node", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.coalesce("least", "first_id")).otherwise(F.col("id"))
                    .alias("component_id")))


def _counts(docs: DataFrame, slot, near) -> np.ndarray:
    """About how many of the wanted texts hold a shingle, by hash: a sketch of
    COUNTERS saturating counters, merged in 64 parts."""
    parts, each = 64, COUNTERS // 64

    def rows(batches):
        total = np.zeros(COUNTERS, np.uint32)
        for b in batches:
            for s in shingle_sets(column(near(b), "text")):
                np.add.at(total, (s >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64), 1)
        if total.any():
            low = np.minimum(total, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(parts), pa.int64()),
                 pa.array([low[i * each:(i + 1) * each].tobytes() for i in range(parts)], pa.binary())], ["part", "low"])

    def merge(key, table):
        total = np.zeros(each, np.uint32)
        for x in column(table, "low").to_pylist():
            total += np.frombuffer(x, np.uint8)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()),
                         "low": pa.array([np.minimum(total, 255).astype(np.uint8).tobytes()], pa.binary())})

    merged = (docs.select("text", slot).mapInArrow(rows, "part long, low binary").groupBy("part")
              .applyInArrow(merge, "part long, low binary").collect())        # 64 rows of 64 kB
    out = np.zeros(COUNTERS, np.uint8)
    for r in merged:
        out[r.part * each:(r.part + 1) * each] = np.frombuffer(bytes(r.low), np.uint8)
    return out


def _short_links(docs, short, classes, groups, links, threshold):
    """Links among short sets.  Rarest shingles come first in one order of all;
    a pair must share one of both sets' first n - ceil(t n) + 1, and from the
    places of the first such shingle on enough must be left in both.

    Who shares a shingle is compared with the smallest set among them first;
    then only pairs in different components remain, found by the few distinct
    (size, place) classes of a shingle before any rows are paired."""
    if short.limit(2).count() < 2:
        return None
    docs = docs.where("text is not null")
    slot, near = likely_in(short, "key")
    rank = docs.sparkSession.sparkContext.broadcast(_counts(docs, slot, near))

    def rows(batches):
        for b in batches:
            sig, node, size, place = [], [], [], []
            for s in shingle_sets(column(near(b), "text")):
                if not len(s):
                    continue
                times = rank.value[(s >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)]
                first = np.lexsort((s, times))[:len(s) - -(-threshold * len(s) // 100) + 1]
                sig.append(s[first].view(np.int64))
                node.append(np.full(len(first), set_hash(s), np.int64))
                size.append(np.full(len(first), len(s), np.int64))
                place.append(np.arange(len(first)))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sig, node, size, place)],
                                                 ["sig", "node", "n", "place"])

    probes = docs.select("text", slot).mapInArrow(rows, "sig long, node long, n long, place long").distinct()
    shared = probes.groupBy("sig").agg(F.count(F.lit(1)).alias("k"), F.min_by("node", F.struct("n", "node")).alias("hub"))
    probes = saved(probes.join(shared.where("k > 1").select("sig", "hub"), "sig"))
    ordered = [F.lit(-1).cast("long").alias("scheme"), F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]
    comp = lambda g, s: g.select(F.col("node").alias(s), F.col("component").alias(f"{s}c"))
    apart = F.coalesce("uc", "u") != F.coalesce("vc", "v")
    stars = (probes.select(F.col("hub").alias("u"), F.col("node").alias("v")).where("u <> v").distinct()
             .join(comp(groups, "u"), "u", "left").join(comp(groups, "v"), "v", "left").where(apart))
    found = _links(_sided(stars.select(*ordered).distinct(), classes), docs, threshold)
    groups = components(links.union(found))
    release(docs.sparkSession)

    members = saved(probes.join(groups, "node", "left").select(
        "sig", "node", "n", "place", F.coalesce("component", "node").alias("label")))
    kinds = members.groupBy("sig", "n", "place").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = members.groupBy("sig").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("sig")
    kinds = saved(kinds.join(mixed, "sig", "left_semi"))
    more = kinds.select("sig", *[F.col(c).alias(f"{c}2") for c in ("n", "place", "low", "high")])
    left = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    kinds = (kinds.join(more, "sig")
             .where((F.struct("n", "place") <= F.struct(F.col("n2").alias("n"), F.col("place2").alias("place")))
                    & (left * (100 + threshold) >= (F.col("n") + F.col("n2")) * threshold)
                    & ~((F.col("low") == F.col("high")) & (F.col("low2") == F.col("high2")) & (F.col("low") == F.col("low2"))))
             .select("sig", "n", "place", "n2", "place2"))
    kinds = saved(kinds)
    release(docs.sparkSession)
    # a pair is listed once, at the first of the shingles that both probe
    listed = members.join(kinds.select("sig").distinct(), "sig", "left_semi")
    bits = _parity_words(docs, classes.join(listed.select("node").distinct(), "node", "left_semi").select("key"))
    probed = listed.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sig"))),
                                                    lambda x: x["sig"]).alias("probed"))
    listed = saved(listed.join(probed.join(bits, "node"), "node"))
    side = lambda c, s: listed.select(
        "sig", F.col("n").alias(f"n{c}"), F.col("place").alias(f"place{c}"), F.col("node").alias(s),
        F.col("label").alias(f"{s}c"), F.col("probed").alias(f"{s}p"), F.col("bits").alias(f"{s}b"))
    differ = F.aggregate(F.zip_with("ub", "vb", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, x: t + x)
    pairs = (kinds.join(side("", "u"), ["sig", "n", "place"]).join(side("2", "v"), ["sig", "n2", "place2"])
             .where((F.col("uc") != F.col("vc"))
                    & (differ * (100 + threshold) <= (F.col("n") + F.col("n2")) * (100 - threshold)) & (F.get(F.array_intersect("up", "vp"), 0) == F.col("sig"))
                    & ((F.col("n") < F.col("n2")) | (F.col("place") < F.col("place2")) | (F.col("u") < F.col("v"))))
             .select(*ordered).distinct())
    return found.union(_links(_sided(pairs, classes), docs, threshold))
