"""Text scores by a probabilistic suffix tree over words.

States are contexts of up to two words.  A context of enough training
occurrences is kept if its next-word distribution diverges from that of its
suffix: the divergence is taken leave-one-out, n(s) mean log ratio of

    P_s(x) = (c(sx) + w n(s) P_suffix(x)) / (n(s) + w n(s))

to P_suffix(x), each occurrence predicted from the others.  The weight ``w`` of
the suffix is the best of WEIGHTS; a state whose best divergence is not positive
is cut, with all longer contexts that end in it.  The root is add-one smoothed
with one share for unknown words, so every state's probabilities sum to one.  A
word is scored by the longest kept suffix of the words before it.

Counts never pass through one task.  Texts become blocks of word numbers, once.
A block asks for the corpus counts of its distinct words, word pairs and, behind
frequent contexts, word triples: sorted 64-bit hashes, cut by bucket, one row per
bucket.  A bucket adds the blocks' counts and answers each in the order asked; one
block is told to own each key, so sums over a state's next words are taken once.
What a bucket holds is bounded by the number of buckets, which follows the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, functions as F

from strata.llm.common import column, saved, shuffle_partitions
from strata.llm.packed import spread, spread_sorted, squeeze, squeeze_sorted
from strata.llm.shingles import BLOCK, _words, mix64, word_hashes

DEPTH = 2                # words of the longest context
WEIGHTS = (1 / 16, 1 / 4, 1.0, 4.0)
BLOCK_TOKENS = 1_500_000  # words that a block holds at most
BUCKET_KEYS = 1_000_000  # hashes that a bucket is asked for, about
END = np.uint64(0x5EED0F7E27000001)
_M = np.uint64(0x9E3779B97F4A7C15)
_U32 = np.uint64(32)


# ---------------------------------------------------------------- blocks of texts
def _rows_of_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes of every row, many short rows at once."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        if j == i + 1:
            yield word_hashes(data[lo:hi].tobytes())
        else:
            w, at = _words(data[lo:hi], offsets[i:j + 1] - lo)
            for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
                yield w[a:z]
        i = j


def _by_frequency(times: np.ndarray) -> np.ndarray:
    return np.argsort(-times.astype(np.int64), kind="stable")


def _blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """docs (id, held, text) as blocks of pieces; a piece of a longer text starts
    with the DEPTH words before it, which it does not count (``carry``)."""
    def rows(batches):
        task, made, row, pieces, waiting, schema = TaskContext.get().partitionId(), 0, 0, [], 0, None

        def block():
            t = np.concatenate([p[2] for p in pieces])
            words, number, times = np.unique(t, return_inverse=True, return_counts=True)
            # frequent words get small numbers, which cost fewer bytes
            number = np.argsort(_by_frequency(times))[number]
            real = [len(p[2]) - p[3] for p in pieces]
            return pa.RecordBatch.from_pylist([{
                "block": task << 32 | made, "n": sum(real), "train": sum(n for n, p in zip(real, pieces) if not p[1]),
                "rows": [task << 32 | p[4] for p in pieces], "ids": [p[0] for p in pieces],
                "held": np.array([p[1] for p in pieces], np.uint8).tobytes(),
                "sizes": np.array([len(p[2]) for p in pieces], np.int64).tobytes(),
                "carry": np.array([p[3] for p in pieces], np.uint8).tobytes(),
                "words": squeeze_sorted(words), "times": squeeze(times.astype(np.uint32)), "numbers": squeeze(number.astype(np.uint32))}], schema)

        for b in batches:
            ids, held = column(b, "id").to_pylist(), column(b, "held").to_pylist()
            schema = pa.schema([("block", pa.int64()), ("n", pa.int64()), ("train", pa.int64()),
                                ("rows", pa.list_(pa.int64())), ("ids", pa.list_(b.schema.field("id").type)),
                                *((c, pa.binary()) for c in ("held", "sizes", "carry", "words", "times", "numbers"))])
            for i, w in enumerate(_rows_of_words(column(b, "text"))):
                w = np.append(w, END)
                for a in range(0, len(w), block_tokens):
                    carry = min(a, DEPTH)
                    piece = w[a - carry:a + block_tokens]
                    if pieces and waiting + len(piece) > block_tokens:
                        yield block()
                        made, pieces, waiting = made + 1, [], 0
                    pieces.append((ids[i], held[i], piece, carry, row))
                    waiting += len(piece)
                row += 1
        if pieces:
            yield block()

    return docs.mapInArrow(rows, f"block long, n long, train long, rows array<long>, ids array<{dict(docs.dtypes)['id']}>, "
                                 "held binary, sizes binary, carry binary, words binary, times binary, numbers binary")


class _Block:
    """A block's words, and its distinct words, pairs and triples as keys."""

    def __init__(self, table: pa.Table, depth: int):
        get = lambda c: column(table, c)[0].as_py()
        self.block, self.rows, self.ids = get("block"), column(table, "rows").flatten(), column(table, "ids").flatten()
        self.words = spread_sorted(get("words"))
        at = _by_frequency(spread(get("times"), np.uint32)).astype(np.int32)
        self.number = at[spread(get("numbers"), np.uint32)]
        self.held = np.frombuffer(get("held"), np.uint8).astype(bool)
        sizes, carry = np.frombuffer(get("sizes"), np.int64), np.frombuffer(get("carry"), np.uint8).astype(np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.place = (np.arange(len(self.number)) - np.repeat(self.starts, sizes)).astype(np.int32)
        self.real = self.place >= np.repeat(carry, sizes)
        self.train = self.real & ~np.repeat(self.held, sizes)
        t = self.words[self.number]
        run = t
        self.keys, self.of, self.first = [self.words], [self.number], [None]
        for k in range(1, depth + 1):
            # a word with k words before it; ``of`` is -1 elsewhere
            run = np.concatenate((t[:k], mix64(run[k - 1:-1] * _M + t[k:])))
            at = np.flatnonzero(self.place >= k)
            keys, first, inverse = np.unique(run[at], return_index=True, return_inverse=True)
            of = np.full(len(t), -1, np.int32)
            of[at] = inverse
            del inverse
            self.keys.append(keys)
            self.of.append(of)
            self.first.append(at[first].astype(np.int32))

    def counts(self, k: int) -> np.ndarray:
        at = self.of[k][self.train & (self.place >= k)]
        return np.bincount(at, minlength=len(self.keys[k])).astype(np.uint32)


# ---------------------------------------------------------------- questions
ASK = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.int64()), ("keys", pa.binary()),
                 ("values", pa.binary())])
ASK_SCHEMA = "bucket long, block long, kind long, keys binary, values binary"
ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int64()), ("bucket", pa.int64()), ("found", pa.binary()),
                    ("owns", pa.binary()), ("distinct", pa.int64())])
ANSWER_SCHEMA = "block long, kind long, bucket long, found binary, owns binary, distinct long"


def _ask(block: int, kind: int, keys: np.ndarray, values: np.ndarray, n_buckets: int) -> Iterator[dict]:
    """One row per bucket: sorted keys and what the block knows of them."""
    bucket = ((keys >> _U32) * np.uint64(n_buckets)) >> _U32
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.empty(0, np.int64)
    for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(keys)]):
        yield {"bucket": int(bucket[a]) * 8 + kind, "block": block, "kind": kind,
               "keys": squeeze_sorted(keys[a:z]), "values": squeeze(values[a:z])}


def _answers(asked: DataFrame) -> DataFrame:
    """Corpus values of the keys asked for, per (block, bucket) in the order asked.
    Kinds 0 to 2 add up counts; kinds 4 and 5 add up divergences by weight and
    answer with the number of the best weight, 0 if none is positive."""
    def reduce(key, table):
        kind = column(table, "kind")[0].as_py()
        keys = [spread_sorted(x) for x in column(table, "keys").to_pylist()]
        form = np.dtype(np.uint32) if kind < 4 else np.dtype((np.float32, len(WEIGHTS)))
        values = np.concatenate([spread(x, form.base).reshape(-1, *form.shape) for x in column(table, "values").to_pylist()])
        one = np.concatenate(keys)
        order = np.argsort(one, kind="stable")
        one = one[order]
        start = np.flatnonzero(np.concatenate(([True], one[1:] != one[:-1])))
        size = np.diff(start, append=len(one))
        total = np.add.reduceat(values[order].astype(np.int64 if kind < 4 else np.float64), start)
        if kind < 4:
            result, distinct = total.astype(np.uint64), int((total > 0).sum())
        else:
            best = total.argmax(axis=1)
            result, distinct = np.where(total.max(axis=1) > 0, best + 1, 0).astype(np.uint8), 0
        found, owns = np.empty(len(one), result.dtype), np.zeros(len(one), np.uint8)
        found[order] = np.repeat(result, size)
        owns[order[start]] = 1
        out, at = [], 0
        for block, k in zip(column(table, "block").to_pylist(), keys):
            z = at + len(k)
            out.append({"block": block, "kind": kind, "bucket": key[0].as_py(), "found": squeeze(found[at:z]),
                        "owns": np.packbits(owns[at:z]).tobytes() if kind < 4 else None, "distinct": distinct if not at else 0})
            at = z
        return pa.Table.from_pylist(out, ANSWER)

    return asked.groupBy("bucket").applyInArrow(reduce, ANSWER_SCHEMA)


def _heard(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray | None]]:
    """kind -> (values, owns) of a block, in the order of its keys."""
    parts: dict[int, list] = {}
    for r in sorted(table.to_pylist(), key=lambda r: r["bucket"]):
        found = spread(r["found"], np.uint64 if r["kind"] < 4 else np.uint8)
        owns = np.unpackbits(np.frombuffer(r["owns"], np.uint8), count=len(found)) if r["owns"] is not None else None
        parts.setdefault(r["kind"], []).append((found, owns))
    return {k: (np.concatenate([x[0] for x in v]), np.concatenate([x[1] for x in v]).astype(bool) if k < 4 else None)
            for k, v in parts.items()}


def _divergence(c, n, p) -> np.ndarray:
    """Sum over c occurrences of the log ratio to the suffix's p, by weight."""
    c, n, p = (np.asarray(x, np.float64)[:, None] for x in (c, n, p))
    w = np.array(WEIGHTS) * n
    return (c * np.log((c - 1 + w * p) / ((n - 1 + w) * p))).astype(np.float32)


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    sums = np.stack([np.bincount(at, values[:, i], n) for i in range(values.shape[1])], 1).astype(np.float32)
    # 16 significant bits are enough to choose a weight; the last byte plane is zero
    return (sums.view(np.uint32) & np.uint32(0xFFFFFF00)).view(np.float32)


def _mixed(c, n, choice, p) -> np.ndarray:
    """P of a state from its suffix's p; where the state is cut, p."""
    w = np.array((0.0, *WEIGHTS))[choice]
    return np.where(choice > 0, (c + w * n * p) / np.where(choice > 0, n + w * n, 1), p)


class _Known(_Block):
    """A block with the corpus values it was told."""

    def __init__(self, table: pa.Table, answers: pa.Table, total: int, distinct: int, min_count: int, depth: int = DEPTH):
        super().__init__(table, depth)
        self.heard, self.min = _heard(answers), min_count
        zero = lambda k: (np.zeros(len(self.keys[k]), np.uint64), np.zeros(len(self.keys[k]), bool))
        self.c = [self.heard.get(k, zero(k))[0].astype(np.float64) for k in range(2)]
        self.p0 = (self.c[0] + 1) / (total + distinct + 1)

    def frequent(self, k: int) -> np.ndarray:
        """Distinct k-word runs that occur often enough to be a state's context."""
        return np.flatnonzero(self.c[k - 1] >= self.min)

    def owned(self, k: int):
        """(place of an owned run of k+1 words, its count, its context, the context's count)."""
        found, owns = self.heard.get(k, (np.empty(0), np.empty(0, bool)))
        return found, owns

    def one_word(self):
        """Weight numbers of all words as contexts (0: cut); for each distinct pair
        that of its first word, and P of the second word behind the first."""
        at = self.first[1]
        v, x = self.number[at - 1], self.number[at]
        kept = np.zeros(len(self.words), np.uint8)
        if 4 in self.heard:
            kept[self.frequent(1)] = self.heard[4][0]
        return kept, kept[v], _mixed(self.c[1], self.c[0][v], kept[v], self.p0[x])

    def pairs(self, kept: np.ndarray) -> np.ndarray:
        """Numbers of the pairs that can be contexts: frequent, their last word kept."""
        return np.flatnonzero((self.c[1] >= self.min) & (kept[self.number[self.first[1]]] > 0))

    def behind(self) -> np.ndarray:
        """Numbers of the triples behind a frequent pair: those that are asked for."""
        at = self.first[2]
        return np.flatnonzero(self.c[1][self.of[1][at - 1]] >= self.min)


def _cogrouped(blocks: DataFrame, answers: DataFrame, fn, schema: str) -> DataFrame:
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(fn, schema)


def suffix_tree_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = 8,
                       block_tokens: int = BLOCK_TOKENS, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) mod 7 is 2 are held out; a null id is not.  A
    null or empty text has its end only.  Repeated rows and ids are ordinary rows;
    other columns are ignored; an empty table gives no rows.  An id column with the
    name of a result column comes out as document_id.  ``min_count``:
    occurrences that a context needs to be a state."""
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))
    texts = docs.select(F.col(id_col).alias("id"), held.alias("held"), F.col(text_col).cast("string").alias("text"))
    kind = dict(texts.dtypes)["id"]
    if id_col in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "row"):
        id_col = "document_id"
    blocks = (_blocks(texts, block_tokens).repartition(shuffle_partitions(spark), "block")
              .persist(StorageLevel.MEMORY_AND_DISK))
    size = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("train"), F.lit(0)).alias("train")).first()
    total, n_buckets = int(size["train"]), max(4, math.ceil(size["n"] / bucket_keys))

    def count(batches):
        for b in batches:
            for i in range(b.num_rows):
                own = _Block(pa.Table.from_batches([b.slice(i, 1)]), 1)
                yield pa.RecordBatch.from_pylist(
                    [r for k in (0, 1) for r in _ask(own.block, k, own.keys[k], own.counts(k), n_buckets)], ASK)

    first = saved(_answers(blocks.mapInArrow(count, ASK_SCHEMA)))
    distinct = int(first.where("kind = 0").agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0])

    def grow(left, right):
        """Divergences of one-word contexts; counts of triples behind frequent pairs."""
        own = _Known(left, right, total, distinct, min_count)
        found, owns = own.owned(1)
        at = own.first[1]
        use = np.flatnonzero(owns & (found > 0)) if len(at) else np.empty(0, np.int64)
        v, x = own.number[at[use] - 1], own.number[at[use]]
        keep = own.c[0][v] >= min_count
        v, x, c = v[keep], x[keep], found[use[keep]]
        sums = _sums(v, _divergence(c, own.c[0][v], own.p0[x]), len(own.words))
        often, triples = own.frequent(1), own.behind()
        return pa.Table.from_pylist(
            [*_ask(own.block, 4, own.keys[0][often], sums[often], n_buckets),
             *_ask(own.block, 2, own.keys[2][triples], own.counts(2)[triples], n_buckets)], ASK)

    second = saved(_answers(_cogrouped(blocks, first, grow, ASK_SCHEMA)))
    known = first.unionByName(second)

    def grow_again(left, right):
        """Divergences of two-word contexts whose suffix is kept."""
        own = _Known(left, right, total, distinct, min_count)
        triples, (found, owns) = own.behind(), own.owned(2)
        words, kept, p = own.one_word()
        use = np.flatnonzero(owns & (found > 0)) if len(triples) else np.empty(0, np.int64)
        at = own.first[2][triples[use]]
        context, pair = own.of[1][at - 1], own.of[1][at]
        keep = kept[pair] > 0
        context, pair, c = context[keep], pair[keep], found[use[keep]]
        sums = _sums(context, _divergence(c, own.c[1][context], p[pair]), len(own.keys[1]))
        often = own.pairs(words)
        return pa.Table.from_pylist([*_ask(own.block, 5, own.keys[1][often], sums[often], n_buckets)], ASK)

    third = _answers(_cogrouped(blocks, known, grow_again, ASK_SCHEMA))

    def score(left, right):
        own = _Known(left, right, total, distinct, min_count)
        words, kept, p = own.one_word()
        two = np.zeros(len(own.keys[1]), np.uint8)
        if 5 in own.heard:
            two[own.pairs(words)] = own.heard[5][0]
        value = own.p0[own.number]
        base = np.log10(value)
        has = own.place >= 1
        value[has] = p[own.of[1][has]]
        triples, (found, _) = own.behind(), own.owned(2)
        if len(triples):
            at = own.first[2][triples]
            context, pair = own.of[1][at - 1], own.of[1][at]
            better = np.full(len(own.keys[2]), -1.0)
            better[triples] = np.where(two[context] > 0, _mixed(
                found.astype(np.float64), own.c[1][context], two[context], p[pair]), -1.0)
            deep = np.flatnonzero(own.place >= 2)
            own_p = better[own.of[2][deep]]
            value[deep] = np.where(own_p >= 0, own_p, value[deep])
        real = own.real
        add = lambda a: np.add.reduceat(np.where(real, a, 0), own.starts)
        return pa.table({"row": own.rows, "id": own.ids, "held": own.held, "n_tokens": add(np.ones(len(value), np.int64)),
                         "n_known": add((own.c[0][own.number] > 0).astype(np.int64)), "base": add(base),
                         "score": add(np.log10(value))})

    scores = _cogrouped(blocks, known.unionByName(third), score,
                        f"row long, id {kind}, held boolean, n_tokens long, n_known long, base double, score double")
    result = saved(scores.groupBy("row").agg(
        F.first("id").alias(id_col), F.first("held").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score")).drop("row"))
    blocks.unpersist()
    return result
