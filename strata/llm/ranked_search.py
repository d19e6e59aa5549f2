"""Ranked search of many items at once, sharing what their queries have in common.

Items are evaluated together.  Terms that occur in exactly the same items form
one shared set; pairs of sets that several items share are then merged step by
step, the pair of most items first, so an item becomes a sum of few nodes of a
DAG.  For a group of documents the accumulators of all nodes are filled once, level by
level, and an item's score is the sum of its nodes.

Texts are split once: of a document only the terms that some item holds remain,
with their counts.  Corpus statistics come from these postings and the lengths.
Items go in blocks of at most BLOCK_TERMS terms, so what a task holds is bounded
whatever the number of items; each block costs one pass over the documents.  A task
keeps an item's best rows so far; the tasks' lists meet in two rounds.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.common import column, saved

TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")     # the same on UTF-8
BLOCK_TERMS = 200_000    # item terms that one pass evaluates
ACCUMULATORS = 4_000_000  # numbers that a task's accumulators hold
CHUNK = 1 << 20          # bytes of text that are split at once
MINED = 1000             # sets of an item up to which its pairs are mined; a larger item is summed as it is


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z lowered, a bounded number at a time."""
    lo = 0
    while lo < len(text):
        hi = min(len(text), lo + CHUNK)
        if hi < len(text):
            rest = _TERM.match(text, hi)
            hi = rest.end() if rest else hi
        yield _TERM.findall(text[lo:hi].lower())
        lo = hi


class SharedQueries:
    """The DAG.  Nodes 0.. are terms; ``steps`` add nodes to new ones, level by
    level: (targets, first addends, second addends); ``parts`` of each item are
    the nodes whose sum is its score."""

    def __init__(self, items: list[list[int]], n_terms: int):
        holders = defaultdict(list)
        for i, ts in enumerate(items):
            for t in ts:
                holders[t].append(i)
        sets = defaultdict(list)
        for t in range(n_terms):
            sets[tuple(holders[t])].append(t)
        self.size, self.level, added = n_terms, [0] * n_terms, []
        parts = [set() for _ in items]
        for who, members in sets.items():
            if who:
                node = self._sum(members, added)
                for i in who:
                    parts[i].add(node)
        self._merge(parts, added)
        self.parts = [self._sum(sorted(p), added) if p else None for p in parts]
        by_level = defaultdict(list)
        for node, a, b in added:
            by_level[self.level[node]].append((node, a, b))
        self.steps = [tuple(np.array(x) for x in zip(*by_level[k])) for k in sorted(by_level)]

    def _add(self, a: int, b: int, added: list) -> int:
        added.append((self.size, a, b))
        self.level.append(max(self.level[a], self.level[b]) + 1)
        self.size += 1
        return self.size - 1

    def _sum(self, nodes: list[int], added: list) -> int:
        """One node for the sum of all, as a balanced tree."""
        while len(nodes) > 1:
            nodes = [self._add(*nodes[i:i + 2], added) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    def _merge(self, parts: list[set[int]], added: list) -> None:
        """While two nodes occur together in several items, one node stands for both
        there; the pair of most items goes first."""
        where = defaultdict(set)
        for i, p in enumerate(parts):
            for node in p if len(p) <= MINED else ():
                where[node].add(i)
        shared = {n: w for n, w in where.items() if len(w) > 1}

        def partners(node):
            near = Counter(m for i in shared[node] for m in parts[i] if m != node and m in shared)
            return [(-k, min(node, m), max(node, m)) for m, k in near.items() if k > 1]

        heap = sorted({p for n in shared for p in partners(n)})
        while heap:
            k, a, b = heapq.heappop(heap)
            both = shared.get(a, set()) & shared.get(b, set())
            if len(both) < 2:
                continue
            if len(both) != -k:
                heapq.heappush(heap, (-len(both), a, b))
                continue
            node = self._add(a, b, added)
            shared[node] = set(both)
            for i in both:
                parts[i] -= {a, b}
                parts[i].add(node)
            shared[a] -= both
            shared[b] -= both
            for p in partners(node):
                heapq.heappush(heap, p)

    def scores(self, impact: np.ndarray) -> np.ndarray:
        """(items, documents) from (terms, documents)."""
        acc = np.empty((self.size, impact.shape[1]), np.int64)
        acc[:len(impact)] = impact
        for target, a, b in self.steps:
            acc[target] = acc[a] + acc[b]
        out = np.zeros((len(self.parts), impact.shape[1]), np.int64)
        for i, node in enumerate(self.parts):
            if node is not None:
                out[i] = acc[node]
        return out


def _postings(docs: DataFrame, wanted: list[bytes]) -> DataFrame:
    """(id, n, at, tf): a document's number of terms, and numbers and counts of the
    wanted ones; documents without terms are left out."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def rows(batches):
        number = {t: i for i, t in enumerate(held.value)}
        for b in batches:
            n, at, tf = [], [], []
            for text in column(b, "text"):
                found, length = Counter(), 0
                for part in terms((text.as_py() or "").encode()):
                    length += len(part)
                    found.update(map(number.get, part))
                found.pop(None, None)
                n.append(length)
                at.append(np.fromiter(found.keys(), np.uint32, len(found)).tobytes())
                tf.append(np.fromiter(found.values(), np.uint32, len(found)).tobytes())
            some = pa.array([x > 0 for x in n], pa.bool_())
            yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(n, pa.int64()), pa.array(at, pa.binary()),
                                              pa.array(tf, pa.binary())], ["id", "n", "at", "tf"]).filter(some)

    return docs.mapInArrow(rows, f"id {dict(docs.dtypes)['id']}, n long, at binary, tf binary")


def _document_counts(postings: DataFrame, n_terms: int) -> np.ndarray:
    """df of the block's terms: at most BLOCK_TERMS rows come back."""
    def rows(batches):
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(column(b, "at").to_pylist()), np.uint32), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in postings.select("at").mapInArrow(rows, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    return df


class _Best:
    """The k best rows of every item so far: score descending, id ascending."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)     # scores below are out
        self.item, self.score, self.ids, self.waiting = np.empty(0, np.int64), np.empty(0, np.int64), [], []
        self.room = 0

    def offer(self, scores: np.ndarray, ids: list) -> None:
        item, doc = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        self.waiting.append((item, scores[item, doc], [ids[d] for d in doc.tolist()]))
        self.room += len(item)
        if self.room > 4 * self.k * len(self.least) + 10_000:
            self.compact()

    def compact(self) -> None:
        item = np.concatenate([self.item, *(w[0] for w in self.waiting)])
        score = np.concatenate([self.score, *(w[1] for w in self.waiting)])
        ids = self.ids + [i for w in self.waiting for i in w[2]]
        rank = {i: r for r, i in enumerate(sorted({i for i in ids if i is not None}))}
        place = np.array([rank.get(i, len(rank)) for i in ids], np.int64)
        order = np.lexsort((place, -score, item))
        start = np.flatnonzero(np.concatenate(([True], item[order][1:] != item[order][:-1])))[:len(order)]
        nth = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
        full = order[nth == self.k - 1]
        self.least[item[full]] = score[full]
        order = order[nth < self.k]
        self.item, self.score, self.ids = item[order], score[order], [ids[i] for i in order.tolist()]
        self.waiting, self.room = [], 0


def _local_best(postings: DataFrame, queries: SharedQueries, weight: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    held = postings.sparkSession.sparkContext.broadcast((queries, weight))
    kind = dict(postings.dtypes)["id"]

    def rows(batches):
        queries, weight = held.value
        best, width = _Best(len(queries.parts), k), max(1, ACCUMULATORS // max(1, queries.size))
        schema = None
        for b in batches:
            schema = b.schema.field("id").type
            ids, n = column(b, "id").to_pylist(), column(b, "n").to_numpy()
            at, tf = column(b, "at").to_pylist(), column(b, "tf").to_pylist()
            for lo in range(0, len(ids), width):
                hi = min(len(ids), lo + width)
                term = np.frombuffer(b"".join(at[lo:hi]), np.uint32)
                times = np.frombuffer(b"".join(tf[lo:hi]), np.uint32).astype(np.int64)
                doc = np.repeat(np.arange(hi - lo), [len(x) // 4 for x in at[lo:hi]])
                m = 50 + (50 * n[lo:hi] * n_docs) // length
                impact = np.zeros((len(weight), hi - lo), np.int64)
                impact[term, doc] = weight[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
                best.offer(queries.scores(impact), ids[lo:hi])
        if schema is not None:
            best.compact()
            yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.ids, schema), pa.array(best.score)],
                                             ["item", "id", "score"])

    return postings.mapInArrow(rows, f"item long, id {kind}, score long")


def _blocks_of(items: DataFrame) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Items with their terms, in blocks of at most about BLOCK_TERMS of them."""
    ids, own, size = [], [], 0
    for r in items.toLocalIterator():
        found = {t for part in terms((r.text or "").encode()) for t in part}
        if ids and ids[-1] == r.item:
            own[-1] |= found                     # rows of one item id are one item
            continue
        if ids and size > BLOCK_TERMS:
            yield ids, own
            ids, own, size = [], [], 0
        ids.append(r.item)
        own.append(found)
        size += len(found)
    if ids:
        yield ids, own


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of each item: item id, rank, document id, score.

    A null or empty text has no terms: such documents are not counted, such items
    find nothing.  Rows with one item id (null included) are one item of all their
    terms.  Rows that repeat a document id are documents of their own; a null id
    comes after all others of equal score.  Ids may have any type that sorts.
    Other columns are ignored; an empty table on either side gives no rows.  An id
    column whose name is taken (rank, score, the other id's) comes out as item_id or
    document_id."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text")).orderBy("item")
    spark, found = docs.sparkSession, None
    item_kind, doc_kind = dict(asked.dtypes)["item"], dict(texts.dtypes)["id"]
    if item_col in ("rank", "score", id_col):
        item_col = "item_id"
    if id_col in ("rank", "score", item_col):
        id_col = "document_id"
    for names, own in _blocks_of(asked):
        wanted = sorted({t for ts in own for t in ts})
        if not wanted:
            continue
        postings = saved(_postings(texts, wanted))
        size = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not size[0]:
            break
        n_docs, length = int(size[0]), int(size[1])
        df = _document_counts(postings, len(wanted))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        number = {t: i for i, t in enumerate(wanted)}
        queries = SharedQueries([sorted(number[t] for t in ts) for ts in own], len(wanted))
        best = _local_best(postings, queries, weight, n_docs, length, k)
        # lists of sqrt(tasks) tasks meet first, then those of one item
        groups = max(1, math.isqrt(postings.rdd.getNumPartitions()))
        order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
        best = best.withColumn("part", F.spark_partition_id() % groups)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        named = spark.createDataFrame(list(enumerate(names)), f"item long, name {item_kind}")
        part = best.join(F.broadcast(named), "item").select(
            F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {doc_kind}, score long")
    return found
