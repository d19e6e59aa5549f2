"""Trie of conversation prefixes, from adaptive radix trees over turn ids.

A turn (role, text) has a fixed-width id, the first 16 bytes of its SHA-256, so a
conversation is a byte key.  Equal keys are counted first.  The distinct keys are
sorted over range partitions, and every task grows an adaptive radix tree of its
range: node layouts of 4, 16, 48 and 256 children, compressed paths.  Only byte
depths that are whole turns are nodes of the trie; a compressed path of several
turns holds several of them.

A hot prefix is cut by the ranges like any other.  Nodes that two neighbouring
tasks share lie on the common prefix of the keys at their border, so a task knows
them from the neighbours' border keys; it emits them as partial rows, and those
few are added up.  Everything a node sums (members, leaves, saved words) is
counted where its key, or its first key, lies.

A conversation of more than ``segment`` turns is cut into segments, each a key of
a tree of its own that hangs below the end of the one before it; what a lower tree
sums is handed up through suffix sums over segments.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from strata.llm.common import column, saved, shuffle_partitions

WIDTH = 16               # bytes of a turn id
SEGMENT = 256            # turns of a key at most
TASK_BYTES = 2_000_000   # of keys that a tree task gets, about
SMALL_ROWS = 200_000     # shared nodes up to which their table is broadcast (about 10 MB)
CHUNK = 4_096            # ids in a row of a hash that goes over several tasks
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_FULL = {4: 16, 16: 48, 48: 256}


class Node:
    """A radix tree node: the compressed path below its edge byte, the key that
    ends here (or -1), and children in a layout that grows with their number:
    4 and 16 keep sorted edge bytes, 48 an index by byte, 256 a slot per byte."""

    __slots__ = ("path", "value", "layout", "edges", "kids")

    def __init__(self, path: bytes, value: int = -1):
        self.path, self.value, self.layout = path, value, 4
        self.edges, self.kids = bytearray(), []

    def get(self, byte: int):
        if self.layout <= 16:
            at = self.edges.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            at = self.edges[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def put(self, byte: int, kid: "Node") -> None:
        if self.layout < 256 and len(self.kids) == self.layout:
            self._grow()
        if self.layout <= 16:
            at = sum(e < byte for e in self.edges)
            self.edges.insert(at, byte)
            self.kids.insert(at, kid)
        elif self.layout == 48:
            self.kids.append(kid)
            self.edges[byte] = len(self.kids)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        pairs, self.layout = list(self.items()), _FULL[self.layout]
        if self.layout == 48:
            self.edges, self.kids = bytearray(256), []
            for b, kid in pairs:
                self.put(b, kid)
        elif self.layout == 256:
            self.edges, self.kids = bytearray(), [None] * 256
            for b, kid in pairs:
                self.kids[b] = kid

    def items(self):
        """(edge byte, child) in byte order."""
        if self.layout <= 16:
            yield from zip(self.edges, self.kids)
        elif self.layout == 48:
            yield from ((b, self.kids[at - 1]) for b, at in enumerate(self.edges) if at)
        else:
            yield from ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


def insert(root: Node, key: bytes, value: int) -> None:
    node, at = root, 0
    while True:
        path = node.path
        if path:
            here = key[at:at + len(path)]
            if here != path:
                same = next((j for j, (x, y) in enumerate(zip(path, here)) if x != y), min(len(path), len(here)))
                lower = Node(path[same + 1:], node.value)
                lower.layout, lower.edges, lower.kids = node.layout, node.edges, node.kids
                node.path, node.value, node.layout, node.edges, node.kids = path[:same], -1, 4, bytearray(), []
                node.put(path[same], lower)
                at += same
            else:
                at += len(path)
        if at == len(key):
            node.value = value
            return
        kid = node.get(key[at])
        if kid is None:
            node.put(key[at], Node(key[at + 1:], value))
            return
        node, at = kid, at + 1


# ---------------------------------------------------------------- one tree
NODE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("conv", pa.int64()), ("n", pa.int64()),
                  ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("sha", pa.string()),
                  ("shared", pa.bool_()), ("top", pa.bool_()), ("pa", pa.int64()), ("pb", pa.int64()), ("parent", pa.int64())])
NODE_SCHEMA = ("a long, b long, depth long, conv long, n long, children long, leaves long, saved long, sha string, "
               "shared boolean, top boolean, pa long, pb long, parent long")


def _name(digest: str) -> tuple[int, int]:
    return int(digest[:15], 16), int(digest[16:31], 16)


class _Tree:
    """The keys of one tree (level, root) in a task, and its trie nodes.  ``left``
    and ``right`` are the turns that the first and last key share with the keys
    beyond the task's borders (-1: those belong to other trees)."""

    def __init__(self, level: int, ra: int, rb: int, segment: int):
        self.level, self.ra, self.rb, self.segment = level, ra, rb, segment
        self.root, self.rows = Node(b""), []

    def add(self, row: dict) -> None:
        insert(self.root, row["key"], len(self.rows))
        self.rows.append(row)

    def nodes(self, left: int, right: int):
        rows, last = self.rows, len(self.rows) - 1
        # post-order: (first key, last key, members, smallest, leaves, saved, heads) of each
        # radix node; heads: trie nodes first met below the node's edge
        order, stack = [], [(self.root, 0)]
        while stack:
            node, start = stack.pop()
            end = start + len(node.path)
            order.append((node, start, end))
            stack.extend((kid, end + 1) for _, kid in node.items())
        sums = {}
        for node, start, end in reversed(order):
            kids = [sums[id(kid)] for _, kid in node.items()]
            lo, hi = min([k[0] for k in kids], default=last + 1), max([k[1] for k in kids], default=-1)
            n, conv = sum(k[2] for k in kids), min([k[3] for k in kids], default=None)
            leaves, kept, heads = sum(k[4] for k in kids), sum(k[5] for k in kids), sum(k[6] for k in kids)
            if node.value >= 0:
                row = rows[node.value]
                lo, hi = min(lo, node.value), max(hi, node.value)
                n, conv = n + row["n"], row["conv"] if conv is None else min(conv, row["conv"])
                goes_on = node.value == last and right * WIDTH == len(row["key"])
                leaves += row["below_leaves"] + (not kids and not row["more"] and not goes_on)
                kept += row["below_saved"]
            words, found = rows[lo]["words"] if lo <= last else [], []
            first = -(-max(start, 1) // WIDTH)           # whole-turn depths on this node's path
            for d in range(end // WIDTH, first - 1, -1):
                old = lo == 0 and d <= left
                children = heads - (lo == 0 and d < left)
                kept += (n - (not old)) * words[d - 1]
                found.append((d, children, leaves, kept))
                heads = 1
            sums[id(node)] = (lo, hi, n, conv, leaves, kept, heads, found)
        lo, hi, n, conv, leaves, kept, heads, _ = sums[id(self.root)]
        below = self.level > 0                       # the tree's root is a node of the tree above
        cut = left >= 0 or right >= 0
        value = self.root.value
        yield (self.ra, self.rb, self.level * self.segment, None if below else conv, 0 if below else n,
               heads - (left > 0), leaves, kept, rows[value]["sha"] if value >= 0 and not below else None,
               below or cut, below, None, None, None)
        digest = hashlib.md5(b"%d:" % self.level)
        stack = [(self.root, digest, (self.ra, self.rb), conv, below or cut)]
        while stack:
            node, digest, name, above, shared_above = stack.pop()
            lo, hi, n, conv, leaves, _, _, found = sums[id(node)]
            for d, children, leaves, kept in reversed(found):
                key = rows[lo]["key"]
                digest = digest.copy()
                digest.update(key[(d - 1) * WIDTH:d * WIDTH])
                x, y = _name(digest.hexdigest())
                x, y = x ^ self.ra, y ^ self.rb
                own = rows[node.value] if node.value >= 0 and d * WIDTH == len(rows[node.value]["key"]) else None
                shared = (lo == 0 and d <= left) or (hi == last and d <= right) or bool(own and own["more"])
                yield (x, y, self.level * self.segment + d, conv, n, children, leaves, kept, own and own["sha"],
                       shared, False, *(name if shared_above else (None, None)), None if shared_above else above)
                name, above, shared_above = (x, y), conv, shared
            stack.extend((kid, digest, name, above, shared_above) for _, kid in node.items())


def _edges(df: DataFrame, columns: list[str]) -> list[dict]:
    """The first and last row of every partition that has rows, in order."""
    def ends(batches):
        first = last = None
        for b in batches:
            if b.num_rows:
                first = first or b.slice(0, 1).to_pylist()[0]
                last = b.slice(b.num_rows - 1, 1).to_pylist()[0]
        if first:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "last": last}], schema)

    df = df.select(*columns)
    fields = pa.struct([(c, pa.binary() if t == "binary" else pa.int64()) for c, t in df.dtypes])
    schema = pa.schema([("part", pa.int64()), ("first", fields), ("last", fields)])
    struct = "struct<" + ",".join(f"{c}: {t}" for c, t in df.dtypes) + ">"
    return sorted((r.asDict(recursive=True) for r in df.mapInArrow(ends, f"part long, first {struct}, last {struct}").collect()),
                  key=lambda r: r["part"])


def _common_turns(x: dict, y: dict) -> int:
    if (x["k"], x["ra"], x["rb"]) != (y["k"], y["ra"], y["rb"]):
        return -1
    n, a, b = 0, bytes(x["key"]), bytes(y["key"])
    while (n + 1) * WIDTH <= min(len(a), len(b)) and a[n * WIDTH:(n + 1) * WIDTH] == b[n * WIDTH:(n + 1) * WIDTH]:
        n += 1
    return n


def _grown(keys: DataFrame, segment: int, task_bytes: int) -> DataFrame:
    """Trie nodes (NODE) of distinct keys: k, ra, rb, key, words, n, conv, more,
    sha, below_leaves, below_saved."""
    by = ["k", "ra", "rb", "key"]
    size = keys.agg(F.coalesce(F.sum(F.octet_length("key") + 16), F.lit(0))).first()[0]
    keys = saved(keys.repartitionByRange(max(1, math.ceil(size / task_bytes)), *by).sortWithinPartitions(*by))
    edges = _edges(keys, by)                     # a row per partition
    near = {}
    for i, e in enumerate(edges):
        near[e["part"]] = (_common_turns(edges[i - 1]["last"], e["first"]) if i else -1,
                           _common_turns(e["last"], edges[i + 1]["first"]) if i + 1 < len(edges) else -1)
    held = keys.sparkSession.sparkContext.broadcast(near)

    def rows(batches):
        left, right = held.value.get(TaskContext.get().partitionId(), (-1, -1))
        tree, out = None, []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), NODE)], schema=NODE)

        for b in batches:
            for row in b.to_pylist():
                at = (row["k"], row["ra"], row["rb"])
                if tree is None or at != (tree.level, tree.ra, tree.rb):
                    if tree is not None:
                        for found in tree.nodes(left, -1):
                            out.append(found)
                            if len(out) == 10_000:
                                yield batch()
                                out.clear()
                        left = -1
                    tree = _Tree(*at, segment)
                tree.add(row)
        if tree is not None:
            for found in tree.nodes(left, right):
                out.append(found)
                if len(out) == 10_000:
                    yield batch()
                    out.clear()
        if out:
            yield batch()

    return saved(keys.mapInArrow(rows, NODE_SCHEMA))


# ---------------------------------------------------------------- conversations as keys
def _numbered(turns: DataFrame) -> DataFrame:
    """conv, id, words and the place of a turn in its conversation, over range
    partitions: a long conversation goes over several tasks."""
    by = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("id")]
    turns = saved(turns.repartitionByRange(shuffle_partitions(turns.sparkSession), *by).sortWithinPartitions(*by)
                  .select("conv", "id", "words"))

    def runs(batches):
        first = last = None
        n_first = n_last = 0
        for b in batches:
            for c in column(b, "conv").to_pylist():
                if first is None:
                    first = c
                n_first += c == first
                n_last = n_last + 1 if c == last else 1
                last = c
        if first is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "first": [first], "n_first": [n_first],
                                              "last": [last], "n_last": [n_last]})

    before, conv, so_far = {}, None, 0
    for r in sorted(turns.select("conv").mapInArrow(runs, "part long, first long, n_first long, last long, n_last long").collect()):
        before[r["part"]] = so_far if r["first"] == conv else 0
        so_far = r["n_last"] + (before[r["part"]] if r["first"] == r["last"] else 0)
        conv = r["last"]
    held = turns.sparkSession.sparkContext.broadcast(before)

    def number(batches):
        conv, place = None, held.value.get(TaskContext.get().partitionId(), 0) - 1
        for b in batches:
            places = []
            for c in column(b, "conv").to_pylist():
                place = place + 1 if c == conv or conv is None else 0
                conv = c
                places.append(place)
            yield b.append_column("pos", pa.array(places, pa.int64()))

    return turns.mapInArrow(number, "conv long, id string, words int, pos long")


def _rebuilt(turns: DataFrame) -> DataFrame:
    """conv, pos, id, words of rebuilt conversations; every conversation has one
    more row at pos -1, without a turn."""
    numbered = saved(_numbered(turns))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(4))
    base = F.col("conv") - F.col("conv") % 20
    sizes = saved(numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("size")))
    bases = sizes.where("conv % 20 = 0").select(F.col("conv").alias("base"), F.col("size").alias("has"))
    heads = numbered.where("conv % 20 = 0 and pos < 3").select(F.col("conv").alias("base"), "pos", "id", "words")
    first = (sizes.select("conv", h.alias("h"), base.alias("base")).join(heads, "base")
             .where("pos < h").select("conv", "pos", "id", "words"))
    own = (numbered.select("*", h.alias("h"), base.alias("base")).where("pos >= h").join(bases, "base", "left")
           .select("conv", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("has", F.lit(0)))).alias("pos"), "id", "words"))
    none = sizes.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("id"), F.lit(0).alias("words"))
    return first.union(own).union(none)


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """conv, k, key, words, more, and names: (ra, rb) of the tree it is a key of,
    (ka, kb) of the node where it ends."""
    turns = F.array_sort(F.collect_list(F.struct("pos", "id", "words")))
    found = (rows.groupBy("conv", F.floor(F.greatest("pos", F.lit(0)) / segment).alias("k")).agg(turns.alias("turns"))
             .select("conv", "k", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
                     F.transform(F.filter("turns", lambda t: t["pos"] >= 0), lambda t: t["words"]).alias("words")))
    digest = F.md5(F.concat(F.concat(F.col("k").cast("string"), F.lit(":")).cast("binary"), "key"))
    term = lambda at: F.when(F.octet_length("key") == 0, F.lit(0).cast("long")).otherwise(
        F.conv(F.substring(digest, at, 15), 16, 10).cast("long"))
    found = found.withColumn("ta", term(1)).withColumn("tb", term(17))
    w = Window.partitionBy("conv").orderBy("k")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    root = lambda c: F.coalesce(F.bit_xor(c).over(past), F.lit(0).cast("long"))
    return found.select("conv", "k", "key", "words", root("ta").alias("ra"), root("tb").alias("rb"), "ta", "tb",
                        F.lead("k").over(w).isNotNull().alias("more")).select(
        "conv", "k", "key", "words", "more", "ra", "rb", F.col("ra").bitwiseXOR(F.col("ta")).alias("ka"),
        F.col("rb").bitwiseXOR(F.col("tb")).alias("kb"))


def _end_hashes(segments: DataFrame) -> DataFrame:
    """(ka, kb, sha): SHA-256 of the ids that end at a node.  Groups inside one
    range partition are hashed there; those that reach over a border go on as rows
    of CHUNK ids, hashed in order by one stream each."""
    by = ["ka", "kb", "conv"]
    ends = segments.where("not more").select(*by)
    ends = saved(ends.repartitionByRange(shuffle_partitions(segments.sparkSession), *by).sortWithinPartitions(*by))
    edges = _edges(ends, ["ka", "kb"])
    near = {e["part"]: (edges[i - 1]["last"] if i else None, edges[i + 1]["first"] if i + 1 < len(edges) else None)
            for i, e in enumerate(edges)}
    held = segments.sparkSession.sparkContext.broadcast(near)
    schema = "ka long, kb long, part long, seq long, ids string, sha string"

    def rows(batches):
        part = TaskContext.get().partitionId()
        beyond = [None if e is None else (e["ka"], e["kb"]) for e in held.value.get(part, (None, None))]
        now, ids, seq, out = None, [], 0, []

        def put(closed):
            nonlocal seq
            if now is not None and ids:
                text = ",".join(map(str, ids))
                whole = now not in beyond
                if closed or not whole:
                    out.append((*now, part, seq, None if whole else text, hashlib.sha256(text.encode()).hexdigest() if whole else None))
                    seq += 1
                    ids.clear()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i > 3 else pa.int64()) for i, c in enumerate(zip(*out))],
                                              ["ka", "kb", "part", "seq", "ids", "sha"])
            out.clear()
            return made

        for b in batches:
            for a, z, c in zip(*(column(b, x).to_pylist() for x in by)):
                if (a, z) != now:
                    put(True)
                    now = (a, z)
                ids.append(c)
                if len(ids) >= CHUNK and now in beyond:
                    put(False)
            if out:
                yield batch()
        put(True)
        if out:
            yield batch()

    def joined(batches):
        now, state, out = None, None, []
        for b in batches:
            for a, z, ids in zip(*(column(b, x).to_pylist() for x in ("ka", "kb", "ids"))):
                if (a, z) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (a, z), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now is not None:
            out.append((*now, state.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["ka", "kb", "sha"])

    found = saved(ends.mapInArrow(rows, schema))
    open_ = (found.where("ids is not null").repartition("ka", "kb").sortWithinPartitions("ka", "kb", "part", "seq")
             .select("ka", "kb", "ids").mapInArrow(joined, "ka long, kb long, sha string"))
    return found.where("sha is not null").select("ka", "kb", "sha").union(open_)


def _below(keys: DataFrame, segments: DataFrame, segment: int, task_bytes: int) -> DataFrame:
    """(ka, kb, below_leaves, below_saved): what the trees below a key's end sum.
    A tree counts for the smallest conversation in it; along a conversation the
    trees of which it is the smallest are its last ones."""
    deep = keys.where("k > 0").withColumns({"below_leaves": F.lit(0).cast("long"), "below_saved": F.lit(0).cast("long")})
    sums = (_grown(deep, segment, task_bytes).where("top").groupBy(F.col("a").alias("ra"), F.col("b").alias("rb"))
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    through = segments.where("k > 0").select("conv", "k", "ra", "rb")
    owner = through.groupBy("ra", "rb").agg(F.min("conv").alias("owner"))
    on = Window.partitionBy("conv").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    mine = lambda c: F.sum(F.when(F.col("conv") == F.col("owner"), F.col(c)).otherwise(0)).over(on).alias(c)
    return (through.join(owner.join(sums, ["ra", "rb"]), ["ra", "rb"]).select("ra", "rb", mine("leaves"), mine("saved"))
            .groupBy(F.col("ra").alias("ka"), F.col("rb").alias("kb"))
            .agg(F.sum("leaves").alias("below_leaves"), F.sum("saved").alias("below_saved")))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Shared nodes added up; then each node gets its parent's conversation."""
    of_top = lambda c: F.sum(F.when(~F.col("top"), F.col(c))).alias(c)
    shared = saved(nodes.where("shared").groupBy("a", "b").agg(
        F.max("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("children").alias("children"),
        of_top("leaves"), of_top("saved"), F.max("sha").alias("sha"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("parent").alias("parent")))
    columns = ["depth", "conv", "n", "children", "leaves", "saved", "sha", "pa", "pb", "parent"]
    rows = nodes.where("not shared").select(*columns).union(shared.select(*columns))
    settled, waiting = rows.where("pa is null"), rows.where("pa is not null").drop("parent")
    names = shared.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent"))
    if names.count() <= SMALL_ROWS:
        waiting = waiting.join(F.broadcast(names), ["pa", "pb"])
    else:
        # a parent of very many children meets them in 32 parts
        waiting = (waiting.withColumn("part", F.pmod(F.xxhash64("conv", "depth", "saved"), F.lit(32)).cast("int"))
                   .join(names.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(31)))), ["pa", "pb", "part"]))
    return settled.select(*columns).union(waiting.select(*columns))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", segment: int = SEGMENT, task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Conversation ids are integers; rows without one belong to no conversation.  A
    null turn comes first; rows of one turn number come in the order of their ids
    (hashes of role and text); repeated rows are turns of their own.  Null role and text are
    empty.  An empty table has no nodes; other columns are ignored."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.substring(F.sha2(named, 256), 1, 2 * WIDTH).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).where("conv is not null")
    segments = saved(_segments(_rebuilt(turns), segment))
    keys = segments.groupBy("k", "ra", "rb", "ka", "kb").agg(
        F.first("key").alias("key"), F.first("words").alias("words"), F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("conv"), F.max("more").alias("more"))
    keys = keys.join(_end_hashes(segments), ["ka", "kb"], "left")
    if segments.where("k > 0").limit(1).count():
        keys = saved(keys)
        keys = keys.join(_below(keys, segments, segment, task_bytes).withColumn("more", F.lit(True)), ["ka", "kb", "more"], "left")
    else:
        keys = keys.withColumns({"below_leaves": F.lit(None).cast("long"), "below_saved": F.lit(None).cast("long")})
    keys = keys.fillna(0, ["below_leaves", "below_saved"])
    rows = _with_parents(_grown(keys, segment, task_bytes))
    return rows.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                       F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
