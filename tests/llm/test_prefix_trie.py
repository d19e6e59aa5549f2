import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from strata.llm import prefix_trie as pt
from strata.llm.prefix_trie import Node, insert, prefix_trie

TABLE = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes from all prefixes of all rebuilt conversations."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            ident = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            turns[c].append(((t is not None, t or 0, ident), (role, text)))
    own = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])
        seq = tuple(base[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, kept = defaultdict(int), defaultdict(int)
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            kept[node[:d]] += (len(members[node]) - 1) * words
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children[node]), leaves[node], kept[node],
                   hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, m in members.items())


def got(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def made(seed, n=90, turns=9, stock=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(0, 300), n):
        for t in range(r.randrange(turns)):
            rows.append((c, t, r.choice(["user", None, "x"]) if stock > 2 else "u", r.choice(["", None, "A b", "one two  three"])
                         if r.random() < 0.6 else f"t{r.randrange(stock)}"))
    return rows


@pytest.mark.parametrize("seed, segment, task_bytes", [(1, 256, 2_000_000), (2, 2, 100), (3, 1, 60), (4, 3, 400)])
def test_equals_all_prefixes(spark, seed, segment, task_bytes):
    rows = made(seed) + [(400, t, "u", "same") for t in range(40)] + [(c, t, "u", "same") for c in (420, 440, 461) for t in range(9)]
    df = spark.createDataFrame(rows, TABLE).repartition(5)
    assert got(prefix_trie(df, segment=segment, task_bytes=task_bytes)) == brute(rows)


def test_hot_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 3)
    rows = [(c, t, "u", f"{t}") for c in range(0, 1200, 20) for t in range(2)] + [(c, 0, "u", "0") for c in range(2000, 2400, 20)]
    df = spark.createDataFrame(rows, TABLE)
    assert got(prefix_trie(df, task_bytes=40)) == brute(rows)


def test_nulls_ties_and_turnless(spark):
    rows = [(0, None, "u", "first"), (0, 1, "u", "b"), (0, 1, "a", "c"), (0, 1, "a", "c"), (None, 0, "u", "x"),
            (7, 0, None, None), (7, 5, "", ""), (33, 0, "u", "gone"), (20, 0, "u", "a b c")] + [(c, 0, "u", "q") for c in [*range(40, 60), *range(101, 109)]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TABLE + ", depth int, conv string")
    found = got(prefix_trie(df))
    assert found == brute(rows) and any(r[1] == 0 and r[7] != pt.EMPTY_SHA256 for r in found)


def test_long_conversation_over_tasks(spark):
    rows = [(c, t, "u", f"{t % 7} w") for c in (0, 20, 5, 27) for t in range(300)] + [(60, t, "u", f"{t % 7} w") for t in range(150)]
    assert got(prefix_trie(spark.createDataFrame(rows, TABLE).repartition(6), segment=64, task_bytes=1500)) == brute(rows)


def test_empty(spark):
    assert prefix_trie(spark.createDataFrame([], TABLE)).count() == 0


def test_salted_parents(spark, monkeypatch):
    monkeypatch.setattr(pt, "SMALL_ROWS", 0)
    rows = made(8)
    assert got(prefix_trie(spark.createDataFrame(rows, TABLE), task_bytes=100)) == brute(rows)


@pytest.mark.parametrize("width", [3, 60, 256])
def test_layouts_grow(width):
    r = random.Random(width)
    keys = list({bytes([r.randrange(width) for _ in range(r.choice([2, 4, 4, 6]))]) for _ in range(900)})
    root = Node(b"")
    for i, k in enumerate(keys):
        insert(root, k, i)
    found, seen = {}, set()

    def walk(node, prefix):
        seen.add(node.layout)
        assert sum(1 for _ in node.items()) <= node.layout
        prefix += node.path
        if node.value >= 0:
            found[prefix] = node.value
        before = -1
        for b, kid in node.items():
            assert before < b and node.get(b) is kid
            before = b
            walk(kid, prefix + bytes([b]))

    walk(root, b"")
    assert found == {k: i for i, k in enumerate(keys)}
    assert max(seen) == {3: 4, 60: 256, 256: 256}[width]
