import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm.suffix_tree import WEIGHTS, suffix_tree_scores

END = "\x00end"


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows, min_count):
    """(scores, P): the tree from plain counts, the definition word for word."""
    train = [tokens(t) for i, t in rows if not held(i)]
    c = Counter()
    follow = defaultdict(Counter)
    for ws in train:
        for i, x in enumerate(ws):
            c[x] += 1
            for k in (1, 2):
                if i >= k:
                    follow[tuple(ws[i - k:i])][x] += 1
    n, v = sum(c.values()), len(c)
    states = {}

    def p(context, x):
        context = tuple(context[-2:])
        while context and context not in states:
            context = context[1:]
        if not context:
            return (c[x] + 1) / (n + v + 1)
        w, size = states[context], sum(follow[context].values())
        return (follow[context][x] + w * size * p(context[1:], x)) / (size + w * size)

    for k in (1, 2):
        grown = {}
        for s, nexts in follow.items():
            size = sum(nexts.values())
            if len(s) != k or size < min_count or (k == 2 and s[1:] not in states):
                continue
            gains = [sum(m * math.log((m - 1 + w * size * (q := p(s[1:], x))) / ((size - 1 + w * size) * q))
                         for x, m in nexts.items()) for w in WEIGHTS]
            if max(gains) > 0:
                grown[s] = WEIGHTS[gains.index(max(gains))]
        states.update(grown)
    out = []
    for i, t in rows:
        ws = tokens(t)
        out.append((i, held(i), len(ws), sum(c[x] > 0 for x in ws), n,
                    sum(math.log10((c[x] + 1) / (n + v + 1)) for x in ws),
                    sum(math.log10(p(ws[max(0, j - 2):j], x)) for j, x in enumerate(ws))))
    return out, p, c, states


def corpus(n=120, seed=3):
    r = random.Random(seed)
    phrase = "the Quick brown fox jumps over a lazy dog by the river".split()
    rows = [(None, "a b c"), (5, None), (6, ""), (6, " \n\t"), (7, "The the THE")]
    for i in range(n):
        ws = []
        while len(ws) < r.randrange(1, 120):
            ws += phrase[(a := r.randrange(len(phrase))):a + 6] if r.random() < 0.5 else [f"w{int(r.paretovariate(0.7))}"]
        rows.append((i + 10, r.choice([" ", "\n", "\t "]).join(ws)))
    return rows + rows[20:30]


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (str(r[0]), r[2], r[6]))


@pytest.mark.parametrize("block_tokens, bucket_keys", [(1_000_000, 1_000_000), (37, 300)])
def test_equals_plain_counts(spark, docs, block_tokens, bucket_keys):
    rows = corpus()
    want, _, _, states = brute(rows, 4)
    assert {len(s) for s in states} == {1, 2}
    df = docs([t for _, t in rows], [i for i, _ in rows]).repartition(3)
    found = got(suffix_tree_scores(df, min_count=4, block_tokens=block_tokens, bucket_keys=bucket_keys))
    want.sort(key=lambda r: (str(r[0]), r[2], r[6]))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for a, b in zip(found, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-6)


def test_states_are_distributions():
    rows = corpus(60)
    _, p, c, states = brute(rows, 4)
    unknown = "never seen"
    for s in [(), *list(states)[:20]]:
        assert sum(p(s, x) for x in c) + p(s, unknown) == pytest.approx(1)


def test_held_out_texts_gain(spark, docs):
    rows = corpus(400, 9)
    found = got(suffix_tree_scores(docs([t for _, t in rows], [i for i, _ in rows])))
    out = [r for r in found if r[1]]
    assert len(out) > 20 and sum(r[6] for r in out) > sum(r[5] for r in out)


def test_empty_and_other_columns(spark, docs):
    assert suffix_tree_scores(docs([])).count() == 0
    df = spark.createDataFrame([("a", "x y", 1, True), (None, None, 2, None)], "doc_id string, text string, row int, held boolean")
    assert suffix_tree_scores(df.withColumnRenamed("doc_id", "score"), "score").columns[0] == "document_id"
    assert [(r[0], r[2]) for r in got(suffix_tree_scores(df))] == [(None, 1), ("a", 3)]
