"""Near-duplicate components against a comparison of all pairs."""
import random
import re

import numpy as np
import pytest

from strata.llm import ngram_join as J
from strata.llm.shingles import mix64, set_hash, shingle_set, shingle_sets
from tests.conftest import SF_SMALL


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """{id: component} over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def check(df, rows):
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in J.near_duplicates(df).collect()}
    component, size = brute(rows)
    assert got == {i: (component[i], size[i]) for i in component}


def edited(words, n, r):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"x{r.randrange(10 ** 6)}"
    return words


def test_shingles_match_the_definition():
    texts = [None, "", " \t ", "A", "a B\x0bc", "one two three four five", "One two three four five six six",
             "é É " * 9, "x" * 5000 + " y", "a b c d e f g"]
    import pyarrow as pa
    for t, s in zip(texts, shingle_sets(pa.array(texts))):
        assert len(s) == len(shingles(t)) and np.array_equal(s, shingle_set(t))
    assert set_hash(shingle_set("A b c d e f")) == set_hash(shingle_set("a  b\nc D e f"))


def test_texts_over_a_block_are_whole(monkeypatch):
    import strata.llm.shingles as S
    text = " ".join(f"word{i % 977}" for i in range(5000))
    whole = shingle_set(text)
    monkeypatch.setattr(S, "BLOCK", 1000)
    assert np.array_equal(S.shingle_set(text), whole)


@pytest.mark.parametrize("threshold", [75, 60, 90])
def test_bands_keep_partners_in_neighbouring_bands(threshold):
    b = J.Bands(threshold)
    for n in range(1, 400):
        for m in range(n, n * 100 // threshold + 1):
            assert b.of(m) - b.of(n) in (0, 1)
            assert b.difference(n, m) <= min(b.worst(n, b.of(n)), b.worst(m, b.of(n)))
            assert b.segments(b.of(n)) > b.difference(n, m)
            assert 2 * b.wide_segments(b.of(n)) > b.difference(n, m)


def test_pigeonhole_holds_for_pairs_at_the_threshold():
    r, bands = random.Random(1), J.Bands(75)
    for n in (3, 4, 8, 20, 100, 333):
        for _ in range(30):
            a = np.unique(mix64(np.array([r.randrange(2 ** 60) for _ in range(n)], np.uint64)))
            drop = r.randrange(0, n // 7 + 1)
            b = np.unique(np.concatenate((a[drop:], mix64(np.array(
                [r.randrange(2 ** 60) for _ in range(drop)], np.uint64)))))
            common = len(np.intersect1d(a, b))
            if 100 * common < 75 * (len(a) + len(b) - common):
                continue
            k = min(bands.of(len(a)), bands.of(len(b)))
            x, y = (np.frombuffer(J.parities(s, k, bands), np.uint8) for s in (a, b))
            assert len(x) == len(y) and np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * common
            (wa, da), (wb, db) = (J.neighbourhood_signatures(s, k, bands) for s in (a, b))
            assert set(wa.tolist()) & set(wb.tolist()) or set(wa.tolist()) & set(db.tolist()) \
                or set(da.tolist()) & set(wb.tolist())


def test_small_documents_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_short_texts_ties_nulls_and_copies(docs):
    texts = [None, "", "  ", "a", "A", "a b", "a b c d e", "a b c d e f", "a b c d e f", "b a",
             "a b c d e f g h", "a b c d e f g i", "a b c d e f g", "é", "É", "x " * 50, "x " * 9]
    check(docs(texts), list(enumerate(texts)))


def test_common_passages_and_hot_groups(docs):
    """A passage in most texts, a large group of near copies, chains of edits."""
    r = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for k in range(60):
        own = [f"u{r.randrange(10 ** 6)}" for _ in range(r.choice([5, 20, 60, 150]))]
        texts.append(" ".join(own + passage if k % 2 else passage + own))
    base = [f"b{i}" for i in range(120)]
    texts += [" ".join(edited(base, r.randrange(1, 4), r)) for _ in range(60)]
    chain = [f"c{i}" for i in range(200)]
    for _ in range(12):
        chain = edited(chain, 4, r)
        texts.append(" ".join(chain))
    check(docs(texts), list(enumerate(texts)))


def test_hot_signatures_are_found_with_little_room(docs, monkeypatch):
    """Nearly everything hot: the neighbourhoods of short sets find the links."""
    monkeypatch.setattr(J, "HOT", 2)
    monkeypatch.setattr(J, "SPREAD", 0.4)
    r = random.Random(9)
    shared = [f"s{i}" for i in range(40)]
    texts = [" ".join(shared + [f"t{k // 2}_{i}" for i in range(8)] + [f"v{k}"]) for k in range(40)]
    texts += [" ".join(edited(shared * 2, 2, r)) for _ in range(20)]
    check(docs(texts), list(enumerate(texts)))


def test_empty_table_extra_columns_and_null_ids(spark, docs):
    assert J.near_duplicates(docs([])).collect() == []
    df = spark.createDataFrame([(3, "a b c d e f", 1, 1, "z"), (None, "a b c d e f", 2, 2, "z"), (None, None, 3, 3, None),
                                (2, "a b c d e f", 4, 4, "z"), (2, "a b c d e f", 4, 4, "z")],
                               "doc_id long, text string, n long, node long, id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 2, 2), (None, 2, 2), (None, 0, None), (2, 2, 2), (2, 2, 2)], key=str)


def test_null_ids_link_and_bridge(docs):
    """Null ids with sets of their own: near copies of one document, and the only
    link between two; long texts, and short ones that probe single shingles."""
    rows = []
    for k, n in enumerate((200, 60, 12, 9)):
        base = [f"g{k}w{i}" for i in range(n)]
        # a chain: neighbours link, its ends do not
        step = max(1, n // 12)
        chain = [base[step * j:] + [f"g{k}x{i}" for i in range(step * j)] for j in range(3)]
        near, alone = [f"g{k}n{i}" for i in range(n)], [f"g{k}a{i}" for i in range(n)]
        rows += [(10 * k + 2, chain[0]), (None, chain[1]), (10 * k + 1, chain[2]),
                 (10 * k + 5, near), (None, near[1:]), (None, alone), (None, alone[1:])]
    texts = [" ".join(t) for _, t in rows]
    numbered, _ = brute(list(enumerate(texts)))
    least = {}
    for j, (i, _) in enumerate(rows):
        if i is not None:
            least[numbered[j]] = min(i, least.get(numbered[j], i))
    want = sorted(((i, len(shingles(t)), least.get(numbered[j])) for j, ((i, _), t) in enumerate(zip(rows, texts))), key=str)
    assert sum(c is not None and i is None for i, _, c in want) >= 6 and any(i == 2 and c == 1 for i, _, c in want)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(docs(texts, [i for i, _ in rows])).collect()]
    assert sorted(got, key=str) == want


def test_hubs_and_members_that_cannot_link_are_not_verified(spark, monkeypatch):
    """Texts share a passage: its segments are hot, and no two texts are alike."""
    rng = random.Random(11)
    words = lambda n: " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))
    passage = words(60)
    rows = [(i, f"{words(70)} {passage} {words(70)}") for i in range(30)]
    listed, links = [], J._links

    def counted(pairs, *rest):
        listed.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(J, "_links", counted)
    out = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(i, i) for i, _ in rows]
    assert listed[0] == 0
