"""The registered queries on the small tables: against their SQL, or against
what their contract lets one recompute in plain Python."""

import hashlib

import duckdb
import pytest

from scripts.oracle_check import TABLES, digest
from strata.llm.queries import ORACLE, PIECES, QUERIES
from strata.llm.token_counts import sentencepiece_vocabulary
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import D, distance, norm
from tests.llm.test_suffix_tree import brute
from tests.llm.test_token_counts import greedy


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF_SMALL), con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    rows, expected = [tuple(r) for r in got.collect()], want.fetchall()
    assert len(rows) == len(expected) > 0
    assert digest(got.columns, rows)[0] == digest(names, expected)[0]


def test_passages_are_within_the_edit_budget(spark, con, texts):
    items = dict(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    codes = lambda t: [ord(c) for c in norm(t)]
    rows = QUERIES["op2_decontamination"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        item, passage = codes(items[r.item_id]), codes(texts[r.doc_id][r.start:r.end])
        assert distance(item, passage) == r.edits <= D.edit_budget(len(item))
    # an item that stands in a text as it is, is found there
    whole = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert whole <= {(r.doc_id, r.item_id) for r in rows}


def test_token_counts(spark, texts):
    vocabulary = set(sentencepiece_vocabulary(PIECES))
    seen = {}
    for r in QUERIES["op5_token_counts"](spark, SF_SMALL).collect():
        words = texts[r.doc_id].split()
        pieces = [seen.setdefault(w, greedy(vocabulary, w)) if w not in seen else seen[w] for w in words]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(p or 1 for p in pieces), sum(not p for p in pieces))


def test_fingerprints_and_edited_texts(spark, texts):
    rows = {r.doc_id: r for r in QUERIES["op6_spotsigs"](spark, SF_SMALL).collect()}
    order = sorted(texts, reverse=True)
    by_text = {}
    for here, after in zip(order, order[1:] + order[:1]):
        t, r = texts[here], rows[here]
        half = len(t) // 2
        edited = t[:len(t) - half] + texts[after][:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(rows) == len(texts)


def test_scores_equal_the_tree_from_plain_counts(spark, texts):
    want = {r[0]: r for r in brute(list(texts.items()), 8)[0]}
    rows = QUERIES["op11_suffix_tree"](spark, SF_SMALL).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][1:5]
        assert r.base_score == pytest.approx(want[r.doc_id][5], rel=1e-9)
        assert r.score == pytest.approx(want[r.doc_id][6], rel=1e-5)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
