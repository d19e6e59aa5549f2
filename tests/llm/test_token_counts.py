import random

from strata.llm.queries import PIECES
from strata.llm.token_counts import START, Automaton, count_tokens, sentencepiece_vocabulary


def greedy(vocabulary, word):
    """Pieces by trying every length, longest first; 0 if none fits somewhere."""
    s, at, n = START + word, 0, 0
    while at < len(s):
        for z in range(len(s), at, -1):
            if s[at:z] in vocabulary and (s[at] == START) == (at == 0):
                break
        else:
            return 0
        at, n = z, n + 1
    return n


def test_random_vocabularies():
    r = random.Random(1)
    for _ in range(150):
        vocabulary = {("" if r.random() < 0.6 else START) + "".join(r.choice("abc") for _ in range(r.randrange(1, 6)))
                      for _ in range(r.randrange(1, 25))} | ({START} if r.random() < 0.5 else set())
        a = Automaton(vocabulary)
        for _ in range(60):
            w = "".join(r.choice("abcd" if r.random() < 0.1 else "abc") for _ in range(r.randrange(1, 14)))
            assert a.count(w) == greedy(vocabulary, w), (vocabulary, w)


def test_one_pass_over_long_words():
    a = Automaton({START + "a", "a", "a" * 50})
    assert a.count("a" * 100_001) == 1 + 2000


def test_table(spark, docs):
    vocabulary = [START + "the", "r", "e", START, "x", START + "x", "yz"]
    texts = [None, "", " \n ", "the there", "the the", "thex xyz x", "q the", "x" * 1000, "the the"]
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in count_tokens(docs(texts), vocabulary).collect()}
    v = set(vocabulary)
    for i, t in enumerate(texts):
        words = (t or "").split()
        assert got[i] == (len(words), sum(greedy(v, w) or 1 for w in words), sum(not greedy(v, w) for w in words))
    assert count_tokens(docs([]), vocabulary).count() == 0


def test_null_ids_and_other_columns(spark):
    df = spark.createDataFrame([(None, "x", 1), ("a", "x x", 2)], "doc_id string, text string, n_tokens long")
    assert sorted(map(str, count_tokens(df, [START + "x"]).collect())) == [
        "Row(doc_id='a', n_words=2, n_tokens=2, n_unknown=0)", "Row(doc_id=None, n_words=1, n_tokens=1, n_unknown=0)"]


def test_public_vocabulary_on_the_small_table(spark):
    from tests.conftest import SF_SMALL
    vocabulary = sentencepiece_vocabulary(PIECES)
    v, a = set(vocabulary), Automaton(vocabulary)
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect()]
    for w in {w for t in texts for w in t.split()[:200]}:
        assert a.count(w) == greedy(v, w)
