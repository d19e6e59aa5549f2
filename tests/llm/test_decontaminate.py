import random

import numpy as np
import pytest

from strata.llm import decontaminate as D
from strata.llm.decontaminate import contaminated


def text_of(n, seed):
    r = random.Random(seed)
    parts = "the ing tion er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de".split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randrange(1, 4))) for _ in range(n))


def distance(item, text):
    """Fewest edits between the item and any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def norm(t):
    return "".join(map(chr, D.normalise(D.codes_of(t or ""))[0].tolist())).strip()


def test_matches_are_those_within_the_budget(spark, docs):
    r = random.Random(4)
    items = [text_of(r.randrange(14, 40), 100 + k) for k in range(6)]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string")
    texts = []
    for k in range(60):
        passage = list(items[k % 6])
        budget = D.edit_budget(len(norm(items[k % 6])))
        for _ in range(r.choice([0, 1, 2, budget, budget + 1, 2 * budget + 3])):
            at = r.randrange(len(passage))
            passage[at:at + 1] = r.choice([[], ["q"], [passage[at], "z"]])
        texts.append(text_of(40, 900 + k) + " " + "".join(passage) + " " + text_of(30, 500 + k))
    texts += [text_of(300, 2000 + k) for k in range(10)] + [None, "", "short"]
    got = {(x.doc_id, x.item_id): x for x in contaminated(docs(texts), bench).collect()}
    want = set()
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            k = D.edit_budget(len(norm(item)))
            if t and distance(norm(item), norm(t)) <= k:
                want.add((d, i))
    assert set(got) == want
    for (d, i), x in got.items():
        assert distance(norm(items[i]), norm(texts[d][x.start:x.end])) <= D.edit_budget(len(norm(items[i])))
        assert x.edits == distance(norm(items[i]), norm(texts[d]))


def test_case_punctuation_and_positions(spark, docs):
    item = text_of(20, 1)
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "tiny"), (11, item)], "item_id long, text string")
    shout = "é\U0001F600 " + "### ".join(item.upper().split()) + "!! tail"
    got = contaminated(docs([shout, item + " " + item]), bench).collect()
    assert sorted((x.doc_id, x.item_id, x.edits) for x in got) == [
        (0, 7, 0), (0, 11, 0), (1, 7, 0), (1, 7, 0), (1, 11, 0), (1, 11, 0)]
    one = next(x for x in got if x.doc_id == 0)
    assert norm(shout[one.start:one.end]) == norm(item) and one.start == 3


def test_windows_are_never_lost_between_strides_and_groups(monkeypatch, spark, docs):
    monkeypatch.setattr(D, "TEXT_BLOCK", 500)
    monkeypatch.setattr(D, "ITEM_BLOCK", 100)
    items = [text_of(16, k) for k in range(5)]
    texts = [text_of(k, 50 + k) + " " + items[k % 5] + " " + text_of(17 - k % 17, 70) for k in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in contaminated(docs(texts), bench).collect()} == {(k, k % 5) for k in range(40)}


def test_passages_cut_at_the_bounds_of_documents(spark, docs):
    """Documents of one scan group that begin or end with an item without its
    first or last 1..k characters, and an item dealt over two documents."""
    item = text_of(40, 3)
    k = D.edit_budget(len(norm(item)))
    codes = D.normalise(D.codes_of(item))[0].tolist()
    least = lambda t: distance(codes, D.normalise(D.codes_of(t))[0].tolist())
    assert k > 3
    texts, want = [text_of(30, 1)], {}
    for cut in range(1, k + 1):
        for t in (item[cut:] + " " + text_of(25, cut), text_of(25, 99 + cut) + " " + item[:-cut], item[cut:], item[:-cut]):
            if least(t) <= k:
                want[len(texts)] = least(t)
            texts.append(t)
    assert len(want) > 3 * k
    texts += [text_of(20, 5) + " " + item[:len(item) // 2], item[len(item) // 2:] + " " + text_of(20, 6)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    together = contaminated(docs(texts).coalesce(1), bench).collect()
    assert {x.doc_id: x.edits for x in together} == want
    for x in together:
        assert 0 <= x.start < x.end <= len(texts[x.doc_id])
        assert least(texts[x.doc_id][x.start:x.end]) == x.edits


@pytest.mark.parametrize("kind", ["int", "double", "decimal(10,2)", "date", "timestamp", "string", "boolean", "binary"])
def test_ids_of_any_type(spark, docs, kind):
    item = text_of(30, 1)
    value = {"date": "2024-01-02", "timestamp": "2024-01-02 03:04:05", "boolean": "true"}.get(kind, "7")
    bench = spark.createDataFrame([(value, item), (None, text_of(30, 2))], "k string, text string").selectExpr(f"CAST(k AS {kind}) AS item_id", "text")
    got = contaminated(docs([item + " more", text_of(30, 2), "none"]), bench)
    assert dict(got.dtypes)["item_id"] == kind
    want = {r.item_id if kind != "binary" else bytes(r.item_id) for r in bench.where("item_id IS NOT NULL").collect()}
    rows = {x.doc_id: x.item_id for x in got.collect()}
    assert {bytes(rows[0]) if kind == "binary" else rows[0]} == want and rows[1] is None and len(rows) == 2


def test_clashing_names(spark):
    item = text_of(30, 1)
    bench = spark.createDataFrame([(7, item, "x")], "item_id long, text string, start string")
    df = spark.createDataFrame([("a", item, 1, 2)], "item_id string, text string, `end` int, edits int")
    got = contaminated(df, bench, "item_id").collect()
    assert [(r.document_id, r.item_id, r.edits) for r in got] == [("a", 7, 0)]
    assert contaminated(df, bench, "end").columns == ["document_id", "item_id", "start", "end", "edits"]


def test_align_against_full_table():
    r = random.Random(8)
    for _ in range(200):
        item = np.array([r.randrange(4) for _ in range(r.randrange(8, 30))], np.uint32)
        text = item.tolist()
        for _ in range(r.randrange(0, 4)):
            at = r.randrange(len(text))
            text[at:at + 1] = r.choice([[], [9], [text[at], 9]])
        lead = r.randrange(0, 4)
        text = np.array([8] * lead + text + [8] * 3, np.uint32)
        want = distance(item.tolist(), text.tolist())
        got = D.align(item, text, lead - 3, lead + 3, 4)
        assert got is not None and got[0] == want
        assert distance(item.tolist(), text[got[1]:got[2]].tolist()) == want


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, text_of(20, 1))], "item_id long, text string")
    assert contaminated(docs(["some text"]), none).collect() == []
    assert contaminated(docs([]), some).collect() == []
