import itertools
import random
import zlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.packing import Packer, fill, pack
from strata.llm.queries import TOKENIZER, op10
from tests.conftest import SF_SMALL


def test_fill_reaches_the_best_sum():
    r = random.Random(3)
    for _ in range(200):
        capacity = r.randrange(5, 40)
        counts = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(r.randrange(1, 5))}
        sums = {sum(n * k for n, k in zip(counts, ks))
                for ks in itertools.product(*(range(c + 1) for c in counts.values()))}
        got = fill(counts, capacity)
        assert all(0 < k <= counts[n] for n, k in got.items())
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= capacity)


def test_packer_keeps_every_id_once():
    r = random.Random(4)
    docs = [bytes(r.randrange(256) for _ in range(4 * r.choice([1, 2, 7, 63, 64, 65, 200]))) for _ in range(300)]
    p, pieces = Packer(64, 1000), []
    for i, ids in enumerate(docs):
        pieces += p.add(i, ids)
    pieces += p.close()
    check(pieces, {i: d for i, d in enumerate(docs)}, 64)


def check(pieces, ids_of, capacity):
    back, windows = {}, {}
    for doc, start, length, ids, total, seq, offset in pieces:
        assert length == len(ids) // 4 > 0 and total == len(ids_of[doc]) // 4
        back.setdefault(doc, []).append((start, ids))
        windows.setdefault(seq, []).append((offset, length))
    assert {d: b"".join(x for _, x in sorted(v)) for d, v in back.items()} == ids_of
    short = 0
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= capacity
        short += at < capacity
        assert at == capacity or at & (at - 1) == 0        # nothing is padded
    return short


def test_pieces_of_a_table(spark, docs):
    t = Tokenizer.from_file(TOKENIZER)
    texts = [None, "", "Hello,   world's 42 é x\x1cy", "<|endoftext|> a<|startoftext|>", "it's IT'S don't" * 9,
             "word " * 9000, "İstanbul ΣΣ ﬁ K é", "same", "same"]
    rows = pack(docs(texts), TOKENIZER, 512).collect()
    want = {i: b"".join(x.to_bytes(4, "little") for x in [*t.encode(s or "", add_special_tokens=False).ids, 2])
            for i, s in enumerate(texts)}
    check([(r.doc_id, r.start, r.length, bytes(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in rows], want, 512)
    assert pack(docs([]), TOKENIZER).count() == 0


def test_other_tokenizers_get_whole_texts(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a  b\n\nc", " leading", "é"]
    t = Tokenizer.from_file(path)
    got = {r.doc_id: bytes(r.ids) for r in pack(docs(texts), path).orderBy("doc_id", "start").groupBy("doc_id")
           .agg(F.concat_ws("", F.collect_list(F.hex("ids"))).alias("h")).select("doc_id", F.unhex("h").alias("ids")).collect()}
    assert got == {i: b"".join(x.to_bytes(4, "little") for x in [*t.encode(s, add_special_tokens=False).ids, 2])
                   for i, s in enumerate(texts)}


def test_query_on_the_small_table(spark):
    t = Tokenizer.from_file(TOKENIZER)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op10(spark, SF_SMALL).collect():
        ids = [*t.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        piece = b"".join(x.to_bytes(4, "little") for x in ids[r.start:r.start + r.length])
        assert (len(ids), zlib.crc32(piece)) == (r.doc_tokens, r.ids_crc32)
