"""Personal data: fixed patterns, and a skip-chain conditional random field that
makes the labels of repeated or similar tokens agree across a document.

Nodes are the tokens with a digit or an at sign; all others are observed as
plain text.  Chain potentials join neighbours, skip potentials join consecutive
occurrences of a key (same letters and digits, same last seven digits, same name
before the at sign), so a key that occurs n times costs n - 1 links.  Tokens that
a pattern matches are observed with its label; loopy sum-product message
passing gives the others theirs.  Weights are fitted here by pseudo-likelihood
on a bounded sample of nodes, with the pattern labels as targets.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import column, first_by_hash, null_as_empty, saved

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)          # 0: none
SAMPLE = 20_000                  # nodes that the model is fitted on, at most
FEATURES = 1 << 12               # hashed unary features
WIDTH = 12                       # features of a node
NEAR = 3                         # tokens between chain neighbours, at most
ROUNDS, DAMPING = 10, 0.5
SURE = 0.9                       # marginal that adds a span
AGREE = 3.0                      # prior log-odds that similar tokens share a label
BLOCK = 20_000                   # nodes whose messages are passed together

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried at its first digit only: later starts end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_OTHER = re.compile(r"[^\W_]+")
_SHAPE = (re.compile(r"[0-9]"), re.compile(r"[^\W\d_]+"))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each at sign: what stands before it is the
    whole run of allowed characters after the previous match or at sign."""
    free, at = 0, text.find("@")
    while at >= 0:
        run = text[free:at]
        start = free + len(run.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    out = [(0, a, z) for a, z in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _hash(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}={value}".encode("utf-8", "replace")) % FEATURES


class Graph:
    """Nodes and links of several documents."""

    def __init__(self):
        self.doc: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.features: list[list[int]] = []
        self.label: list[int] = []           # label of an overlapping pattern, else 0
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        by_start = sorted((a, z, k) for k, a, z in base)
        seen: dict = {}
        at, before = 0, None
        for m in _TOKEN.finditer(text):
            core = m.group().strip(".,;:!?\"'()[]{}<>|#$%&*=")
            if not core:
                continue
            a = m.start() + m.group().index(core)
            z = a + len(core)
            while at < len(by_start) and by_start[at][1] <= a:
                at += 1
            # several patterns may cover a token: the first in their order
            label = min((by_start[i][2] + 1 for i in range(at, min(at + 8, len(by_start)))
                         if by_start[i][0] < z and by_start[i][1] > a), default=0)
            node = len(self.doc)
            left = _OTHER.findall(text[max(0, m.start() - 40):m.start()])
            right = _OTHER.findall(text[m.end():m.end() + 40])
            self.features.append(_features(core, left[-1] if left else "", right[0] if right else ""))
            self.doc.append(doc)
            self.span.append((a, z))
            self.label.append(label)
            if before is not None and text.count(" ", before[1], m.start()) <= NEAR and m.start() - before[1] < 64:
                self.chain.append((before[0], node))
            before = (node, m.end())
            for key in _keys(core):
                if key in seen:
                    self.skip.append((seen[key], node))
                seen[key] = node


def _features(core: str, left: str, right: str) -> list[int]:
    shape = _SHAPE[1].sub("a", _SHAPE[0].sub("9", core[:48]))
    digits = sum(c.isdigit() for c in core)
    return [_hash("shape", shape), _hash("runs", re.sub(r"9+", "9", shape)), _hash("digits", str(min(digits, 24))),
            _hash("left", left.lower()[:16]), _hash("right", right.lower()[:16]),
            _hash("at", str("@" in core)), _hash("plus", str(core.startswith("+"))),
            _hash("dots", str(min(core.count("."), 5))), _hash("dashes", str(min(core.count("-"), 5))),
            _hash("letters", str(min(sum(c.isalpha() for c in core), 12))),
            _hash("length", str(min(len(core) // 4, 12))), _hash("bias", "")]


def _keys(core: str) -> list[str]:
    plain = "".join(_OTHER.findall(core.lower()))
    digits = _NOT_DIGIT.sub("", core)
    keys = ["=" + plain] if len(plain) >= 4 else []
    if len(digits) >= 7:
        keys.append("9" + digits[-7:])
    if "@" in core and core.index("@") >= 2:
        keys.append("@" + core[:core.index("@")].lower())
    return keys


class Model:
    """Unary weights (FEATURES, LABELS) and two label-by-label potentials."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, g: Graph) -> np.ndarray:
        """(nodes, LABELS) by damped loopy message passing."""
        n = len(g.doc)
        score = self.unary[np.array(g.features, np.int64).reshape(n, WIDTH)].sum(axis=1)
        observed = np.array(g.label)
        fixed = np.flatnonzero(observed > 0)
        score[fixed] = -60.0
        score[fixed, observed[fixed]] = 0.0
        score -= score.max(axis=1, keepdims=True)
        links = [(*e, self.chain) for e in g.chain] + [(*e, self.skip) for e in g.skip]
        if not links:
            return _softmax(score)
        a = np.array([x[0] for x in links])
        b = np.array([x[1] for x in links])
        power = np.exp(np.stack([x[2] for x in links]))                  # (links, label of a, label of b)
        source, target = np.concatenate((a, b)), np.concatenate((b, a))
        power = np.concatenate((power, power.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
        message = np.full((len(source), LABELS), -np.log(LABELS))
        for _ in range(ROUNDS):
            belief = score.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ei,eij->ej", out, power) + 1e-30)
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        belief = score.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple], rounds: int = 200, seed: int = 3) -> Model:
    """Pseudo-likelihood: each node's label given its features and the labels of
    its links.  rows: (features, label, labels before, labels after, labels of
    similar tokens); lists of links may be empty.  Unary features are dropped at
    random, so agreement carries weight of its own.  A node without a pattern
    that is similar to one with a pattern has an unknown label, not none, and
    teaches nothing."""
    rows = [r for r in rows if r[1] or not any(r[4])]
    n, rng = len(rows), np.random.default_rng(seed)
    unary, before, after, skip = (np.zeros(s) for s in ((FEATURES, LABELS), *[(LABELS, LABELS)] * 3))
    prior = AGREE * np.eye(LABELS)
    skip += prior
    if not n:
        unary[:, 0] = 1.0
        return Model(unary, before, skip)
    x = np.array([r[0] for r in rows], np.int64).reshape(n, WIDTH)
    y = np.eye(LABELS)[[r[1] for r in rows]]
    near = [np.array([np.bincount(r[i], minlength=LABELS)[:LABELS] for r in rows], float) for i in (2, 3, 4)]
    weights = [unary, before, after, skip]
    memory = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, rounds + 1):
        kept = rng.random(x.shape) < 0.6
        score = (unary[x] * kept[:, :, None]).sum(axis=1)
        for w, c in zip(weights[1:], near):
            score += c @ w
        error = (_softmax(score) - y) / n
        grads = [np.zeros_like(unary)] + [c.T @ error for c in near]
        for k in range(WIDTH):
            np.add.at(grads[0], x[:, k], error * kept[:, k, None])
        for w, g, (m, v) in zip(weights, grads, memory):
            g = g + 1e-4 * (w - prior if w is skip else w) / max(1, n) ** 0.5
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(unary * 0.6, (before + after.T) / 2, (skip + skip.T) / 2)


def added_spans(g: Graph, marginal: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(doc, kind, start, end) of nodes that no pattern matches, whose label is
    sure, and that skip links join to a token which a pattern gives that label."""
    found, sure = marginal.argmax(axis=1).tolist(), (marginal.max(axis=1) >= SURE).tolist()
    near = defaultdict(list)
    for a, b in g.skip:
        near[a].append(b)
        near[b].append(a)
    reached = {i for i, label in enumerate(g.label) if label}
    todo = list(reached)
    while todo:
        i = todo.pop()
        for j in near[i]:
            if j not in reached and found[j] == found[i]:
                reached.add(j)
                todo.append(j)
    for i in sorted(reached):
        if found[i] and not g.label[i] and sure[i]:
            yield g.doc[i], found[i] - 1, *g.span[i]


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def _candidates(text: Column) -> Column:
    """The text where it has a digit or an at sign; the others need no Python."""
    return F.when(text.rlike("[0-9@]"), text)


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Model:
    """The model from at most ``sample`` nodes, those that come first by a hash of
    text and place.  Graphs are built for the first texts by hash only: ``sample`` of
    them, twice as many until there are enough nodes or no more texts; equal texts
    count once."""
    names = ["rank", "place", "features", "label", "before", "after", "similar"]

    def rows(batches):
        for b in batches:
            for text, rank in zip(column(b, "t"), column(b, "rank").to_pylist()):
                g = Graph()
                text = text.as_py()
                g.add(0, text, base_spans(text))
                if not g.doc:
                    continue
                near: list[list[list[int]]] = [[[] for _ in g.doc] for _ in range(3)]
                for a, z in g.chain:
                    near[0][z].append(g.label[a])
                    near[1][a].append(g.label[z])
                for a, z in g.skip:
                    near[2][z].append(g.label[a])
                    near[2][a].append(g.label[z])
                yield pa.RecordBatch.from_pydict({
                    "rank": pa.array([rank] * len(g.doc), pa.int64()), "place": pa.array(range(len(g.doc)), pa.int64()),
                    "features": pa.array(g.features, pa.list_(pa.int64())), "label": pa.array(g.label, pa.int64()),
                    **{k: pa.array(v, pa.list_(pa.int64())) for k, v in zip(names[4:], near)}})

    texts = (docs.select(_candidates(F.col(text_col)).alias("t"), F.xxhash64(text_col).alias("rank"))
             .where("t is not null"))
    hashes = saved(texts.select("rank").distinct())
    n, wanted = hashes.count(), sample
    while True:
        bound = first_by_hash(hashes, ["rank"], wanted).agg(F.max("rank")).first()[0]
        picked = texts.where(F.col("rank") <= bound).groupBy("rank").agg(F.min("t").alias("t"))
        nodes = saved(picked.mapInArrow(
            rows, "rank long, place long, features array<long>, label long, before array<long>, "
                  "after array<long>, similar array<long>"))
        if wanted >= n or nodes.count() >= sample:
            break
        wanted *= 2
    # the sample is spread over the texts: one long text does not fill it
    found = saved(first_by_hash(nodes.withColumn("hash", F.xxhash64("rank", "place")), ["hash", "rank", "place"], sample)).collect()
    return train([(r.features, r.label, r.before, r.after, r.similar) for r in found])


def find(docs: DataFrame, model: Model | None = None, text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """docs (or the columns ``keep`` of it) plus ``spans``: kind, start, end (code points, end exclusive) and
    whether a fixed pattern gives it; by kind, then start.

    Null and empty texts have no spans; repeated rows are ordinary; a column
    named spans is replaced.  Added spans never overlap a pattern's."""
    held = docs.sparkSession.sparkContext.broadcast(model or fit(docs, text_col))
    keep = [c for c in keep or docs.columns if c != "spans"]
    wide = docs.select(F.struct(*keep).alias("row"), _candidates(F.col(text_col)).alias("t"))
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans: list[list] = [[] for _ in range(b.num_rows)]
            g, base = Graph(), {}

            def flush():
                if g.doc:
                    for doc, kind, a, z in added_spans(g, held.value.marginals(g)):
                        if all(z <= s or a >= e for _, s, e in base[doc]):
                            spans[doc].append((kind, a, z, False))

            for i, text in enumerate(column(b, "t")):
                text = text.as_py()
                if not text:
                    continue
                base[i] = base_spans(text)
                spans[i] = [(*s, True) for s in base[i]]
                g.add(i, text, base[i])
                if len(g.doc) >= BLOCK:
                    flush()
                    g = Graph()
            flush()
            out = [[{"kind": KINDS[k], "start": a, "end": z, "base": own} for k, a, z, own in sorted(s)] for s in spans]
            yield pa.RecordBatch.from_arrays([column(b, "row"), pa.array(out, struct)], ["row", "spans"])

    kinds = wide.schema["row"].dataType.simpleString()
    return wide.mapInArrow(rows, f"row {kinds}, spans {SPANS}").select("row.*", "spans")


def digest_columns(spans: str = "spans") -> dict[str, Column]:
    """n_<kind> of the fixed patterns, base_sha256 and the text of all spans."""
    base = F.filter(spans, lambda s: s["base"])
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = {f"n_{k}": F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long") for k in KINDS}
    return counts | {"base_sha256": F.sha2(text(base).cast("binary"), 256), "spans": text(F.col(spans))}


def masked(spans: str = "spans", text_col: str = "text") -> Column:
    """The text with every span replaced by its kind in angle brackets.  Of spans
    that overlap the first (then the longest) names the kind of them all."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc, s):
        cut = F.substring(F.col(text_col), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(cut, F.concat(F.lit("<"), s["kind"], F.lit(">")))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.otherwise(acc["parts"]).alias("parts"))

    done = F.aggregate(ordered, start, step)
    return F.when(F.size(spans) == 0, F.col(text_col)).otherwise(
        F.concat(F.array_join(done["parts"], ""), F.substring(F.col(text_col), done["at"] + 1, 2147483647)))
