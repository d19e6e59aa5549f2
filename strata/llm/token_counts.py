"""Counts of greedy word pieces by a linear longest-match automaton.

The vocabulary's trie has failure links: where a word cannot go on from a node,
the longest matches that the node's text already settles are popped, and reading
goes on at the node of what is left.  How many pieces a link pops is computed
with the link, so a word is counted in one pass over its characters, without
building pieces or trying a position twice.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import column, kept

START = "▁"         # mark that pieces at the start of a word begin with
CACHE = 300_000          # words that a worker remembers
_ROOT, _INNER, _NONE = 0, 1, -1
_UNKNOWN = 1 << 40       # added to a word's count of one if it has no pieces


class Automaton:
    """``count(word)``: pieces of START + word by greedy longest match, pieces
    after the first being those without START; 0 if some position matches none."""

    def __init__(self, vocabulary: Iterable[str]):
        self.go: dict[tuple[int, str], int] = {}
        self.link, self.pops, final = [_NONE, _NONE], [0, 0], [False, False]
        for piece in sorted(set(vocabulary)):
            if not piece:
                continue
            node = _ROOT if piece[0] == START else _INNER
            for c in piece:
                after = self.go.get((node, c))
                if after is None:
                    after = self.go[node, c] = len(final)
                    final.append(False)
                    self.link.append(_NONE)
                    self.pops.append(0)
                node = after
            final[node] = True
        children: list[list] = [[] for _ in final]
        for (node, c), after in self.go.items():
            children[node].append((c, after))
        queue = deque([_ROOT, _INNER])
        while queue:
            node = queue.popleft()
            for c, after in children[node]:
                if final[after]:
                    self.link[after], self.pops[after] = _INNER, 1
                else:
                    at, popped = self.link[node], self.pops[node]
                    while at != _NONE and (at, c) not in self.go:
                        popped, at = popped + self.pops[at], self.link[at]
                    if at != _NONE:
                        self.link[after], self.pops[after] = self.go[at, c], popped
                queue.append(after)

    def count(self, word: str) -> int:
        go, link, pops, node, n = self.go, self.link, self.pops, _ROOT, 0
        for c in START + word:
            after = go.get((node, c))
            while after is None:
                n, node = n + pops[node], link[node]
                if node == _NONE:
                    return 0
                after = go.get((node, c))
            node = after
        while node != _INNER:
            n, node = n + pops[node], link[node]
            if node == _NONE:
                return 0
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        found = self.automaton.count(word) or _UNKNOWN + 1
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = found
        return found


def sentencepiece_vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a model file: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


def count_tokens(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_tokens, n_unknown.

    Words are runs between white space; a word that the pieces do not cover
    counts as one unknown token.  Null and empty texts have none of either;
    repeated rows and null ids are ordinary; other columns are ignored.  The
    vocabulary is broadcast: its size does not depend on the data."""
    held, key = docs.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex
    kind = dict(docs.dtypes)[id_col]

    def rows(batches):
        get = kept(key, lambda: _Counts(Automaton(held.value))).__getitem__
        for b in batches:
            words, tokens, unknown = [], [], []
            for text in column(b, text_col):
                parts = (text.as_py() or "").split()
                n = sum(map(get, parts))
                words.append(len(parts))
                tokens.append(n % _UNKNOWN)
                unknown.append(n // _UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [column(b, id_col), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                [id_col, "n_words", "n_tokens", "n_unknown"])

    return docs.select(id_col, text_col).mapInArrow(
        rows, f"{id_col} {kind}, n_words long, n_tokens long, n_unknown long")
