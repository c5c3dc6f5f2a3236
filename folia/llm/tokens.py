"""Token counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry at every place. The
automaton is a trie of the vocabulary in which every node also knows where the
search goes on when no child fits: to the node reached by the rest of its
string after the greedy pieces at its front are taken off (failure link), and
how many pieces that takes off (popped count). A word's length in pieces is
then read off in one pass over its bytes, without making a piece. Links and
counts are filled breadth first: a node that ends an entry pops that entry and
goes to the root; another tries its byte from its parent's link on.

Words repeat, so each task remembers the counts of words it has met lately.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents

#: Vocabulary file of the registered query, as described in the tokenizers' README.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
REMEMBER = 1 << 17
by_value(__name__)


def entries(path: str = VOCABULARY) -> list[bytes]:
    """The pieces of a SentencePiece model as bytes, control and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return [model.id_to_piece(i).encode() for i in range(model.get_piece_size()) if not skip(i)]


class Automaton:
    """Counts greedy pieces. A byte that begins no entry is a piece of its own."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.child: list[dict[int, int]] = [{}]
        ends = [False]
        for entry in {*vocabulary, *(bytes([b]) for b in range(256))} - {b""}:
            node = 0
            for b in entry:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    ends.append(False)
                node = nxt
            ends[node] = True
        self.link, self.popped = [0] * len(ends), [0] * len(ends)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for b, node in self.child[parent].items():
                if ends[node]:
                    self.popped[node] = 1  # the whole string is one piece; its rest is empty
                else:
                    at, n = self.link[parent], self.popped[parent]
                    while b not in self.child[at]:
                        n += self.popped[at]
                        at = self.link[at]
                    self.link[node], self.popped[node] = self.child[at][b], n
                todo.append(node)

    def count(self, word: bytes) -> int:
        child, link, popped = self.child, self.link, self.popped
        node = n = 0
        for b in word:
            while (nxt := child[node].get(b)) is None:
                n += popped[node]
                node = link[node]
            node = nxt
        while node:
            n += popped[node]
            node = link[node]
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton, mark: bytes):
        super().__init__()
        self.automaton, self.mark = automaton, mark

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        n = self[word] = self.automaton.count(self.mark + word)
        return n


def token_counts(docs: DataFrame, vocabulary: list[bytes], *, id_col: str = "doc_id", text_col: str = "text", mark: bytes = MARK) -> DataFrame:
    """(doc_id, n_words, n_tokens, longest_word_tokens) for every row.

    Words stand between ASCII white space; each is cut greedily with ``mark``
    before it. Null and empty texts have zero of all. Repeated rows and null
    ids give a row each; an empty table gives none; other columns are not
    read. The vocabulary is a file of fixed size, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t"))

    def run(batches):
        counts = _Counts(Automaton(shared.value), mark)
        for b in batches:
            per = [[counts[w] for w in (t.as_py() or b"").split()] for t in b.column(1)]
            n = lambda f: pa.array([f(p) for p in per], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n(len), n(sum), n(lambda p: max(p, default=0))], names=["doc_id", "n_words", "n_tokens", "longest_word_tokens"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_tokens long, longest_word_tokens long")


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and token counts of every document."""
    return token_counts(documents(spark, sf_dir), entries())
