"""Token counts (operator 5): unigram segmentation of distinct pre-tokens, shared along a trie.

A pre-token is a run of non-space with the piece mark (U+2581) before it. Its segmentation is the one with the largest sum of
piece scores; a character that no piece begins or ends at costs as many byte pieces as its UTF-8 has bytes, each at
`byte_score`. Ties go to fewer tokens. Scores along a pre-token depend on its prefix only, so they are kept in the nodes of a
trie: each node has the best score and the token count of the prefix it stands for, computed once from its ancestors, and a
pre-token's count is that of its last node. A pre-token has nodes for its first `depth` characters at most; beyond, only the
scores that the longest piece can reach back to are kept, as long runs share no more. A task keeps its trie until it has
`max_nodes` nodes and then starts anew. So memory is bounded by `max_nodes` + `depth` nodes and one text, and no count changes.

Null and empty texts have no tokens; rows with null or repeated ids are rows of their own; an empty table gives no rows.
Other columns are ignored, whatever their names. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
DEFAULT_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def read_vocabulary(path: str = DEFAULT_VOCABULARY) -> dict[str, float]:
    """Pieces and log scores. The public file orders pieces by merge rank and has no probabilities, so a piece of rank r
    scores as in Zipf's law, -log((r + 1) H). Control, unknown and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    harmonic = sum(1 / (r + 1) for r in range(n))
    skip = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    pieces = [model.id_to_piece(i) for i in range(n) if not skip(i)]
    return {p: -math.log((r + 1) * harmonic) for r, p in enumerate(pieces)}


class Trie:
    """Best score and token count for each prefix of the pre-tokens seen."""

    def __init__(self, scores: dict[str, float], byte_score: float, max_nodes: int, depth: int = 64):
        self.scores, self.byte_score, self.max_nodes = scores, byte_score, max_nodes
        # every suffix of a piece, so that a search backwards ends where no piece can reach; None: no piece itself
        self.tails: dict[str, float | None] = dict.fromkeys((p[i:] for p in scores for i in range(len(p))), None)
        self.tails.update(scores)
        self.longest = max(map(len, scores), default=1)
        self.depth = max(depth, self.longest)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]
        self.counts: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of a pre-token; stored where its path in the trie ends."""
        found = self.counts.get(word)
        if found is None:
            if len(self.best) > self.max_nodes:
                self.clear()
            if len(word) < self.depth:
                found = self.counts[word] = self.tokens[self._insert(MARK + word)[-1]]
            else:
                found = self._beyond(MARK + word)
        return found

    def _step(self, word: str, end: int, before: tuple[float, int], at: Callable[[int], tuple[float, int]]) -> tuple[float, int]:
        """Best score and tokens of word[:end], from those of shorter prefixes."""
        tails = self.tails
        size = len(word[end - 1].encode("utf-8", "surrogatepass"))
        top, n = before[0] + size * self.byte_score, before[1] + size
        for start in range(end - 1, -1, -1):
            piece = word[start:end]
            if piece not in tails:
                break
            score = tails[piece]
            if score is not None:
                total, m = at(start)
                total, m = total + score, m + 1
                if total > top or total == top and m < n:
                    top, n = total, m
        return top, n

    def _insert(self, word: str) -> list[int]:
        """The nodes along a word."""
        child, best, tokens = self.child, self.best, self.tokens
        path = [0]
        for end, c in enumerate(word, 1):
            parent = path[-1]
            node = child.get((parent, c))
            if node is None:
                top, n = self._step(word, end, (best[parent], tokens[parent]), lambda k: (best[path[k]], tokens[path[k]]))
                node = child[parent, c] = len(best)
                best.append(top)
                tokens.append(n)
            path.append(node)
        return path

    def _beyond(self, word: str) -> int:
        """Tokens of a word that is longer than paths are."""
        path = self._insert(word[: self.depth])
        size = self.longest + 1
        ring = [(0.0, 0)] * size
        for k in range(max(0, len(path) - size), len(path)):
            ring[k % size] = self.best[path[k]], self.tokens[path[k]]
        for end in range(len(path), len(word) + 1):
            ring[end % size] = self._step(word, end, ring[(end - 1) % size], lambda k: ring[k % size])
        return ring[len(word) % size][1]


def _counted(batches: Iterator[pa.RecordBatch], shared, byte_score: float, max_nodes: int) -> Iterator[pa.RecordBatch]:
    trie = Trie(shared.value, byte_score, max_nodes)
    for batch in batches:
        chars, words, distinct, tokens = [], [], [], []
        for x in batch.column("text"):
            text = x.as_py() or ""
            found = Counter(text.split())
            chars.append(len(text))
            words.append(found.total())
            distinct.append(len(found))
            tokens.append(sum(n * trie.count(w) for w, n in found.items()))
        out = {"id": batch.column("id")} | {k: pa.array(v, pa.int64()) for k, v in (("n_chars", chars), ("n_pretokens", words), ("n_distinct", distinct), ("n_tokens", tokens))}
        yield pa.RecordBatch.from_pydict(out)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str | dict[str, float] = DEFAULT_VOCABULARY,
                 byte_score: float = -20.0, max_nodes: int = 400_000) -> DataFrame:
    """One row per document: id, n_chars, n_pretokens, n_distinct (pre-tokens) and n_tokens. The vocabulary, a file's or
    given, goes to every executor: its size is that of a tokenizer's and doesn't grow with the documents."""
    scores = read_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    zero = F.lit(0).cast("long")
    schema = texts.select("id", zero.alias("n_chars"), zero.alias("n_pretokens"), zero.alias("n_distinct"), zero.alias("n_tokens")).schema
    return texts.mapInArrow(lambda b: _counted(b, shared, byte_score, max_nodes), schema).withColumnRenamed("id", id_col)
