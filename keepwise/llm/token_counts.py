"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens go into a trie of characters; the forward step (best score
of any segmentation of the prefix, and its number of pieces) is computed once
per trie node, so pre-tokens share it along common prefixes, and a terminal
node's count is the pre-token's token count. A worker's trie lives across its
batches and starts anew beyond ``_MAX_NODES``; counts do not depend on that.
"""
from __future__ import annotations

from math import log

import pyarrow as pa
from pyspark.sql import DataFrame

from keepwise.session import ship_package

_MAX_NODES = 1_000_000
# pre-tokens longer than this are computed on their own instead of filling the trie
_MAX_WORD = 200
_MARK = "▁"


class UnigramModel:
    """Pieces of a sentencepiece file, scored by Zipf's law on their rank; bytes stand in for unknown characters."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.scores = {sp.id_to_piece(i): -log(rank + 1) - 1 for rank, i in enumerate(plain, 1)}
        self.longest = max(map(len, self.scores), default=1)
        self.byte_score = -log(len(plain) + 2) - 2

    def step(self, word: str, end: int, best: list[float], count: list[int]) -> tuple[float, int]:
        """Best (score, pieces) of word[:end], given those of all shorter prefixes; ties take fewer pieces."""
        char_bytes = len(word[end - 1].encode("utf-8", "surrogatepass"))
        top, pieces = best[end - 1] + char_bytes * self.byte_score, count[end - 1] + char_bytes
        scores = self.scores
        for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
            s = scores.get(word[start:end])
            if s is not None:
                s += best[start]
                if s > top or s == top and count[start] + 1 < pieces:
                    top, pieces = s, count[start] + 1
        return top, pieces

    def pieces(self, word: str) -> int:
        best, count = [0.0], [0]
        for end in range(1, len(word) + 1):
            s, n = self.step(word, end, best, count)
            best.append(s)
            count.append(n)
        return count[-1]


class PrefixTrie:
    def __init__(self, model: UnigramModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]

    def pieces(self, word: str) -> int:
        if len(word) > _MAX_WORD:
            return self.model.pieces(word)
        node, best, count = 0, [0.0], [0]
        for end, char in enumerate(word, 1):
            at = self.child.get((node, char))
            if at is None:
                s, n = self.model.step(word, end, best, count)
                at = self.child[node, char] = len(self.best)
                self.best.append(s)
                self.count.append(n)
            node = at
            best.append(self.best[at])
            count.append(self.count[at])
        return count[-1]


_TRIES: dict[str, PrefixTrie] = {}


def _trie(path: str) -> PrefixTrie:
    if path not in _TRIES:
        _TRIES[path] = PrefixTrie(UnigramModel(path))
    return _TRIES[path]


def pre_tokens(text: str | None) -> list[str]:
    return [_MARK + w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]


def _counts(path: str):
    def run(batches):
        trie = _trie(path)
        for batch in batches:
            words = [pre_tokens(t.as_py()) for t in batch.column(1)]
            if len(trie.child) > _MAX_NODES:
                trie.clear()
            pieces = {w: trie.pieces(w) for w in set().union(*words)}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, words), pa.int64()),
                 pa.array((sum(map(pieces.__getitem__, ws)) for ws in words), pa.int64())],
                names=["doc_id", "n_pre_tokens", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pre_tokens, n_tokens.

    Pre-tokens are runs of non-blank characters, each with a leading word mark.
    Null and empty texts count 0; a null doc_id stays null; repeated rows repeat;
    other columns are ignored; an empty table gives an empty table. ``model_path``
    must exist on every worker.
    """
    ship_package(docs.sparkSession)
    return (docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
            .mapInArrow(_counts(model_path), "doc_id long, n_pre_tokens long, n_tokens long"))
