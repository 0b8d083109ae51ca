"""Token counts: count-only Viterbi over a unigram vocabulary.

Text is marked at its start and at spaces and cut before each mark.  In each word an Aho-Corasick
automaton enumerates vocabulary matches; the best path to each position carries its score and
its piece count.  Tie rules of the library's unigram model: starts are visited left to right, a
later path replaces an earlier one only if its score is greater, and a position without a
one-character match gets an unknown of the least score less 10, counted as its bytes.  Control, unknown,
unused and byte pieces are no part of a text: they are not matched, and their scores are not used.
Null and empty texts have no tokens; every input row gives one row; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

MARK, UNKNOWN, CACHE = "▁", 10.0, 400_000
_LOADED: dict = {}


class UnigramCounter:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        other = (sp.is_control, sp.is_unknown, sp.is_unused, sp.is_byte)
        vocab = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not any(is_(i) for is_ in other)]
        self.unknown = min(s for _, s in vocab) - UNKNOWN
        self.trie = ahocorasick.Automaton()
        for p, s in vocab:
            self.trie.add_word(p, (len(p), s))
        self.trie.make_automaton()
        self.words = re.compile(f"{MARK}[^{MARK}]*")
        self.cache: dict = {}

    def word(self, w: str) -> int:
        n = len(w)
        at: list[list] = [[] for _ in range(n)]
        for end, (size, s) in self.trie.iter(w):
            at[end - size + 1].append((size, s))
        best: list = [None] * (n + 1)
        best[0] = (0.0, 0)
        for i in range(n):
            score, count = best[i]
            single = False
            for size, s in at[i]:
                single |= size == 1
                if best[i + size] is None or score + s > best[i + size][0]:
                    best[i + size] = (score + s, count + 1)
            if not single and (best[i + 1] is None or score + self.unknown > best[i + 1][0]):
                best[i + 1] = (score + self.unknown, count + len(w[i].encode("utf-8")))
        return best[n][1]

    def document(self, text: str | None) -> int:
        if not text:
            return 0
        total, marked = 0, text.replace(" ", MARK)
        for w in self.words.findall(marked if marked[0] == MARK else MARK + marked):
            n = self.cache.get(w)
            if n is None:
                n = self.word(w)
                if len(w) <= 64:
                    if len(self.cache) >= CACHE:
                        self.cache.clear()
                    self.cache[w] = n
            total += n
        return total


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _LOADED:
            _LOADED[path] = UnigramCounter(path)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "n_tokens": [_LOADED[path].document(t) for t in f["text"]]})

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long")
