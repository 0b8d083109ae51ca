"""Exact merge-type (BPE) encoding by backtracking, and decoding, for a sentencepiece model.

A unit is a maximal run of word-start marks with the characters up to the next one; no piece
holds a mark after another character (checked at load), so units encode independently and their
ids are memoised in a bounded cache.  Units also end before punctuation that no piece holds after a
letter, and a long unit (scripts without spaces) is cut wherever no piece holds the two neighbouring
characters, as no merge can cross there.  Inside a unit, an Aho-Corasick automaton gives the pieces
starting at each position, the longest is tried first, a piece is kept if re-merging it with its
left neighbour gives back the two, and a bitfield marks positions from which encoding failed.
Characters outside the vocabulary become byte ids and separate what stands around them.

Null text is empty text (no ids); rows keep their order and count; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

MARK = "▁"
CACHE = 600_000  # units kept per worker; the cache is emptied when full
LONG = 64  # longer units are cut into parts; longer parts are not kept
_LOADED: dict = {}


class PieceCodec:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.byte = {int(self.pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece holds a word-start mark after another character")
        self.known = {p for p in self.ids if len(p) == 1}
        self.joins = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.trie = ahocorasick.Automaton()
        for p in self.ids:
            self.trie.add_word(p, (p, len(p)))
        self.trie.make_automaton()
        ends, before = set(string.punctuation + "\n"), 0
        while before != len(ends):  # marks that no piece holds after another kind of character
            before = len(ends)
            ends -= {j[1] for j in self.joins if j[0] != MARK and j[0] not in ends}
        e = re.escape("".join(sorted(ends)))
        self.units = (re.compile(f"{MARK}*[^{MARK}{e}]+|{MARK}*[{e}]+[^{MARK}{e}]*|{MARK}+") if e
                      else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+"))
        self.whole = {p for p in self.ids if self.merge(p) == [p]}
        self.pairs: dict = {}
        self.cache: dict = {}

    def merge(self, s: str) -> list[str]:
        """The merge rule itself, on a short string: best score first, leftmost on ties."""
        parts = list(s)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                v = self.score.get(parts[k] + parts[k + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, a: str, b: str) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def span(self, s: str) -> list[str]:
        """Backtracking over a span of known characters."""
        n = len(s)
        if n == 1:
            return [s]
        at: list[list[str]] = [[] for _ in range(n)]
        for end, (p, size) in self.trie.iter(s):
            at[end - size + 1].append(p)  # shorter pieces come first
        failed = bytearray(n + 1)
        out: list[str] = []
        untried, pos, pairs = [at[0]], 0, self.pairs
        while pos < n:
            options, left, got = untried[-1], out[-1] if out else None, None
            while options:
                p = options.pop()
                if failed[pos + len(p)]:
                    continue
                if left is None:
                    ok = p in self.whole
                else:
                    ok = pairs.get((left, p))
                    if ok is None:
                        ok = self.fits(left, p)
                if ok:
                    got = p
                    break
            if got is not None:
                out.append(got)
                pos += len(got)
                if pos < n:
                    untried.append(at[pos].copy())
            elif out:
                failed[pos] = 1
                untried.pop()
                pos -= len(out.pop())
            else:
                return self.merge(s)
        return out

    def unit(self, u: str) -> tuple[str, str | None, int]:
        """Ids joined by commas, decoded text (None: the unit itself), number of ids."""
        ids: list[int] = []
        run: list[str] = []

        def flush():
            if run:
                s = "".join(run)
                same = len(s) > 2 and s == s[0] * len(s)
                ids.extend(self.ids[p] for p in (self.merge(s) if same and len(s) <= 64 else self.span(s)))
                run.clear()

        for c in u:
            if c in self.known:
                run.append(c)
            else:
                flush()
                ids.extend(self.byte[b] for b in c.encode("utf-8"))
        flush()
        back = self.text(ids)
        return ",".join(map(str, ids)), None if back == u.replace(MARK, " ") else back, len(ids)

    def parts(self, u: str) -> list[str]:
        """Cuts where no piece holds both neighbours; byte pieces on both sides of one decode alone."""
        joins = self.joins
        at = [0, *(i for i in range(1, len(u)) if u[i - 1:i + 1] not in joins), len(u)]
        return [u[a:b] for a, b in zip(at, at[1:], strict=False)]

    def text(self, ids) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.pieces[i].replace(MARK, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def document(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, decoded text."""
        if not text:
            return 0, "", ""
        cache, ids, out, n = self.cache, [], [], 0
        for u in self.units.findall(MARK + text.replace(" ", MARK)):
            for part in (u,) if len(u) <= LONG else self.parts(u):
                got = cache.get(part)
                if got is None:
                    got = self.unit(part)
                    if len(part) <= LONG:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[part] = got
                ids.append(got[0])
                out.append(part if got[1] is None else got[1])
                n += got[2]
        return n, ",".join(ids), "".join(out).replace(MARK, " ")[1:]


def codec(path: str) -> PieceCodec:
    if path not in _LOADED:
        _LOADED[path] = PieceCodec(path)
    return _LOADED[path]


def encode_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path)
        for f in frames:
            rows = []
            for t in f["text"]:
                n, ids, back = c.document(t)
                rows.append((n, sha(ids), sha(back)))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", f["doc_id"].astype("Int64"))
            yield out

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
