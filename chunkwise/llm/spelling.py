"""Spelling variants: near words found by search schemes over bidirectional FM-indexes.

Words are counted over all texts.  A near word keeps either the left or the right half of a word
unchanged, so each word is looked up twice: one half is matched exactly, and the search goes on
across the other half allowing one error.  The vocabulary is dealt to shards by that exact half and
the length it belongs to, so a lookup visits one shard a half and its shards hold what it can find.
A shard's words, delimited, are indexed in blocks of about ``BLOCK`` characters: suffix ranks by prefix
doubling, and for the text and its reverse the counts of each character before each rank, so that an
interval of suffix ranks grows by a character on either side.

Both halves being kept (a doubled letter in the middle) counts for the left half alone, and an
inserted or deleted letter within a run of equal letters is placed at the run's end, so each near
word is found once.  A task gives one row a looked-up word (how many, and the best), not its
pairs.  Shards of over ``SIDE`` words are cut into squares; as such shards are told to all tasks,
only those of more than the ``HEAVY``-th part of all are (at most ``HEAVY`` of them), while the
blocks bound the memory of the others.

A null text has no words; a null doc_id is hashed as an empty one.  Equal rows count each.  Ties of
the form go to the least word in code-point order.  An empty table, and one without a word of
enough occurrences, gives no rows.  Extra columns are ignored.  Runs and texts of any length are
taken whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwise.llm.store import stored

LEAST_CHARS, LEAST_COUNT, RATIO, DROP = 5, 3, 2, 97
RUN = re.compile("[a-zÀ-ÿ]+")
HELD = 1 << 19  # words counted in a task before they are passed on
SHARD, SIDE, BLOCK, HEAVY = 1 << 14, 1 << 17, 1 << 17, 10_000
LOT = 1 << 13  # words looked up in a block together
LAST, END = 0, 1  # codes of the text's end and of the delimiter


def variant(run: str, doc: bytes) -> str:
    """A run as it counts: one code point less where DROP divides the crc32 of ``<doc>:<run>``."""
    h = crc32(run.encode(), crc32(doc))
    if h % DROP:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of every word with at least LEAST_CHARS code points and LEAST_COUNT occurrences."""

    def rows(seen: dict) -> pd.DataFrame:
        return pd.DataFrame({"word": list(seen), "n": list(seen.values())}, dtype=object)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for f in frames:
            for d, t in zip(f["doc_id"], f["text"], strict=True):
                doc = f"{d or ''}:".encode()
                for x, n in Counter(RUN.findall((t or "").encode("utf-8", "replace").lower().decode())).items():
                    w = variant(x, doc)
                    if len(w) >= LEAST_CHARS:
                        seen[w] = seen.get(w, 0) + n
                if len(seen) > HELD:
                    yield rows(seen)
                    seen = {}
        yield rows(seen)

    part = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text of codes, by prefix doubling."""
    n, width = len(text), 1
    rank = text.astype(np.int64)
    while True:
        after = np.full(n, -1, np.int64)
        after[:n - width] = rank[width:]
        key = rank * (int(rank.max()) + 2) + after + 1
        order = np.argsort(key, kind="stable")
        step = np.r_[False, key[order][1:] != key[order][:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1 or width >= n:
            return order
        width *= 2


class Index:
    """Bidirectional FM-index of delimited words, for many intervals at a time.

    An interval is (lo, back, size): its first rank among the suffixes of the text, that of the
    reversed string among the suffixes of the reversed text, and its width.
    """

    def __init__(self, block: list[str]):
        flat = "".join(block)
        points = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        self.letters, codes = np.unique(points, return_inverse=True)
        length = np.fromiter(map(len, block), np.int64, len(block))
        text = np.full(len(flat) + len(block) + 2, END, np.int64)
        text[-1] = LAST
        self.start = np.r_[0, np.cumsum(length + 1)]  # of the delimiter before each word
        text[np.delete(np.arange(len(text) - 1), self.start)] = codes + 2
        self.sigma = len(self.letters) + 2
        self.suffix = suffix_ranks(text)
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=self.sigma))]
        self.left = self.counts(text, self.suffix)
        back = np.r_[text[-2::-1], LAST]
        self.right = self.counts(back, suffix_ranks(back))

    def counts(self, text: np.ndarray, order: np.ndarray) -> np.ndarray:
        """For each rank and code, how many of the characters before the suffixes of lower rank are that code."""
        before = text[order - 1]
        out = np.zeros((len(text) + 1, self.sigma), np.int32)
        out[np.arange(1, len(text) + 1), before] = 1
        return np.cumsum(out, axis=0, out=out)

    def codes(self, words: list[str], reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """(words as rows of codes, filled with -1; lengths); a letter the index lacks is -2."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.letters, points)
        code = np.where(self.letters[np.minimum(at, len(self.letters) - 1)] == points, at + 2, -2)
        out = np.full((len(words), int(length.max())), -1, np.int64)
        row = np.repeat(np.arange(len(words)), length)
        col = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
        out[row, length[row] - 1 - col if reverse else col] = code
        return out, length

    def grown(self, lo: np.ndarray, back: np.ndarray, size: np.ndarray, leftward: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals grown by every code, one column each."""
        table, at, other = (self.left, lo, back) if leftward else (self.right, back, lo)
        low = table[at]
        many = table[at + size] - low
        near = self.first[:-1] + low
        far = other[:, None] + np.cumsum(many, axis=1) - many
        return (near, far, many) if leftward else (far, near, many)

    def extend(self, s: np.ndarray, code: np.ndarray, leftward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Intervals (columns lo, back, size) grown by one code each, and which of them hold anything."""
        ok = np.flatnonzero(code >= 0)
        lo, back, many = self.grown(*s[ok].T, leftward)
        k = np.arange(len(ok))
        out = np.stack([a[k, code[ok]] for a in (lo, back, many)], axis=1)
        full = out[:, 2] > 0
        return out[full], ok[full]

    def near(self, words: list[str], reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word, found): places in ``words`` and in the block of the pairs that differ by one code point and
        agree in the left half of the word; with ``reverse`` in the right half, and not in the left one too."""
        p, m = self.codes(words, reverse)
        half = m - m // 2 if reverse else m // 2
        onward = reverse  # the search goes on leftward if the right half was matched
        q = np.arange(len(words))
        s = np.zeros((len(words), 3), np.int64) + [0, 0, len(self.suffix)]
        # the half, read from its inner end to the word's end and then the delimiter there
        for k in range(int(half.max(initial=0)) + 1):
            on = k <= half[q]
            c = np.where(k < half[q], p[q, np.maximum(half[q] - 1 - k, 0)], END)
            new, at = self.extend(s[on], c[on], not onward)
            keep = np.flatnonzero(on)[at]
            s, q = np.concatenate([s[~on], new]), np.concatenate([q[~on], q[keep]])
        i, err = half[q], np.zeros(len(q), bool)
        found = []
        while len(q):
            end = i == m[q]
            code = np.where(end, END, p[q, np.minimum(i, p.shape[1] - 1)])
            fits = ~(end & ~err)  # a word without an error is the word itself
            same, at = self.extend(s[fits], code[fits], onward)
            at = np.flatnonzero(fits)[at]
            done = end[at]
            for (lo, _, size), k in zip(same[done], q[at[done]], strict=True):
                found += [(k, r) for r in range(lo, lo + size)]
            nxt = [(same[~done], q[at[~done]], i[at[~done]] + 1, err[at[~done]])]
            free = np.flatnonzero(~err)
            if len(free):
                j, w, stop = i[free], q[free], end[free]
                # deleted: the last letter of a run alone
                after = p[w, np.minimum(j + 1, p.shape[1] - 1)]
                cut = free[~stop & ((j + 1 == m[w]) | (after != code[free]))]
                nxt.append((s[cut], q[cut], i[cut] + 1, np.ones(len(cut), bool)))
                lo, back, many = self.grown(*s[free].T, onward)
                many[:, :END + 1] = 0
                row, letter = np.nonzero(many)
                other = letter != code[free[row]]  # an inserted letter comes after the run it lengthens
                row, letter = row[other], letter[other]
                grown = np.stack([lo[row, letter], back[row, letter], many[row, letter]], axis=1)
                one, inner = np.ones(len(row), bool), ~stop[row]
                nxt.append((grown, w[row], j[row], one))
                nxt.append((grown[inner], w[row[inner]], j[row[inner]] + 1, one[inner]))
            s, q, i, err = (np.concatenate([x[k] for x in nxt]) for k in range(4))
        pair = np.array(found, np.int64).reshape(-1, 2)
        return pair[:, 0], np.searchsorted(self.start, self.suffix[pair[:, 1]])


def blocks(listed: list[str]) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of words with about BLOCK characters, one word at least."""
    at, used = 0, 0
    for k, w in enumerate(listed):
        if used and used + len(w) + 1 > BLOCK:
            yield at, k
            at, used = k, 0
        used += len(w) + 1
    if listed:
        yield at, len(listed)


def lookup(asked: list[str], held: list[str], n: np.ndarray, reverse: bool) -> pd.DataFrame:
    """word, n_near, best_n, best of the asked words, over the held ones (sorted, with their n)."""
    out: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
    for a, b in blocks(held):
        block = held[a:b]
        size = np.bincount([len(w) for w in block])
        about = lambda m: size[max(m - 1, 0):m + 2].sum()
        here = set(block)
        some = [w for w in asked if about(len(w)) > (w in here)]  # others have no word of their length
        index = Index(block) if some else None
        for k in range(0, len(some), LOT):
            lot = some[k:k + LOT]
            q, w = index.near(lot, reverse)
            if reverse:
                new = [not block[y].startswith(lot[x][:len(lot[x]) // 2]) for x, y in zip(q.tolist(), w.tolist(), strict=True)]
                q, w = q[np.array(new, bool)], w[np.array(new, bool)]
            order = np.lexsort((w, -n[a + w], q))
            q, w = q[order], w[order]
            lead = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
            out["word"] += [lot[x] for x in q[lead].tolist()]
            out["n_near"] += np.diff(np.r_[lead, len(q)]).tolist()
            out["best_n"] += n[a + w[lead]].tolist()
            out["best"] += [block[x] for x in w[lead].tolist()]
    return pd.DataFrame(out, dtype=object)  # empty columns stay text


def near_words(vocabulary: DataFrame, shard: int = SHARD, side: int = SIDE) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near words in the vocabulary (word, n)."""
    total = 6 * vocabulary.count()
    long = F.char_length("word")
    half = lambda m, right: F.expr(f"substr(word, -({m} - {m} div 2))" if right else f"substr(word, 1, {m} div 2)")
    keys = F.array(*[F.struct(F.lit(r).alias("right"), (long + d).alias("m"), F.lit(d == 0).alias("asks"),
                              half(f"(char_length(word) + {d})", r).alias("half")) for r in (False, True) for d in (-1, 0, 1)])
    rows = vocabulary.select("word", "n", F.explode(keys).alias("k"))
    rows = rows.select("word", "n", "k.right", "k.asks", F.pmod(F.xxhash64("k.m", "k.half"), F.lit(total // shard + 1)).alias("shard"))
    big = (rows.groupBy("right", "shard").agg(F.count("*").alias("size")).where((F.col("size") > side) & (F.col("size") * HEAVY > total))
           .select("right", "shard", F.ceil(F.col("size") / side).cast("int").alias("cut")))
    rows = rows.join(F.broadcast(big), ["right", "shard"], "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
    place = F.pmod(F.xxhash64("word"), F.col("cut")).cast("int")
    rows = rows.withColumn("mine", place)
    line = F.sequence(F.lit(0), F.col("cut") - 1)
    column = F.transform(line, lambda m: F.struct(m.alias("m"), F.col("mine").alias("q")))
    row = F.transform(line, lambda q: F.struct(F.col("mine").alias("m"), q.alias("q")))
    rows = rows.select("right", "shard", "word", "n", "asks", "mine", F.explode(F.when(F.col("asks"), F.array_union(row, column)).otherwise(row)).alias("at"))
    rows = rows.select("right", "shard", "at.m", "at.q", "word", "n", (F.col("mine") == F.col("at.m")).alias("held"), (F.col("asks") & (F.col("mine") == F.col("at.q"))).alias("asked"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        held = g[g["held"]].drop_duplicates("word").sort_values("word")
        asked = g.loc[g["asked"], "word"].drop_duplicates().tolist()
        return lookup(asked, held["word"].tolist(), held["n"].to_numpy(), bool(g["right"].iat[0]))

    found = rows.groupBy("right", "shard", "m", "q").applyInPandas(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by doubling the steps taken until none is left."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stored(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary."""
    v = stored(words(docs), "words")
    best = near_words(v)
    takes = F.col("best_n") >= RATIO * F.col("n")
    d = stored(v.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                   F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")), "forms")
    return (d.join(roots(d.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word")))
