"""License scan: word windows against licence notices and whole licence texts by Dice over word bigrams.

A text is lower-cased to words ``[a-z0-9.]+`` over line ends, version numbers kept.  Dice >= t needs
t / (2 - t) of the template's bigrams, so a text with fewer of them is pruned at once, and a window
holds at most (2 - t) / t times as many distinct bigrams as the template.  Within that bound every
window that starts and ends with a bigram of the template is compared (others are no better).  Units
are the windows with Dice >= t that share no word, those of whole texts before those of notices (a notice
may be part of several texts), then best first (ties by name, then place); equal ones count once.  The first
unit names the licence.  A notice without its text is named as the template says, even if other licences share it.  Null and empty texts match nothing; each input row gives one row; extra columns
are ignored.
"""

from __future__ import annotations

import re
from itertools import repeat
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Short public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Whole public licence texts, one file each.
TEXTS = {p.stem: p.read_text(encoding="utf-8") for p in sorted(Path(__file__).with_name("licenses").glob("*.txt"))}
DICE = 0.8
WORD = re.compile("[a-z0-9.]+")


def words(text: str) -> list[str]:
    return [x for x in (w.strip(".") for w in WORD.findall(text.lower())) if x]


def bigrams(text: str) -> list[str]:
    w = words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


class Scanner:
    """Windows of a text that match a template."""

    def __init__(self, templates: list[tuple[str, str]], least: float, notices: int = 0):
        """The first ``notices`` templates are notices, the others whole texts."""
        self.least, self.names, self.notices = least, [k for k, _ in templates], notices
        sized = [bigrams(v) for _, v in templates]
        self.n = [len(v) for v in sized]
        self.of: dict[str, int] = {}
        for v in sized:
            for g in v:
                for w in g.split(" "):
                    self.of.setdefault(w, len(self.of))
        self.v = len(self.of) + 1
        code = lambda g: [self.of[w] for w in g.split(" ")]
        pairs = sorted({(a * self.v + b, t) for t, v in enumerate(sized) for a, b in map(code, v)})
        self.key = np.array(sorted({k for k, _ in pairs}), np.int64)
        self.has = np.zeros((len(self.key), len(templates)), bool)  # which template holds which bigram
        for k, t in pairs:
            self.has[np.searchsorted(self.key, k), t] = True

    def windows(self, hit: np.ndarray, before: np.ndarray, n: int) -> list[tuple[float, int, int]]:
        """(dice, first, last bigram) of the best window from each start; ``before``: where the same bigram was last."""
        out, most = [], (2 - self.least) / self.least * n
        for i in np.flatnonzero(hit).tolist():
            size = int(most) + 64
            while True:
                new = before[i:i + size] < i
                d = np.cumsum(new)
                if d[-1] > most or i + size >= len(hit):
                    break
                size *= 2
            m = np.cumsum(new & hit[i:i + size])
            dice = 2.0 * m / (d + n)
            j = int(dice.argmax())
            if dice[j] >= self.least:
                out.append((float(dice[j]), i, i + j))
        return out

    def __call__(self, text: str | None) -> tuple[int, str | None, float | None]:
        w = words(text or "")
        if len(w) < 2 or not len(self.key):
            return 0, None, None
        c = np.fromiter(map(self.of.get, w, repeat(self.v - 1)), np.int64, len(w))
        g = c[:-1] * self.v + c[1:]
        at = np.minimum(np.searchsorted(self.key, g), len(self.key) - 1)
        known = (c[:-1] < self.v - 1) & (c[1:] < self.v - 1) & (self.key[at] == g)
        if not known.any():
            return 0, None, None
        enough = self.has[np.unique(at[known])].sum(0) >= np.array(self.n) * (self.least / (2 - self.least)) - 1e-9
        if not enough.any():
            return 0, None, None
        last: dict[tuple[str, str], int] = {}
        before = np.empty(len(g), np.int64)
        for i, x in enumerate(zip(w, w[1:], strict=False)):
            before[i] = last.get(x, -1)
            last[x] = i
        found = sorted((t < self.notices, -d, self.names[t], i, j) for t in np.flatnonzero(enough).tolist()
                       for d, i, j in self.windows(known & self.has[at, t], before, self.n[t]))
        taken, units = np.zeros(len(w), bool), set()
        for _, _, _, i, j in found:
            if not taken[i:j + 2].any():
                taken[i:j + 2] = True
                units.add(" ".join(w[i:j + 2]))
        return (len(units), found[0][2], -found[0][1]) if found else (0, None, None)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = DICE, texts: dict[str, str] = TEXTS) -> DataFrame:
    """doc_id, n_license_units, license (of the first unit; null: none), dice."""
    both = [(k, v) for d in (templates, texts) for k, v in sorted(d.items())]
    held: list[Scanner] = []

    @F.pandas_udf("n long, license string, dice double")
    def best(text: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(Scanner(both, least, len(templates)))
        return pd.DataFrame([held[0](t) for t in text], columns=["n", "license", "dice"])

    return (docs.select("doc_id", best("text").alias("m"))
            .select("doc_id", F.col("m.n").alias("n_license_units"), F.col("m.license").alias("license"), F.col("m.dice").alias("dice")))
