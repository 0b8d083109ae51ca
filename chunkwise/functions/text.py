"""Column -> Column text functions: cleaning, section marks, sentence units,
token counts and sentence-aligned chunk packing.

Everything here is a native Catalyst expression (regexp_replace, split,
transform, aggregate, ...), so it runs inside the executor JVM next to the
scan with no Python round trip.  Packing folds keep only integers in their
state (start positions and running token counts); chunk strings are built
once at the end with ``slice`` + ``array_join``.

Token counts add up over a join: a space adds ``space`` tokens and ``", "``
adds ``comma`` (0 and 1 for the default counter), which lets every greedy
packing step work on integers instead of re-counting a growing string.  A
native counter with other costs states them; a Python counter
(``functions.counters.WordCounter``) carries its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Section titles, in the order the reference lists them.  They are applied
# longest first (stable for equal lengths), each as a whole-word,
# case-insensitive match replaced by "\n<Title>\n".
SECTION_TITLES = [
    "Summary",
    "Highlights",
    "Skills",
    "Experience",
    "Education",
    "Education and Training",
    "Accomplishments",
    "Certifications",
    "Work History",
    "Professional Experience",
    "Additional Information",
]
# Two known mojibake sequences and their repairs.
MOJIBAKE_COMMA = "锛?"   # replaced by ","
MOJIBAKE_SPACE = "路"    # replaced by " "
# Default chunking limits: token budget per chunk, chunks kept, pad size.
DEFAULT_MAX_TOKENS = 510
DEFAULT_MAX_CHUNKS = 4
DEFAULT_PAD_SIZE = 512
# ---------------------------------------------------------------------------

# Python's Unicode whitespace (str.isspace / re "\s"), written as a character
# class both Java regex and RE2 understand.  Java's own "\s" is ASCII only.
WS_CHARS = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WS = f"[{WS_CHARS}]"
# Default token rule: a run of ASCII word characters, or any single other
# non-whitespace character.
TOKEN_PATTERN = f"[A-Za-z0-9_]+|[^{WS_CHARS}A-Za-z0-9_]"
# The same for Java's matcher: word characters by its table, the commonest character of the class first.
TOKEN_JAVA = rf"\w+|[^\x20\w{WS_CHARS}]"
PRINTED = "(?![!-~])"  # cheap test that spares most characters the whitespace class
# All but the first character of each token, for Java's matcher: the rest of a word with its space, or whitespace.
TOKEN_REST = rf"(?<=\w)\w++ ?+|{PRINTED}{WS}++"

Counter = Callable[[Column], Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace (Python ``str.strip()``)."""
    return F.regexp_replace(_col(c), f"{PRINTED}(?:^{WS}+|{WS}+\\z)", "")


def collapse_ws(c: Column | str) -> Column:
    """Every run of whitespace as one space; runs that are one space already are not matched."""
    other = WS_CHARS.replace(r"\x1C-\x20", r"\x1C-\x1F")
    return F.regexp_replace(_col(c), f"{PRINTED}(?: {WS}|[{other}]){WS}*", " ")


def clean_text(c: Column | str) -> Column:
    """Normalise a raw document.

    Order: strip whitespace, strip outer runs of double quotes, repair the two
    mojibake sequences, drop whitespace before a comma, exactly one space after
    a comma, collapse all whitespace runs (line breaks included) to one space,
    strip.  The reference's intermediate CR/LF/tab collapsing steps are implied
    by the final collapse and therefore not repeated.
    """
    s = F.trim(collapse_ws(c))  # from here on all whitespace is single spaces
    s = F.btrim(s, F.lit('"'))
    s = F.replace(s, F.lit(MOJIBAKE_COMMA), F.lit(","))
    # only the second repair can make longer runs again
    s = let(s, lambda x: F.when(F.contains(x, F.lit(MOJIBAKE_SPACE)), collapse_ws(F.replace(x, F.lit(MOJIBAKE_SPACE), F.lit(" ")))).otherwise(x))
    # no space before a comma, one after it
    for old, new in ((" ,", ","), (", ", ","), (",", ", ")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return F.trim(s)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it (possibly many times) in ``body``.

    Column expressions are trees: a sub-expression used twice is computed
    twice, and inside a lambda once per element.  Binding it to a lambda
    variable of a one-element ``transform`` evaluates it exactly once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _titles_longest_first(titles: list[str]) -> list[str]:
    return sorted(titles, key=len, reverse=True)


def _java_quote(title: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in title)


def mark_sections(c: Column | str, titles: list[str] | None = None) -> Column:
    """Put each section title on its own line, in canonical spelling.

    Titles are applied longest first; a shorter title later re-splits a longer
    one that contains it (``Education and Training`` -> ``Education`` +
    ``and Training``), as in the reference.  Word boundaries are Unicode
    (``(?U)``), matching Python's ``\\b`` on ``str``.
    """
    ordered = _titles_longest_first(titles or SECTION_TITLES)

    def body(x: Column) -> Column:
        s = x
        for title in ordered:
            s = F.regexp_replace(s, f"(?iU)\\b{_java_quote(title)}\\b", f"\n{title}\n")
        # one case-insensitive scan decides whether any title can match at
        # all; most texts skip the per-title passes
        any_title = "(?i)" + "|".join(_java_quote(t) for t in ordered)
        return F.when(x.rlike(any_title), s).otherwise(x)

    return let(_col(c), body)


def split_units(c: Column | str, titles: list[str] | None = None) -> Column:
    """Semantic units: section marks and line breaks are hard boundaries; a
    sentence ends after ``. ! ? ;`` when whitespace and an ASCII capital or
    digit follow.  Units are stripped; empty ones dropped."""
    s = mark_sections(c, titles)
    s = F.regexp_replace(s, f"([.!?;]){WS}+(?=[A-Z0-9])", "$1\n")
    parts = F.transform(F.split(s, "\n"), lambda p: strip_ws(p))
    return F.filter(parts, lambda p: p != F.lit(""))


def count_tokens(c: Column | str) -> Column:
    """Default token counter: ``[A-Za-z0-9_]+`` runs plus single other
    non-space characters (each non-ASCII letter counts as one token).  What
    is left without the rest of every token is counted, so that no token
    becomes a string of its own (as in ``regexp_count``)."""
    return F.length(F.regexp_replace(_col(c), TOKEN_REST, ""))


def _words(c: Column) -> Column:
    """Python ``str.split()``: whitespace-separated words, no empties."""
    return F.filter(F.split(strip_ws(c), f"{WS}+"), lambda w: w != F.lit(""))


def split_by_words(c: Column | str, max_tokens: int) -> Column:
    """Groups of ``max_tokens`` whitespace-separated words joined by a space.
    Groups are counted in words, not tokens, so a group can exceed the token
    budget.  Empty text gives an empty array."""
    def groups(words: Column) -> Column:
        n = F.size(words)
        idx = F.sequence(F.lit(0), F.floor((n - 1) / max_tokens).cast("int"))
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(
            F.transform(idx, lambda g: F.array_join(F.slice(words, g * max_tokens + 1, F.lit(max_tokens)), " ")))

    return let(_words(_col(c)), groups)


_SEG_TYPE = "array<struct<s:int,e:int,w:boolean>>"


def _comma_segments(parts: Column, counts: Column, max_tokens: int, comma: int) -> Column:
    """Greedy packing of comma parts with ", " (``comma`` tokens per join).

    ``parts``/``counts`` must be cheap references (lambda variables or
    columns).  Returns segments (s, e, w): parts s..e-1 joined, or, when w,
    the single part s that alone exceeds the budget and is split by words.
    """
    empty = F.array().cast(_SEG_TYPE)
    init = F.struct(empty.alias("segs"), F.lit(0).alias("cs"), F.lit(0).alias("ce"), F.lit(0).alias("n"))

    def seg(s, e, w):
        return F.array(F.struct(s.alias("s"), e.alias("e"), F.lit(w).alias("w")))

    def state(segs, cs, ce, n):
        return F.struct(segs.alias("segs"), cs.alias("cs"), ce.alias("ce"), n.alias("n"))

    def step(acc, i):
        pn = F.element_at(counts, i)
        has = acc["cs"] > 0
        flushed = F.when(has, F.concat(acc["segs"], seg(acc["cs"], acc["ce"], False))).otherwise(acc["segs"])
        return (
            F.when(has & (acc["n"] + comma + pn <= max_tokens), state(acc["segs"], acc["cs"], i + 1, acc["n"] + comma + pn))
            .when(~has & (pn <= max_tokens), state(acc["segs"], i, i + 1, pn))
            .when(pn > max_tokens, state(F.concat(flushed, seg(i, i + 1, True)), F.lit(0), F.lit(0), F.lit(0)))
            .otherwise(state(flushed, i, i + 1, pn))
        )

    def finish(acc):
        return F.when(acc["cs"] > 0, F.concat(acc["segs"], seg(acc["cs"], acc["ce"], False))).otherwise(acc["segs"])

    idx = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.size(parts))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(idx, init, step, finish)


def comma_parts(c: Column | str) -> Column:
    """Comma-separated parts, stripped, empty ones dropped."""
    return F.filter(F.transform(F.split(_col(c), ","), lambda p: strip_ws(p)), lambda p: p != F.lit(""))


def _with_counts(arr: Column, counter: Counter) -> Column:
    return F.transform(arr, lambda p: F.struct(p.alias("t"), counter(p).alias("n")))


def _pieces(parts: Column, pc: Column, segs: Column, max_tokens: int, counter: Counter, comma: int) -> Column:
    """Strings of the comma segments, with their token counts."""
    return F.flatten(F.transform(
        segs,
        lambda sg: F.when(sg["w"], _with_counts(split_by_words(F.element_at(parts, sg["s"]), max_tokens), counter))
        .otherwise(F.array(F.struct(
            F.array_join(F.slice(parts, sg["s"], sg["e"] - sg["s"]), ", ").alias("t"),
            (F.aggregate(F.slice(pc, sg["s"], sg["e"] - sg["s"]), F.lit(0), lambda a, x: a + x)
             + (sg["e"] - sg["s"] - 1) * comma).alias("n"))))))


def unit_pieces(u: Column, n: Column, max_tokens: int, counter: Counter, comma: int = 1) -> Column:
    """C6 for one unit with known count ``n`` -> ``array<struct<t,n>>``."""
    def over_budget(parts: Column) -> Column:
        return F.when(F.size(parts) <= 1, _with_counts(split_by_words(u, max_tokens), counter)).otherwise(
            let(F.transform(parts, lambda p: counter(p)),
                lambda pc: let(_comma_segments(parts, pc, max_tokens, comma),
                               lambda segs: _pieces(parts, pc, segs, max_tokens, counter, comma))))

    return F.when(n <= max_tokens, F.array(F.struct(u.alias("t"), n.alias("n")))).otherwise(
        let(comma_parts(u), over_budget))


def split_long_unit(c: Column | str, max_tokens: int = DEFAULT_MAX_TOKENS,
                    counter: Counter = count_tokens, comma: int = 1) -> Column:
    """A unit within budget stays whole; otherwise split at commas and
    greedily re-pack with ", "; a single part (or none) and any part over
    budget fall back to word groups."""
    pieces = let(_col(c), lambda u: let(counter(u), lambda n: unit_pieces(u, n, max_tokens, counter, comma)))
    return F.transform(pieces, lambda x: x["t"])


def expand_units(units: Column | str, max_tokens: int = DEFAULT_MAX_TOKENS,
                 counter: Counter = count_tokens, comma: int = 1) -> Column:
    """C6 on every unit -> ``array<struct<t:string, n:int>>``; units within
    budget are counted once and never split."""
    return F.flatten(F.transform(
        _col(units), lambda u: let(counter(u), lambda n: unit_pieces(u, n, max_tokens, counter, comma))))


def _chunk_starts(counts: Column, max_tokens: int, max_chunks: int | None, space: int = 0) -> Column:
    """Greedy space-join packing over unit token counts (a cheap reference).

    Returns struct(st: 1-based chunk starts, n, k: number of chunks).  A unit
    that does not fit closes the current chunk; a unit over budget becomes
    its own chunk.  Past ``max_chunks`` only the chunk count keeps growing.
    """
    m = F.size(counts)
    idx = F.when(m >= 2, F.sequence(F.lit(2), m)).otherwise(F.array().cast("array<int>"))
    init = F.struct(F.array(F.lit(1)).alias("st"), F.element_at(counts, 1).alias("n"), F.lit(1).alias("k"))
    cap = max_chunks + 1 if max_chunks else None

    def step(acc, i):
        pn = F.element_at(counts, i)
        grow = F.concat(acc["st"], F.array(i))
        if cap is not None:
            grow = F.when(acc["k"] < cap, grow).otherwise(acc["st"])
        return F.when(acc["n"] + space + pn <= max_tokens,
                      F.struct(acc["st"].alias("st"), (acc["n"] + space + pn).alias("n"), acc["k"].alias("k"))) \
            .otherwise(F.struct(grow.alias("st"), pn.alias("n"), (acc["k"] + 1).alias("k")))

    empty = F.struct(F.array().cast("array<int>").alias("st"), F.lit(0).alias("n"), F.lit(0).alias("k"))
    return F.when(m == 0, empty).otherwise(F.aggregate(idx, init, step))


def packed(pieces: Column, n_units: Column, max_tokens: int, max_chunks: int, space: int = 0) -> Column:
    """Chunks of counted pieces (``array<struct<t,n>>``, a column or a let-bound
    value) as the struct that ``chunk_table`` describes."""
    def with_st(st: Column) -> Column:
        def one(start, j):
            end = F.coalesce(F.get(st["st"], j + 1), F.size(pieces) + 1)
            sl = F.slice(pieces, start, end - start)
            return F.struct(
                F.array_join(F.transform(sl, lambda x: x["t"]), " ").alias("chunk"),
                (F.aggregate(sl, F.lit(0), lambda a, x: a + x["n"]) + (F.size(sl) - 1) * space).alias("n_tokens"))

        return F.struct(F.transform(F.slice(st["st"], 1, max_chunks), one).alias("chunks"),
                        st["k"].alias("total_chunks"), F.greatest(st["k"] - max_chunks, F.lit(0)).alias("dropped_chunks"),
                        n_units.alias("units"))

    # the counts are bound: the fold refers to them at every piece
    return let(F.transform(pieces, lambda x: x["n"]),
               lambda counts: let(_chunk_starts(counts, max_tokens, max_chunks, space), with_st))


def chunk_table(c: Column | str, max_tokens: int = DEFAULT_MAX_TOKENS, max_chunks: int = DEFAULT_MAX_CHUNKS,
                counter: Counter = count_tokens, titles: list[str] | None = None,
                units: Column | None = None, space: int = 0, comma: int = 1) -> Column:
    """Chunks of a cleaned text with packing facts, as one struct:

    ``chunks array<struct<chunk:string, n_tokens:int>>`` (first ``max_chunks``),
    ``total_chunks`` (before the cut, Q10), ``dropped_chunks`` (cut off),
    ``units`` (number of units).  Every intermediate is let-bound, so it is
    evaluated once per row.  ``space`` and ``comma`` are the tokens that the
    counter adds for a join.
    """
    u = units if units is not None else split_units(c, titles)
    return let(u, lambda us: let(expand_units(us, max_tokens, counter, comma),
                                 lambda exp: packed(exp, F.size(us), max_tokens, max_chunks, space)))


def build_chunks(c: Column | str, max_tokens: int = DEFAULT_MAX_TOKENS, max_chunks: int = DEFAULT_MAX_CHUNKS,
                 counter: Counter = count_tokens, titles: list[str] | None = None) -> Column:
    """Sentence-aligned chunks (strings) under a token budget, first
    ``max_chunks`` kept."""
    return F.transform(chunk_table(c, max_tokens, max_chunks, counter, titles)["chunks"], lambda x: x["chunk"])


def with_chunks(df: DataFrame, text_col: str, out_col: str = "chunks", max_tokens: int = DEFAULT_MAX_TOKENS,
                max_chunks: int = DEFAULT_MAX_CHUNKS, counter: Counter = count_tokens,
                titles: list[str] | None = None, full: bool = False) -> DataFrame:
    """Add ``out_col array<struct<chunk:string, n_tokens:int>>`` for the
    (cleaned) ``text_col``; with ``full`` the whole struct of ``chunk_table``.
    The column is produced once per row (see ``filters.materialize``):
    rewrites around a later ``explode`` or filter cannot copy the chunking
    expression.  ``counter`` is native or a ``counters.WordCounter``."""
    from chunkwise.functions.counters import WordCounter, with_counted_chunks
    from chunkwise.operators.filters import materialize

    if isinstance(counter, WordCounter):
        return with_counted_chunks(df, text_col, out_col, max_tokens, max_chunks, counter, titles, full)
    ch = chunk_table(F.col(text_col), max_tokens, max_chunks, counter, titles)
    return materialize(df, {out_col: ch if full else ch["chunks"]})


def chunk_texts(c: Column | str) -> Column:
    """``array<string>`` of chunk texts from a ``with_chunks`` column."""
    return F.transform(_col(c), lambda x: x["chunk"])


def pad_chunks(chunks: Column | str, max_chunks: int = DEFAULT_MAX_CHUNKS) -> Column:
    """Fixed-width chunk list and mask: an empty list becomes ``[""]``; cut to
    ``max_chunks``; pad with ``""``.  Returns struct(chunks, chunk_mask)."""
    def body(base: Column) -> Column:
        real = F.size(base)
        padded = F.concat(base, F.array_repeat(F.lit(""), F.lit(max_chunks) - real))
        mask = F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(max_chunks) - real))
        return F.struct(padded.alias("chunks"), mask.alias("chunk_mask"))

    ch = _col(chunks)
    return let(F.when(F.size(ch) == 0, F.array(F.lit(""))).otherwise(F.slice(ch, 1, max_chunks)), body)


def single_line(c: Column | str) -> Column:
    """LF and CR to spaces, then strip (single-line record format)."""
    return strip_ws(F.translate(_col(c), "\n\r", "  "))


def label_line(text: Column | str, label: Column | str) -> Column:
    """``__label__<label> <text>`` line of the supervised word-vector format."""
    return F.concat(F.lit("__label__"), _col(label).cast("string"), F.lit(" "), single_line(text))
