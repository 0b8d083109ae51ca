"""DuckDB SQL building blocks for the oracle queries.

These restate the text rules in SQL (RE2 regexes, list lambdas) so the
driver can check the Spark results independently.  Packing is written as
the literal greedy loop that re-counts the growing candidate string at each
step, not as the integer fold the Spark side uses.
"""

from __future__ import annotations

from chunkwise.functions.text import SECTION_TITLES, TOKEN_PATTERN, WS

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+\\z', '', 'g')"


def clean(x: str) -> str:
    s = strip(x)
    s = f"regexp_replace({s}, '^\"+|\"+\\z', '', 'g')"
    s = f"replace(replace({s}, '锛?', ','), '路', ' ')"
    s = f"replace({s}, chr(13), chr(10))"
    s = f"regexp_replace({s}, '[ \\t]+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\n+', chr(10), 'g')"
    s = f"regexp_replace({s}, '{WS}+,', ',', 'g')"
    s = f"regexp_replace({s}, ',{WS}*', ', ', 'g')"
    s = f"regexp_replace({s}, '{WS}+', ' ', 'g')"
    return strip(s)


def mark(x: str) -> str:
    s = x
    for t in sorted(SECTION_TITLES, key=len, reverse=True):
        s = f"regexp_replace({s}, '(?i)\\b{t}\\b', chr(10) || '{t}' || chr(10), 'g')"
    return s


def units(x: str) -> str:
    s = f"regexp_replace({mark(x)}, '([.!?;]){WS}+([A-Z0-9])', '\\1' || chr(10) || '\\2', 'g')"
    return (f"list_filter(list_transform(string_split({s}, chr(10)), lambda up: {strip('up')}), "
            f"lambda uq: uq <> '')")


def ntok(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{TOKEN_PATTERN}'))"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({strip(x)}, '{WS}+'), lambda ww: ww <> '')"


def by_words(x: str, k: int, v: str = "g") -> str:
    w = words(x)
    return (f"list_transform(range(0, CAST(ceil(len({w}) / {k}) AS BIGINT)), "
            f"lambda {v}: array_to_string(({w})[{v} * {k} + 1 : {v} * {k} + {k}], ' '))")


def long_unit(u: str, k: int) -> str:
    """C6 on one unit expression ``u`` -> VARCHAR[] (literal greedy loop).
    A NULL sentinel appended to the parts flushes the last open group."""
    parts = f"list_filter(list_transform(string_split({u}, ','), lambda cp: {strip('cp')}), lambda cq: cq <> '')"
    cand = "CASE WHEN ca.cur = '' THEN cb ELSE ca.cur || ', ' || cb END"
    flush = "CASE WHEN ca.cur <> '' THEN list_append(ca.out, ca.cur) ELSE ca.out END"
    step = (f"lambda ca, cb: CASE WHEN cb IS NULL THEN {{'out': {flush}, 'cur': ''}} "
            f"WHEN {ntok(cand)} <= {k} THEN {{'out': ca.out, 'cur': {cand}}} "
            f"WHEN {ntok('cb')} > {k} THEN {{'out': list_concat({flush}, {by_words('cb', k, 'gw')}), 'cur': ''}} "
            f"ELSE {{'out': {flush}, 'cur': cb}} END")
    init = "{'out': []::VARCHAR[], 'cur': ''}"
    packed = f"list_reduce(list_append({parts}, NULL::VARCHAR), {step}, {init}).out"
    return (f"CASE WHEN {ntok(u)} <= {k} THEN [{u}] WHEN len({parts}) <= 1 THEN {by_words(u, k, 'gu')} "
            f"ELSE {packed} END")


def chunk_fold(units_list: str, k: int, m: int | None) -> str:
    """C7 over an already expanded VARCHAR[] ``units_list`` -> first ``m`` chunks."""
    cand = "CASE WHEN pa.cur = '' THEN pb ELSE pa.cur || ' ' || pb END"
    flush = "CASE WHEN pa.cur <> '' THEN list_append(pa.out, pa.cur) ELSE pa.out END"
    step = (f"lambda pa, pb: CASE WHEN pb IS NULL THEN {{'out': {flush}, 'cur': ''}} "
            f"WHEN {ntok(cand)} <= {k} THEN {{'out': pa.out, 'cur': {cand}}} "
            f"ELSE {{'out': {flush}, 'cur': pb}} END")
    full = f"list_reduce(list_append({units_list}, NULL::VARCHAR), {step}, {{'out': []::VARCHAR[], 'cur': ''}}).out"
    return f"({full})[1:{m}]" if m else full


DOCS = ("SELECT doc_id, {clean} AS text, CAST(substr(source, 4) AS INTEGER) AS label FROM documents"
        .format(clean=clean("text")))

RAW_DOCS = "SELECT doc_id, text, CAST(substr(source, 4) AS INTEGER) AS label FROM documents"


def reason(text: str, min_chars: int = 200, min_tokens: int = 50, max_tokens: int = 2040) -> str:
    return (f"CASE WHEN {text} IS NULL OR length({text}) < {min_chars} THEN 'short_chars' "
            f"WHEN {ntok(text)} < {min_tokens} THEN 'short_tokens' "
            f"WHEN {ntok(text)} > {max_tokens} THEN 'overlong' ELSE 'kept' END")


def held_out(n: str, ratio: float) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0 ELSE least(greatest(1, CAST(round_even({n} * {ratio}, 0) AS BIGINT)), {n} - 1) END"


def okey(key: str, seed: int, salt: str) -> str:
    return f"md5(concat_ws('|', '{seed}', '{salt}', CAST({key} AS VARCHAR)))"
