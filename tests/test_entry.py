"""Driver contract of __spark_entry__: flagship schema, registered keys and
their oracle coverage."""

import re

import __spark_entry__ as E

ROWS_ONLY = {"reduce_dims", "tree_baseline", "wordvec_baseline", "fit_select"}


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "n_docs", "avg_chunks", "max_chunks"]
    rows = df.collect()
    assert len(rows) == 20 and all(r["n_docs"] > 0 for r in rows)


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if not re.match(r"op\d+_|pipeline$", k)}  # the optional subpackage has tests of its own
    assert own - set(o) == ROWS_ONLY
    assert len(own) == 60


def test_results_do_not_depend_on_ansi_mode(spark):
    q = E.queries()
    sf = "/root/testdata/sf0.001"
    keys = ["split_long_unit", "pad_chunks", "cast_label"]
    on = {k: sorted(map(tuple, q[k](spark, sf).collect())) for k in keys}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        off = {k: sorted(map(tuple, q[k](spark, sf).collect())) for k in keys}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert on == off


def test_a_missing_optional_library_leaves_the_core():
    """In a process of its own, as the modules are loaded here already."""
    import subprocess
    import sys

    code = ("import sys, warnings; sys.modules['public_tokenizers'] = None; warnings.simplefilter('ignore'); "
            "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=E.__file__.rsplit("/", 1)[0])
    assert out.stdout.split() == ["60", "56"]
