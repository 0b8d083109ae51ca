"""The dataset build end to end, line numbers and the one-pass tagging."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chunkwise import dataset as D
from chunkwise.operators import filters as FL
from chunkwise.operators import splits as SP
from chunkwise.operators import stats as ST
from chunkwise.sources import readers as R
from chunkwise.sources import sinks as K


def lines_of(spark, path):
    return [r[0] for r in spark.read.text(path).collect()]


@pytest.fixture
def source(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    texts = [f'Row {i}: "quoted" words, and more. {"Next sentence here. " * (12 + i % 5)}' for i in range(60)]
    body = ["text\tlabel", *[f"{t}\t{i % 3}" for i, t in enumerate(texts)], "", "no tab here", "bad\tx", "short\t1", texts[0] + "\t0"]
    (d / "a.txt").write_text("\n".join(body[:30]) + "\n", encoding="utf-8")
    (d / "b.txt").write_text("\n".join(body[30:]) + "\n", encoding="utf-8")
    return str(d), texts


def test_build_writes_every_output(spark, source, tmp_path):
    path, texts = source
    out = str(tmp_path / "out")
    ds = D.build_dataset(spark, path, out, max_tokens=30, max_chunks=2)
    assert ds.counts == {"kept": 61, "short_chars": 1, "no_tab": 1, "bad_label": 1}
    assert sorted((r["reason"], r["value"]) for r in ds.rejected.collect()) == [("bad_label", "bad\tx"), ("no_tab", "no tab here"), ("short_chars", None)]
    rows = ds.rows.collect()
    per = Counter(r["label"] for r in rows)
    assert per == {0: 21, 1: 20, 2: 20} and Counter((r["label"], r["split"]) for r in rows)[0, "test"] == 2
    for part in ("train", "test"):
        mine = sorted((r for r in rows if r["split"] == part), key=lambda r: r["id"])
        assert [r["id"] for r in mine] == list(range(len(mine)))
        pairs = sorted((r["text"], r["label"]) for r in mine)
        assert sorted(map(tuple, K.read_csv_split(spark, f"{out}/xgboost_{part}.csv").collect())) == pairs
        assert sorted(map(tuple, K.read_csv_split(spark, f"{out}/{part}_split.txt", "\t").collect())) == pairs
        assert sorted(lines_of(spark, f"{out}/fasttext_{part}.txt")) == sorted(f"__label__{n} {t}" for t, n in pairs)
        got = sorted((json.loads(x) for x in lines_of(spark, f"{out}/hbert_{part}.jsonl")), key=lambda r: r["id"])
        assert [(g["id"], g["text"], g["label"], g["chunks"], g["chunk_count"]) for g in got] == [
            (r["id"], r["text"], r["label"], r["chunks"], r["chunk_count"]) for r in mine]
    assert json.loads(lines_of(spark, f"{out}/label2id.json")[0]) == {"0": 0, "1": 1, "2": 2}
    assert json.loads(lines_of(spark, f"{out}/id2label.json")[0]) == {"0": "0", "1": "1", "2": "2"}
    m = json.loads(lines_of(spark, f"{out}/dataset_info.json")[0])
    assert set(m["outputs"].values()) == {f for f in os.listdir(out) if not f.startswith("_")} - {"dataset_info.json"}
    assert m["input"] == path and m["output_dir"] == out and m["total_samples"] == 61 and m["labels"] == [0, 1, 2]
    assert m["label_distribution_total"] == {"0": 21, "1": 20, "2": 20} and m["label_distribution_test"] == {"0": 2, "1": 2, "2": 2}
    assert m["hbert"]["train_dropped_chunks"] == sum(r["dropped_chunks"] for r in rows if r["split"] == "train") > 0
    assert m["hbert"]["train_max_chunks"] == 2.0


def test_build_of_nothing(spark, tmp_path):
    (tmp_path / "in.txt").write_text("text\tlabel\n\n")
    ds = D.build_dataset(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"))
    assert ds.counts == {} and ds.rows.count() == 0 and ds.manifest.first()["num_labels"] == 0


def test_line_numbers_do_not_depend_on_partitioning(spark, source):
    path, _ = source
    want = [x for f in ("a.txt", "b.txt") for x in open(f"{path}/{f}", encoding="utf-8").read().split("\n")[:-1]]
    seen = []
    for size in ("134217728", "700", "5000"):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = R.numbered_lines(spark, path).collect()
            good, _ = R.read_labeled(spark, path, row_id="doc_id")
            seen.append(sorted(map(tuple, SP.stratified_split(good).select("doc_id", "split").collect())))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert [r["value"] for r in sorted(got, key=lambda r: r["row_id"])] == want
        assert sorted(r["row_id"] for r in got) == list(range(len(want)))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 61


def test_line_reader_gives_row_ids(spark, tmp_path):
    (tmp_path / "x.txt").write_text("Text\tLabel\n\nfoo\t3\nbad\nq\t4\n")
    kept, _, bad = R.read_labeled_lines(spark, str(tmp_path / "x.txt"), FL.Limits(None, None, None), row_id="line")
    assert sorted(map(tuple, kept.collect())) == [(2, "foo", 3), (4, "q", 4)] and bad.first()["line"] == 3


def test_missing_category_file_falls_back(spark, tmp_path):
    got = R.read_categories(spark, str(tmp_path / "none.txt")).collect()
    assert [tuple(r) for r in got] == [(i, str(i)) for i in range(20)]


def test_rows_rejects_and_counts_from_one_scan(spark, tmp_path):
    rows = [(1, "a " * 150), (2, None), (3, "x"), (4, "." * 300), (4, "." * 300), (None, "word " * 3000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("extra", F.lit("e"))
    kept, bad, counts = FL.write_with_reason(df, str(tmp_path / "t"))
    want_kept, want_counts = FL.filter_with_reason(df)
    assert sorted(map(str, kept.collect())) == sorted(map(str, want_kept.collect()))
    assert counts == {r["reason"]: r["n"] for r in want_counts.collect()}
    assert kept.count() + bad.count() == len(rows) and set(bad.columns) == {"doc_id", "text", "extra", "reason"}
    assert FL.write_with_reason(df.limit(0), str(tmp_path / "e"))[2] == {}
    assert ST.OUTPUT_NAMES.keys() >= {"label2id"}
