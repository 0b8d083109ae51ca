"""Readers and writers on small files (FIXTURES section 6 rows)."""

import json
import os
import tempfile

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

from chunkwise.operators import filters as FL
from chunkwise.operators import metrics as M
from chunkwise.sources import readers as R
from chunkwise.sources import sinks as K


def scratch():
    return tempfile.mkdtemp(prefix="chunkwise-test-")


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_read_labeled_lines_fixture_rows(spark):
    d = scratch()
    p = write(os.path.join(d, "in.txt"), 'Text\tLabel\n\nfoo "x" \\ y\t3\nbad row\nq\tz\n')
    kept, counts, bad = R.read_labeled_lines(spark, p, FL.Limits(None, None, None))
    assert [tuple(r) for r in kept.collect()] == [('foo "x" \\ y', 3)]
    assert sorted((r["value"], r["reason"]) for r in bad.collect()) == [("bad row", "no_tab"), ("q\tz", "bad_label")]
    assert {r["reason"]: r["n"] for r in counts.collect()} == {"kept": 1}
    with pytest.raises(R.BadRowsError):
        R.read_labeled_lines(spark, p, FL.Limits(None, None, None), mode="fail")


def test_read_labeled_header_and_headerless(spark):
    d = scratch()
    long_text = "word " * 60
    h = write(os.path.join(d, "h.tsv"), f"label\ttext\n1\t  \"{long_text}\"  \n2\tshort\n")
    good, bad = R.read_labeled(spark, h)
    rows = good.collect()
    assert len(rows) == 1 and rows[0]["label"] == 1 and rows[0]["text"] == long_text.strip()
    assert bad.count() == 0
    n = write(os.path.join(d, "n.tsv"), f"{long_text}\t7\n{long_text}\tx\n")
    good, bad = R.read_labeled(spark, n)
    assert [r["label"] for r in good.collect()] == [7] and bad.count() == 1


def test_read_categories(spark):
    d = scratch()
    p = write(os.path.join(d, "c.txt"), "3\tC\n1,A, x\n2 B two\nx\tbad\n\n")
    got = [tuple(r) for r in R.read_categories(spark, p).collect()]
    assert got == [(1, "A, x"), (2, "B two"), (3, "C")]
    e = write(os.path.join(d, "e.txt"), "\n")
    got = R.read_categories(spark, e).collect()
    assert len(got) == 20 and got[19]["name"] == "19"


def test_csv_round_trip(spark):
    d = scratch()
    rows = [('a "quoted", text', 1), ("tab\there \\ back", 2), ("line\nbreak", 3), (" lead and trail ", 4)]
    df = spark.createDataFrame(rows, "text string, label int")
    K.write_csv(df, os.path.join(d, "csv"))
    K.write_tsv(df, os.path.join(d, "tsv"))
    for sub, sep in (("csv", ","), ("tsv", "\t")):
        back = sorted(tuple(r) for r in K.read_csv_split(spark, os.path.join(d, sub), sep).collect())
        assert back == sorted(rows)


def test_label_lines_and_chunk_records(spark):
    d = scratch()
    df = spark.createDataFrame([(0, "Été.\nNext one", 5)], "id long, text string, label int")
    K.write_label_lines(df, os.path.join(d, "ft"))
    assert spark.read.text(os.path.join(d, "ft")).collect()[0][0] == "__label__5 Été. Next one"
    K.write_chunk_records(K.chunk_records(df, 510, 4), os.path.join(d, "jsonl"))
    raw = "".join(open(os.path.join(d, "jsonl", f), encoding="utf-8").read()
                  for f in os.listdir(os.path.join(d, "jsonl")) if f.endswith(".json"))
    rec = json.loads(raw)
    assert "Été" in raw and rec["chunks"] == ["Été. Next one"] and rec["chunk_count"] == 1


def test_evaluation_files_from_golden_matrix(spark):
    here = os.path.dirname(__file__)
    pairs = []
    with open(os.path.join(here, "data", "golden_confusion_counts.csv")) as f:
        for t, line in enumerate(f):
            for p, n in enumerate(line.strip().split(",")):
                pairs += [(t, p)] * int(n)
    pdf = spark.createDataFrame(pairs, "true int, pred int")
    cats = spark.createDataFrame([(i, f"C{i}") for i in range(20)], "label int, name string")
    rep = M.classification_report(pdf, cats.select("label"), cats)
    cm = M.confusion_matrix(pdf, cats.select("label"))
    d = scratch()
    K.write_evaluation(rep, cm, cats, d, "test")
    doc = json.loads(spark.read.text(os.path.join(d, "test_classification_report.json")).collect()[0][0])
    assert abs(doc["accuracy"] - 0.9192825112107623) < 1e-12
    assert abs(doc["macro avg"]["f1-score"] - 0.9200258705937129) < 1e-12
    assert abs(doc["weighted avg"]["precision"] - 0.9286395965768164) < 1e-12
    assert doc["C0"]["support"] == 12.0
    wide = spark.read.option("header", True).csv(os.path.join(d, "test_confusion_matrix.csv"))
    assert wide.columns[0] == "true\\pred" and wide.columns[1:] == [f"C{i}" for i in range(20)]
    assert wide.count() == 20


def test_model_round_trip(spark):
    d = scratch()
    model = Pipeline(stages=[SQLTransformer(statement="SELECT *, label + 1 AS y FROM __THIS__")]).fit(
        spark.createDataFrame([(1,)], "label int"))
    K.save_model(model, {"max_chunks": 4, "pooling": "attention"}, d, spark)
    m2, meta = K.load_model(spark, d, defaults={"max_chunks": 8, "pad_size": 512})
    assert meta == {"max_chunks": 4, "pad_size": 512, "pooling": "attention"}
    assert m2.transform(spark.createDataFrame([(2,)], "label int")).collect()[0]["y"] == 3


def test_read_documents_csv_multiline(spark):
    d = scratch()
    p = write(os.path.join(d, "raw.csv"),
              'ID,Resume_str,Resume_html,Category\n'
              '1,"Line one,\nline ""two""","<p>x</p>",HR\n'
              '2,plain,"<b>\nhtml\n</b>",CHEF\n')
    got = sorted(tuple(r) for r in R.read_documents_csv(spark, p).collect())
    assert got == [("1", 'Line one,\nline "two"', "HR"), ("2", "plain", "CHEF")]


def test_label_maps_written_as_json(spark):
    from chunkwise.operators import stats as ST

    d = scratch()
    df = spark.createDataFrame([(3,), (1,), (3,), (12,)], "label int")
    K.write_label_maps(ST.label_maps(df), d)
    l2i = json.loads(spark.read.text(os.path.join(d, "label2id")).collect()[0][0])["label2id"]
    i2l = json.loads(spark.read.text(os.path.join(d, "id2label")).collect()[0][0])["id2label"]
    assert l2i == {"1": 1, "12": 12, "3": 3} and i2l == {"1": "1", "12": "12", "3": "3"}
