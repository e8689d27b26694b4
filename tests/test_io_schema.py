"""Sources / sinks (A1, A3-A9) and schema validators (V1-V7)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from panelkit.operators import schema as V
from panelkit.sources import tables as A
from panelkit.spec import PanelSpec

SPEC = PanelSpec("ID", "target", ("p1", "p2"), {"bill": ("b1", "b2"), "status": ("s1", "s2")})


def test_load_raw_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="not found"):
        A.load_raw(spark, str(tmp_path / "nope.parquet"))


def test_load_raw_csv_with_title_row(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("ID,X\nID,X\n1,5\n2,6\n")
    df = A.load_raw(spark, str(p), schema=None, fmt="csv", junk_header_rows=1)
    assert [r["ID"] for r in df.collect()] == ["1", "2"]


@pytest.mark.parametrize("schema", [None, "ID long, LIMIT long, target int"])
def test_load_raw_names_in_the_second_line(spark, tmp_path, schema):
    p = tmp_path / "raw.csv"
    p.write_text("X0,X1,Y\nID,LIMIT,target\n1,500,0\n2,,1\n")
    if schema:
        from pyspark.sql import types as T
        schema = T._parse_datatype_string(schema)
    df = A.load_raw(spark, str(p), schema=schema, fmt="csv", junk_header_rows=1)
    assert df.columns == ["ID", "LIMIT", "target"]
    kind = int if schema else str
    assert [tuple(r) for r in df.orderBy("ID").collect()] == [(kind(1), kind(500), kind(0)), (kind(2), None, kind(1))]


def test_prepared_split_roundtrip_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", [1.0]), (2, "validation", [2.0]), (3, "test", [3.0])],
                               "ID long, split string, tabular array<float>")
    path = str(tmp_path / "prepared")
    A.write_prepared(df, path)
    one = A.read_split(spark, path, "validation")
    assert [r["ID"] for r in one.collect()] == [2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "validation" in plan
    dev = A.read_development(spark, path)
    assert sorted(r["ID"] for r in dev.collect()) == [1, 2]       # never the test partition
    with pytest.raises(FileNotFoundError):
        A.read_split(spark, str(tmp_path / "missing"), "train")


def test_csv_read_with_schema_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", 0, "abc")], "ID long, split string, target long, predictor_group_id string")
    out = A.write_report(df, str(tmp_path), "manifest", fmt="csv")
    back = A.read_csv_table(spark, out, df.schema)
    assert back.collect() == df.collect()
    meta = A.write_metadata(spark, str(tmp_path), "meta", {"seed": 42, "dims": [91, 15]})
    doc = json.loads(spark.read.text(meta).first()[0])
    assert doc == {"dims": [91, 15], "seed": 42}


def test_file_integrity_matches_hashlib(spark, tmp_path):
    import hashlib
    p = tmp_path / "f.bin"
    p.write_bytes(b"panel" * 1000)
    r = A.file_integrity(spark, str(p)).first()
    assert r["sha256"] == hashlib.sha256(b"panel" * 1000).hexdigest() and r["size_bytes"] == 5000


def _odd_files(top):
    """name -> bytes of files that a reader of lines could get wrong."""
    import random
    rnd = random.Random(3)
    noise = rnd.randbytes(20_000)
    few = bytes(x for x in rnd.randbytes(20_000) if x != 10)
    files = {"noise.bin": noise, "ends.bin": noise + b"\n", "blank.bin": b"\n\n\r\n" * 3000 + b"\n", "starts.bin": b"\n" + noise,
             "mark.bin": b"\xef\xbb\xbf" + noise, "mark_ends.bin": b"\xef\xbb\xbf\xef\xbb\xbf" + noise + b"\n\n", "one_line.bin": few,
             "wide.bin": few[:10_000] + b"\n" + few[10_000:], "a b[1]{x,y}%20.bin": noise[::-1], "small.bin": noise[:100]}
    for name, data in files.items():
        (top / name).write_bytes(data)
    return files


def test_file_integrity_reads_large_files_by_pieces(spark, tmp_path, monkeypatch):
    import hashlib
    files = _odd_files(tmp_path)
    monkeypatch.setattr(A, "WHOLE_BYTES", 1000, raising=False)
    conf = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.sources.binaryFile.maxLength": "1000"}  # no file above 1000 bytes may be read whole
    kept = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r["file_name"]: (r["size_bytes"], r["sha256"]) for r in A.file_integrity(spark, str(tmp_path)).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in files.items()}


def test_file_integrity_of_packed_files_and_folders(spark, tmp_path, monkeypatch):
    import gzip
    import hashlib
    monkeypatch.setattr(A, "WHOLE_BYTES", 1000, raising=False)
    data = {"x.gz": gzip.compress(os.urandom(5000)), "y.gz": b"not packed" * 500, "z.bin": os.urandom(5000)}
    for k, (name, content) in enumerate(data.items()):
        (tmp_path / f"k={k}").mkdir()
        (tmp_path / f"k={k}" / name).write_bytes(content)
    got = {r["file_name"]: r["sha256"] for r in A.file_integrity(spark, str(tmp_path)).collect()}
    assert got == {name: hashlib.sha256(content).hexdigest() for name, content in data.items()}


def test_sha256_goes_on_from_its_state():
    import hashlib

    from panelkit.functions.sha256 import Sha256, sha256_goes_on
    assert sha256_goes_on()
    data, state = os.urandom(10_000), None
    for a, b in ((0, 0), (0, 1), (1, 64), (64, 64), (64, 5000), (5000, 10_000)):  # blocks of 64 bytes and parts of them
        digest = Sha256(state)
        digest.update(data[a:b])
        state = digest.state()
        assert Sha256(state).hexdigest() == hashlib.sha256(data[:b]).hexdigest()


def test_model_save(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame([([0.0], 0.0), ([1.0], 1.0), ([0.2], 0.0), ([0.9], 1.0)], "f array<double>, label double")
    model = LogisticRegression(maxIter=5).fit(df.select(array_to_vector("f").alias("features"), "label"))
    path = A.save_model(model, str(tmp_path / "lr"))
    assert os.path.isdir(path)


def _panel(spark, rows=None):
    rows = rows or [(1, 0, 1.0, 2.0, 0, 1), (2, 1, 3.0, 4.0, -1, 2)]
    return spark.createDataFrame(rows, "ID long, target long, b1 double, b2 double, s1 long, s2 long")


def test_validators(spark):
    df = _panel(spark)
    V.validate_panel(df, SPEC, ["bill", "status"], expected_rows=2, forbidden=("PAY_1",))
    with pytest.raises(ValueError, match="rows instead of"):
        V.validate_panel(df, SPEC, ["bill"], expected_rows=3)
    with pytest.raises(ValueError, match="absent"):
        V.validate_panel(df.withColumn("PAY_1", F.lit(0)), SPEC, ["bill"], forbidden=("PAY_1",))
    with pytest.raises(ValueError, match="binary target"):
        V.validate_panel(df.withColumn("target", F.lit(0)), SPEC, ["bill"])
    with pytest.raises(TypeError, match="not numeric"):
        V.validate_panel(df.withColumn("b1", F.lit("x")), SPEC, ["bill"])
    with pytest.raises(ValueError, match="Required column"):
        V.validate_panel(df.drop("b2"), SPEC, ["bill"])


def test_schema_table_and_exact_columns(spark):
    t = V.schema_table(_panel(spark), SPEC, ["status"], forbidden=("PAY_1",)).collect()
    assert [(r["raw_column"], r["expected_present"], r["actual_present"]) for r in t] == [
        ("s1", True, True), ("s2", True, True), ("PAY_1", False, False)]
    V.require_exact_columns(_panel(spark).select("ID", "target"), ("ID", "target"))
    with pytest.raises(ValueError):
        V.require_exact_columns(_panel(spark).select("target", "ID"), ("ID", "target"))
