import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from reviewloom.llm import warc


def rows():
    out = [(i, f"http://h/{i}", f"<p>page {i % 30}</p>" + "x" * (i % 7) * 50) for i in range(300)]
    out += [(1000 + i, "http://hot", "<html>hot page</html>") for i in range(200)]
    return out + [(2000, None, None), (2001, "", ""), (None, "http://null\r\nid", "<p>page 3</p>"), (5, "again", "<p>page 5</p>" + "x" * 250),
                  (3000, "http://long", "é" * 300_000)]


def expected(data, least):
    first = {}
    for page, _, html in data:
        b = (html or "").encode()
        if page is not None and len(b) >= least:
            first[b] = min(first.get(b, page), page)
    out = []
    for page, _, html in data:
        b = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        same = first.get(b, page)
        out.append((page, len(b), digest, "response" if same == page else "revisit", None if same == page else same))
    return sorted(out, key=repr)


def pages(spark, data):
    df = spark.createDataFrame(data, "page_id long, url string, html string")
    return df.withColumn("shard", F.lit("x")).withColumn("kind", F.lit(9))


def written(spark, folder, df, **options):
    manifest = warc.write_warc(df, f"file://{folder}", **options)
    return {r.name: r for r in manifest.collect()}


@pytest.mark.parametrize("least", [0, 30])
def test_round_trip(spark, tmp_path, least):
    df = pages(spark, rows())
    files = written(spark, tmp_path / "w", df.repartition(5), least_bytes=least, shard_bytes=5_000, roll_bytes=1_500)
    got = warc.read_warc(spark, f"file://{tmp_path}/w").drop("url").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows(), least)
    assert len(files) > 8 and sum(f.n_records for f in files.values()) == len(rows())
    for name, f in files.items():
        data = (tmp_path / "w" / name).read_bytes()
        assert len(data) == f.n_bytes and hashlib.sha256(data).hexdigest() == f.sha256
    ids = []
    for name in sorted(files):
        stream = io.BytesIO(gzip.decompress((tmp_path / "w" / name).read_bytes()))
        while (record := warc.read_record(stream)) is not None:
            ids.append(-1 if record[0] is None else int(record[0]))
    assert ids == sorted(ids)
    assert not (tmp_path / "w" / "_temporary").exists()


def test_reruns_write_equal_files(spark, tmp_path):
    options = dict(shard_bytes=4_000, roll_bytes=1_000)
    a = written(spark, tmp_path / "a", pages(spark, rows()).repartition(3), **options)
    b = written(spark, tmp_path / "b", pages(spark, rows()[::-1]).repartition(8), **options)
    assert {n: f.sha256 for n, f in a.items()} == {n: f.sha256 for n, f in b.items()}


def test_commit_may_run_twice(tmp_path):
    import pyarrow as pa

    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "t").write_text("x")
    row = {"shard": [0], "seq": [0], "temporary": ["_temporary/t"], "name": ["n"], "n_records": [1], "n_bytes": [1], "sha256": ["s"]}
    batch = pa.RecordBatch.from_pydict(row, schema=warc.MANIFEST)
    commit = warc._committer(f"file://{tmp_path}")
    list(commit(iter([batch])))
    list(commit(iter([batch])))
    assert (tmp_path / "n").read_text() == "x"
    (tmp_path / "n").unlink()
    with pytest.raises(FileNotFoundError):
        list(commit(iter([batch])))


def test_damage_is_noticed():
    good = warc.record("1", "u", b"payload", None, "2000-01-01T00:00:00Z")
    assert warc.read_record(io.BytesIO(good))[2] == 7
    with pytest.raises(ValueError):
        warc.read_record(io.BytesIO(good.replace(b"payload", b"pay1oad")))


def test_empty_table(spark, tmp_path):
    assert written(spark, tmp_path / "e", pages(spark, [])) == {}
    assert warc.read_warc(spark, f"file://{tmp_path}/e").count() == 0
