"""Records found over many tasks per file, against one task that reads the file whole."""

import csv
import io
import random

import pytest

from reviewloom.operators.ingest import with_ingest_metadata
from reviewloom.sources.reviews_csv import scan_reviews_csv

HEADER = ["source", "source_id", "review_text", "posted_at", "user_name"]
BITS = ["a", "é", "日本", " ", ",", "\n", "\r\n", '"', '""', "x\ny", '",\n"', "\n\n", "'", "\\", "|", '"\n']


def rows(rng, n):
    return [[
        rng.choice(["a.com", "", "b"]), str(i), "".join(rng.choice(BITS) for _ in range(rng.randrange(12))),
        rng.choice(["2026/02/01 8:12", ""]), rng.choice(["u", "", "ü, v", "two\nlines"])] for i in range(n)]


def write(path, records, **options):
    out = io.StringIO()
    writer = csv.writer(out, **options)
    writer.writerow(HEADER)
    writer.writerows(records)
    path.write_bytes(out.getvalue().encode())


@pytest.fixture
def split_size(spark):
    """Blocks of a given size, so that small files have many."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        for name, value in zip(names, (size, 0)):
            spark.conf.set(name, str(value))

    yield set_to
    for name, value in before.items():
        spark.conf.set(name, value)


def read(spark, path):
    found = scan_reviews_csv(spark, path).orderBy("source_path", "row_number").collect()
    assert len({(r.source_path, r.row_number) for r in found}) == len(found)
    return found


@pytest.mark.parametrize("size", [90, 700, 10**8])
@pytest.mark.parametrize("options", [
    {"lineterminator": "\n"}, {"lineterminator": "\r\n"}, {"lineterminator": "\n", "quoting": csv.QUOTE_ALL}])
def test_blocks_give_what_the_writer_wrote(spark, tmp_path, split_size, size, options):
    rng = random.Random(size)
    records = {"a.csv": rows(rng, 25), "b.csv": rows(rng, 9), "header only.csv": []}
    for name, own in records.items():
        write(tmp_path / name, own, **options)
    split_size(size)
    found = read(spark, str(tmp_path))
    got = [[r[c] for c in HEADER] for r in found]
    assert got == [r for name in sorted(records) for r in records[name]]
    assert [r.row_number for r in found] == [i + 1 for name in sorted(records) for i in range(len(records[name]))]


@pytest.mark.parametrize("size", [16, 10**8])
def test_as_one_task_reads_it(spark, tmp_path, split_size, size):
    """Quotes inside unquoted fields, short and long rows, blank lines, an open end."""
    text = (
        'source,source_id,review_text,posted_at,user_name\n\n\na,1,5" disk,2026/02/01,u\nb,2\n\nc,3,"x\n\n""y"",z",d,e,f,g\n'
        'd,4,it"s,,\ne,5,"", ,\n,,,,\n"f","6","a,b","",""\ng,7,"l1\r\nl2",p,"u\n"\n')
    (tmp_path / "odd.csv").write_bytes(text.encode())
    split_size(size)
    got = [tuple(r[c] for c in HEADER) for r in read(spark, str(tmp_path))]
    assert got == [
        ("a", "1", '5" disk', "2026/02/01", "u"), ("b", "2", None, None, None), ("c", "3", 'x\n\n"y",z', "d", "e"),
        ("d", "4", 'it"s', "", ""), ("e", "5", "", " ", ""), ("", "", "", "", ""), ("f", "6", "a,b", "", ""),
        ("g", "7", "l1\r\nl2", "p", "u\n")]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, split_size):
    records = rows(random.Random(3), 2000)
    write(tmp_path / "big.csv", records)
    split_size(15_000)
    from reviewloom.sources import csv_records
    lines = spark.read.text(str(tmp_path), lineSep="\n")
    assert lines.rdd.getNumPartitions() > 4
    found = csv_records.read_records(spark, str(tmp_path))
    assert found.count() == len(records)


def test_large_offsets_are_shuffled(spark, tmp_path, split_size, monkeypatch):
    from reviewloom.sources import csv_records
    monkeypatch.setattr(csv_records, "fits_broadcast", lambda df: False)
    records = rows(random.Random(5), 40)
    write(tmp_path / "a.csv", records)
    split_size(300)
    assert [[r[c] for c in HEADER] for r in read(spark, str(tmp_path))] == records


def test_metadata_of_split_files(spark, tmp_path, split_size):
    write(tmp_path / "my file+1.csv", rows(random.Random(1), 40))
    split_size(100)
    stamped = with_ingest_metadata(scan_reviews_csv(spark, str(tmp_path)), "run_1", repeatable=True).collect()
    assert {r.source_file for r in stamped} == {"my file+1.csv"}
    assert sorted(r.row_number for r in stamped) == list(range(1, 41)) and len({r.row_id for r in stamped}) == 40
