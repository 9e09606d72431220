"""CSV with line breaks in its values, read by many tasks: the same rows as from one."""

import csv
import random

import pytest

from reelframe.sources import documents
from reelframe.sources.csv_splits import _record_ends, scan_records
from tests.test_splits import small_splits  # noqa: F401  (a fixture)

SCHEMA = "ID STRING, T STRING, N INT"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def awkward(rng, n):
    parts = ['"', "\\", ",", "\n", "\r\n", "é", "日本", " ", "a", '""', '",\n"', '"\n', "\n\n", "'", "\t"]
    return "".join(rng.choice(parts) for _ in range(n))


def record_ends_by_hand(text, inside):
    """Byte by byte: the line breaks outside quoted values."""
    ends, at_start, i = [], not inside, 0
    while i < len(text):
        c = text[i:i + 1]
        if inside:
            if c == b'"' and text[i + 1:i + 2] == b'"':
                i += 1
            elif c == b'"':
                inside = False
        elif c == b'"' and at_start:
            inside, at_start = True, False
        else:
            at_start = c in (b",", b"\n") or (at_start and c in (b" ", b"\t"))
            if c == b"\n":
                ends.append(i)
        i += 1
    return ends, inside


def test_record_ends():
    rng = random.Random(3)
    for _ in range(3000):
        text = awkward(rng, rng.randint(0, 14)).encode() + b"\n"
        for inside in (False, True):
            ends, open_ = _record_ends(text, inside)
            assert (ends.tolist(), open_) == record_ends_by_hand(text, inside), (text, inside)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_rows_as_from_one_task(spark, tmp_path, small_splits, newline):  # noqa: F811
    rng, rows = random.Random(11), []
    for f in range(3):
        some = [(f"{f}-{i}", awkward(rng, 9000 if i in (20, 21) else rng.choice([1, 3, 40, 60])) + "x", i)
                for i in range(150 if f else 1)]
        rows += some
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, quoting=csv.QUOTE_NONNUMERIC, lineterminator=newline)
            writer.writerow(["ID", "T", "N"])
            writer.writerows(some)
    (tmp_path / "header.csv").write_text('ID,"T\nwith a break",N\n')
    (tmp_path / "empty.csv").write_text("")
    assert scan_records(spark, str(tmp_path)).rdd.getNumPartitions() > 20  # many tasks
    assert rows_of(documents.scan_csv_records(spark, str(tmp_path), SCHEMA)) == sorted(rows, key=repr)


def test_plain_values_as_scan_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n ID ,T,N\n1, a"b ,2\n\n   \n2,"c ""d""\n e",x\n3\n,"",4\n5,say "hi, 5\n6,"q"r,6\n')
    got = rows_of(documents.scan_csv_records(spark, str(tmp_path), SCHEMA))
    assert got == sorted([("1", 'a"b ', 2), ("2", 'c "d"\n e', None), ("3", None, None), (None, None, 4),
                          ("5", 'say "hi', 5), ("6", '"q"r', 6)], key=repr)


def test_a_value_left_open(spark, tmp_path):
    (tmp_path / "good.csv").write_text("ID,T,N\n1,a,1\n")
    (tmp_path / "bad.csv").write_text('ID,T,N\n1,"a\nb,1\n')
    with pytest.raises(ValueError, match="bad.csv"):
        documents.scan_csv_records(spark, str(tmp_path), SCHEMA)
