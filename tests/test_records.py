"""Records across byte ranges against a reader of the whole file."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from wardline.sources import records as R


def split_records(raw: str, strip=False, sep="\n", keep=True):
    """(record, closed) by walking through all lines."""
    lines = raw.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    out, held = [], []
    for line in lines:
        held.append(line)
        if sum(x.count('"') for x in held) % 2 == 0:
            out.append((held, True))
            held = []
    if held:
        out.append((held, False))
    fold = [([x.removesuffix("\r") for x in h[:-1]] + [h[-1] if closed else h[-1].removesuffix("\r")] if strip else h)
            for h, closed in out]
    return [sep.join(h) for h, (_, closed) in zip(fold, out) if closed or keep]


def made_file(folder, seed, rows=60, unclosed=False):
    rng = random.Random(seed)
    bits = ["word", "a,b", 'say "hi"', "\n", "\n\n", "  ", "é日", '""', "\r\n", '"', "x" * 30]
    buf = io.StringIO()
    out = csv.writer(buf, lineterminator=rng.choice(["\n", "\r\n"]))
    out.writerow(["ROW_ID", "CATEGORY", "TEXT"])
    for i in range(rows):
        n = 250 if rng.random() < .03 else rng.randint(0, 8)             # some records span many ranges
        out.writerow([i, rng.choice(["Nursing", "a,b", ""]), "".join(rng.choice(bits) for _ in range(n))])
    raw = buf.getvalue() + ('999,x,"never closed\nmore' if unclosed else "")
    path = os.path.join(folder, f"notes{seed}.csv")
    with open(path, "w", newline="") as f:
        f.write(raw)
    return path, raw


@pytest.fixture(params=[150, 1 << 20])
def ranges(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "0" if request.param < 1000 else "4194304")
    yield request.param
    for n, v in zip(names, old):
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed,unclosed", [(1, False), (2, True)])
def test_records_across_ranges(spark, tmp_path, ranges, seed, unclosed):
    path, raw = made_file(str(tmp_path), seed, unclosed=unclosed)
    lines = R.physical_lines(spark, path)
    starts = lines.select("start").distinct().count()
    assert starts == 1 if ranges > 1 << 19 else starts > 10
    got = R.quoted_records(lines).orderBy("start", "seq").collect()
    assert [r.record for r in got] == split_records(raw)
    shuffled = R.quoted_records(lines, max_broadcast=0).orderBy("start", "seq").collect()
    assert [r.record for r in shuffled] == [r.record for r in got]
    spaced = R.quoted_records(lines, " ", strip_cr=True, unclosed="drop").orderBy("start", "seq").collect()
    assert [r.record for r in spaced] == split_records(raw, True, " ", keep=False)


def test_two_files_and_empty_ones(spark, tmp_path, ranges):
    raws = [made_file(str(tmp_path), seed)[1] for seed in (3, 4)]
    (tmp_path / "empty.csv").write_text("")
    got = R.quoted_records(R.physical_lines(spark, str(tmp_path))).orderBy("file", "start", "seq").collect()
    assert [r.record for r in got] == split_records(raws[0]) + split_records(raws[1])
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "empty.csv").write_text("")
    assert R.quoted_records(R.physical_lines(spark, str(tmp_path / "only"))).count() == 0


def test_csv_rows_equal_the_whole_file_reader(spark, tmp_path, ranges):
    path, raw = made_file(str(tmp_path), 5)
    want = [tuple(c or None for c in r) for r in csv.reader(io.StringIO(raw, newline=""))][1:]
    df = R.read_quoted_csv(spark, path)
    assert df.columns == ["ROW_ID", "CATEGORY", "TEXT"]
    got = sorted(((r[0], r[1] or None, r[2] or None) for r in df.collect()), key=lambda r: int(r[0]))
    assert got == want
    if ranges < 1000:
        assert df.rdd.getNumPartitions() > 1


def script(raw):
    """The note script's steps on a whole file, one after another."""
    lines = [x.replace('""', " ").replace("  ", " ") for x in raw.removesuffix("\n").split("\n")]
    lines = [x for x in lines if x.strip(" \t\n\r\f\v")]
    out = []
    for r in split_records("\n".join(lines) + "\n", True, " ", keep=False):
        parts = r.split('"')
        out.append('"'.join(p.replace(",", ";") if i % 2 else p for i, p in enumerate(parts)))
    return out


@pytest.mark.parametrize("seed", [6, 7])
def test_clean_note_records(spark, tmp_path, ranges, seed):
    path, raw = made_file(str(tmp_path), seed, unclosed=seed == 7)
    got = R.clean_note_records(spark, path).orderBy("start", "seq").collect()
    assert [r.record for r in got] == script(raw)
