"""CSV and JSON arrays by byte ranges, against readers of whole files."""

from __future__ import annotations

import csv
import io
import json
import random
import re

import pytest

from hirelake.plans import jobs as J
from hirelake.session import scratch_path
from hirelake.sources import landed as LD
from hirelake.sources import ranges as R


@pytest.fixture(params=[60, 1 << 20])
def by_ranges(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def csv_text(rng, n, crlf=False):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\r\n" if crlf else "\n")
    w.writerow(LD.CSV_COLUMNS)
    for i in range(n):
        cell = lambda: rng.choice(["", "plain", 'say "hi"', "a,b", "two\nlines", '"', '\n\n"x",\n', "é日", " pad "])
        w.writerow([str(i), *[cell() for _ in LD.CSV_COLUMNS[1:]]])
    return out.getvalue()


@pytest.mark.parametrize("crlf", [False, True])
def test_csv_against_the_csv_module(spark, tmp_path, by_ranges, crlf):
    rng = random.Random(by_ranges)
    want = []
    for name in ("a", "b"):
        text = csv_text(rng, 25, crlf)
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
        want += [tuple(r) for r in csv.reader(io.StringIO(text, newline="")) if r and r[0] != "id"]
    got = LD.src_csv(spark, str(tmp_path)).collect()
    assert sorted(tuple(r[c] for c in LD.CSV_COLUMNS) for r in got) == sorted(want)
    keys = {(r._file, r._idx) for r in got}
    assert len(keys) == len(got)
    for r in got:  # the key is where the record starts
        raw = open(re.sub("^file:/+", "/", r._file), "rb").read()
        assert raw[r._idx:].startswith(r.id.encode() + b",") and raw[r._idx - 1: r._idx] == b"\n"


def test_several_tasks_share_a_file(spark, tmp_path, by_ranges):
    (tmp_path / "a.csv").write_text(csv_text(random.Random(1), 60))
    blocks = {r._block for r in R.pieces(spark, str(tmp_path), "\n").collect()}
    assert (len(blocks) > 4) == (by_ranges < 1000)


def test_stray_quotes_do_not_spoil_the_rest(spark, tmp_path, by_ranges):
    lines = [",".join(LD.CSV_COLUMNS)] + [f'{i},https://x/{i},5" pipe {i},Co' for i in range(9)] + ['9,u,"q ""x"" q",Co', "10,u,t,Co"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n\n")
    got = {r.id: r.title for r in LD.src_csv(spark, str(tmp_path)).collect()}
    assert got == {**{str(i): f'5" pipe {i}' for i in range(9)}, "9": 'q "x" q', "10": "t"}


def test_json_arrays_against_the_json_module(spark, tmp_path, by_ranges):
    rng = random.Random(by_ranges + 1)
    want = []
    for name in range(3):
        rows = []
        for i in range(20):
            text = rng.choice(['a "q" b', "br{ace", "}{][", "tail\\", "\\\"}", "é日\n", "", None])
            rows.append({"id": str(i), "title": text, "tags": rng.choice([["x", "}"], [], None]), "salary": rng.choice(["1", None])})
        rows = [{"legal": "no}tice", "deep": {"a": [{"b": "}"}]}}, *rows]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) + "\n")
        want += [(r.get("id"), r.get("title")) for r in rows]
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "one.json").write_text('{"id": "solo", "title": "{t}", "x": {"y": 1}}')
    want.append(("solo", "{t}"))
    got = [(r := json.loads(x._rec)) and (r.get("id"), r.get("title")) for x in R.json_records(spark, str(tmp_path)).collect()]
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_dead_letters_do_not_depend_on_other_files(spark, tmp_path):
    head = ",".join(LD.CSV_COLUMNS)
    t = J.Tables(scratch_path(spark, "replay"))
    ids = []
    for n, rows in enumerate((["1,,t,c", "2,,t,c", "2,,t,c"], [f"{i},,t,c" for i in range(50, 90)])):
        (tmp_path / f"{'ba'[n]}.csv").write_text("\n".join([head, *rows]) + "\n")
        J.ingest(spark, LD.src_csv(spark, str(tmp_path)), t, "kaggle")
        ids.append({r.id for r in J.dead_letters(spark, t).collect()})
    assert len(ids[0]) == 3 and len(ids[1]) == 43 and ids[0] < ids[1]
