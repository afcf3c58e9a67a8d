"""Split CSV reading against reading in one task, exact column names, headers of any length."""
import csv
import io
import os
import random
import tempfile

import numpy as np
import pyarrow as pa
import pytest

from helpers import sale, tables
from qualis.operators import clean as CL
from qualis.operators import findings as FD
from qualis.operators import master as MS
from qualis.rules import Rules
from qualis.sources import csv_splits as C
from qualis.sources import names as NM
from qualis.sources import readers as R


def some_csv(rng, rows, crlf=False):
    cells = ["a", "", "x,y", 'say "hi"', "two\nlines", "\n", "a\n\n\nb", 'q"q', " pad ", "é\n,\"", ',"', "long " * 30 + "\n" * 3, "\r"]
    end = "\r\n" if crlf else "\n"
    text = io.StringIO(newline="")
    out = csv.writer(text, lineterminator=end)
    out.writerow(["k", "multi\nline", "v"])
    data = []
    for k in range(rows):
        row = [str(k), rng.choice(cells[:-1] if not crlf else cells[:4]), rng.choice(cells[:-1])]
        out.writerow(row)
        data.append(row)
        if rng.random() < 0.1:
            text.write(end)  # a blank line is no record
    return text.getvalue(), data


def batches(text, size):
    """What tasks get: the lines of each split of ``size`` bytes (a line belongs to the split it starts in)."""
    raw, at = text.encode(), 0
    groups = {}
    for line in raw.split(b"\n")[:-1] if raw.endswith(b"\n") else raw.split(b"\n"):
        # as Hadoop's line reader: a split reads the line that starts at its end as well
        blk = 0 if at == 0 else (at - 1) // size * size
        groups.setdefault(blk, []).append(line)
        at += len(line) + 1
    for blk, lines in groups.items():
        value = pa.array(lines, pa.binary()).cast(pa.string(), safe=False)
        yield [pa.RecordBatch.from_arrays([value, pa.array(["f"] * len(lines)), pa.array([blk] * len(lines), pa.int64())],
                                          ["value", "file", "blk"])]


class Held:
    def __init__(self, value):
        self.value = value


def split_read(text, size, held):
    sums = [r for task in batches(text, size) for r in C._summarize(",", True, held)(task)]
    table = pa.Table.from_batches(sums)
    places = Held(C.Places(table))
    got = [(i, t) for task in batches(text, size) for b in C._records(places, ",", True)(task)
           for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    parts, long = {}, set()
    for b in sums:
        for i, blk, t, f in zip(*(c.to_pylist() for r in C._crossing(places)([b]) for c in r.columns)):
            if t is None:
                long.add((f, blk))
            parts.setdefault((f, blk), []).append((i, blk, t))
    rows = [x for k, v in parts.items() if k not in long for x in v]
    for task in batches(text, size):
        for b in C._again(places, long, ",", True)(task):
            rows += list(zip(*(c.to_pylist() for c in b.columns)))
    joined = {}
    for i, _, t in sorted(rows):
        joined.setdefault(i, []).append(t)
    got += [(i, "\n".join(v)) for i, v in joined.items()]
    return sorted(got)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("held", [0, 40, 1 << 16])
def test_every_split_size_gives_the_same_records(seed, held):
    text, data = some_csv(random.Random(seed), 40, crlf=seed % 3 == 2)
    for size in [*range(1, 60), 97, 200, 500, 1 << 20]:
        got = split_read(text, size, held)
        assert [i for i, _ in got] == list(range(len(data))), size
        assert [next(csv.reader(io.StringIO(t.removesuffix("\r"), newline=""))) for _, t in got] == data, size


def test_ends_open_follows_the_cell_states():
    def plain(line, inside, sep):
        state = "in" if inside else "start"
        for c in line:
            if state == "start":
                state = "in" if c == '"' else "start" if c == sep else "text"
            elif state == "in":
                state = "quote" if c == '"' else "in"
            elif state == "quote":
                state = "in" if c == '"' else "start" if c == sep else "text"
            elif c == sep:
                state = "start"
        return state == "in"
    rng = random.Random(2)
    for _ in range(20000):
        line = "".join(rng.choice('",,a"') for _ in range(rng.randint(0, 9)))
        for inside in (False, True):
            assert C.ends_open(line, inside, ",") == plain(line, inside, ","), (line, inside)


@pytest.mark.parametrize("size", ["64k", "300k"])
def test_one_file_is_read_by_many_tasks(spark, size):
    d = tempfile.mkdtemp(prefix="qualis-csv-")
    text, data = some_csv(random.Random(9), 9000)
    with open(f"{d}/a.csv", "w", newline="", encoding="utf-8") as f:
        f.write(text)
    with open(f"{d}/b.csv", "w", newline="", encoding="utf-8") as f:
        f.write('v,k,extra\n"last\n1",x,y')
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, size)
    try:
        df = R.read_csv_text(spark, d, ["k", "v", "gone"])
        assert spark.read.text(f"{d}/a.csv", lineSep="\n").rdd.getNumPartitions() > 1
        got = sorted(((r["_row_id"], r["k"], r["multi\nline"], r["v"], r["extra"], r["gone"]) for r in df.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # an empty cell is NULL unless it is quoted; both are empty_to_null's matter
    want = [(n, k, m or None, v or None, None, None) for n, (k, m, v) in enumerate(data)] + [(len(data), "x", None, "last\n1", "y", None)]
    assert [tuple(x if x != "" else None for x in r) for r in got] == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_names_are_exact(spark):
    d = tempfile.mkdtemp(prefix="qualis-csv-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("Sale_ID,discount,Discount,x,x\nS-1,0.1,0.9,1,2\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("sale_id,Discount\nS-2,0.5\n")
    df = R.empty_to_null(R.read_csv_text(spark, d, ["sale_id"]))
    own = NM.own_names(df)
    rows = {r["_row_id"]: {own[c]: r[c] for c in df.columns if r[c] is not None} for r in df.collect()}
    assert rows == {0: {"Sale_ID": "S-1", "discount": "0.1", "Discount": "0.9", "x": "1", "x.1": "2", "_row_id": 0},
                    1: {"sale_id": "S-2", "Discount": "0.5", "_row_id": 1}}
    assert len({c.lower() for c in df.columns}) == len(df.columns)


def test_numbered_repeats_and_internal_names():
    out = NM.repeats_numbered(["x", "x", "x.1", "x", "y"])
    assert len(set(out)) == 5 and out[0] == "x" and out[2] == "x.1" and out[4] == "y"
    out = NM.internal(["Discount", "discount", "DISCOUNT", "other", "Other"], ["discount", "region"])
    assert out[1] == "discount" and out[3] == "other" and len({c.lower() for c in out}) == 5


def test_a_column_of_another_case_is_another_column(spark):
    rules = Rules(audit_date="2024-12-31")
    t = tables(spark, [sale(disc="0.2"), sale(sale_id="S-2", disc="0.9")])
    t["sales"] = t["sales"].withColumnRenamed("discount", "Discount")
    found = FD.findings(t, rules)
    assert found.where("check_id = 'BIZ_003' or column = 'discount'").count() == 0
    res = CL.clean(t, found, rules)
    assert "discount" not in [c for c in res.cleaned["sales"].columns]
    back = NM.restore(res.cleaned["sales"])
    assert "Discount" in back.columns
    assert sorted(r["Discount"] for r in back.collect()) == ["0.2", "0.9"]
    master = MS.build_master(res.cleaned)
    own = {c.lower() for c in master.columns}
    assert len(own) == len(master.columns)
    assert sorted(r[c] for r in master.collect() for c in master.columns if c.startswith("Discount")) == ["0.2", "0.9"]


def test_a_long_header_is_read_to_its_end(spark):
    d = tempfile.mkdtemp(prefix="qualis-csv-")
    head = [f"column_{'x' * 60}_{k}" for k in range(3000)]
    head[5] = "quoted\nname"
    with open(f"{d}/a.csv", "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(head)
        out.writerow([str(k) for k in range(3000)])
    assert os.path.getsize(f"{d}/a.csv") > 2 * R.HEADER_BYTES
    assert R.headers(spark, d).first()["columns"] == head
    row = R.read_csv_text(spark, d, head[:2]).select(head[0], f"`{head[2999]}`", "_row_id").first()
    assert tuple(row) == ("0", "2999", 0)


def test_splits_that_changed_are_an_error():
    t = pa.table({"file": ["f"], "blk": [0], "n0": [3], "open0": [False], "n1": [0], "open1": [True]})
    p = C.Places(t)
    assert p.of("f", 0) == (0, False, -1)
    with pytest.raises(RuntimeError, match="split differently"):
        p.of("f", 7)
    assert np.array_equal(p.files["f"][1], [0])
