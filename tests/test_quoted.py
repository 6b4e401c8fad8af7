"""CSV records with line breaks inside quotes, read in many blocks."""

import random

import pytest

from lodestat.sources import quoted


def _field(rng):
    return rng.choice(["", "plain", "7", '"two\nlines"', '"a ""quoted"" word"', '"comma, here"', '"\n\n"', '" x\n""y""\n"', '""', "é漢"])


@pytest.fixture
def table(tmp_path):
    rng = random.Random(3)
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in ("a", "b"):
        lines = ["id,x,y"] + [f"{name}{i},{_field(rng)},{_field(rng)}" for i in range(150)]
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("block", ["90", "700", "64m"])
def test_records_over_block_borders_equal_the_one_task_read(spark, table, block):
    want = sorted(map(tuple, spark.read.csv(table, header=True, multiLine=True, escape='"').collect()), key=repr)
    names = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        df = quoted.read_quoted_csv(spark, table)
        assert block != "90" or df.rdd.getNumPartitions() > 20
        got = sorted(map(tuple, df.drop("_record").collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and len(got) == 300


def test_backslash_escapes_and_an_open_end(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x \\" y\nz"\n2,plain\n\n3,"never closed\nend')
    rows = sorted(r["record"] for r in quoted.records(spark, str(path), escape="\\").where("seq > 0").collect())
    assert rows == ['1,"x \\" y\nz"', "2,plain", '3,"never closed\nend']
