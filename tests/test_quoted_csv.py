"""Quoted CSV by ranges against the texts that were written."""

import random

import pytest

from notesight.sources.quoted_csv import Quoting, csv_records, read_quoted_csv
from notesight.sources.tables import load_table, save_table

PARTS = ["a", "b", " ", '"', ",", "\n", "\r\n", "\\", "é", "\n\n", '""']


def written(value, escape):
    if value is None:
        return ""
    inner = value.replace('"', '""') if escape == '"' else value.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{inner}"'


@pytest.fixture
def ranges(spark):
    """Sets the size of input splits."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def of(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield of
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.mark.parametrize("escape", ['"', "\\"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_give_the_rows_of_one(spark, tmp_path, ranges, escape, end):
    rng = random.Random(2)
    text = lambda: "".join(rng.choices(PARTS, k=rng.choice([0, 1, 3, 30, 400]))) or None
    rows = [(i, text(), text()) for i in range(60)]
    for k in range(2):
        with open(tmp_path / f"f{k}.csv", "w", newline="") as f:
            f.write(f'id,"a{end}name",b{end}')  # the header too has a line break
            f.writelines(f"{i},{written(a, escape)},{written(b, escape)}{end}" for i, a, b in rows[k::2])
    for size in (1 << 30, 600):
        ranges(size)
        df = read_quoted_csv(spark, str(tmp_path), "id int, a string, b string", escape=escape)
        # the line ends of the file are line feeds in its fields
        wanted = [tuple(v.replace(end, "\n") if isinstance(v, str) else v for v in row) for row in rows]
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(wanted, key=repr)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 20
    assert read_quoted_csv(spark, str(tmp_path), escape=escape).columns == ["id", "a\nname", "b"]


def test_records_over_many_ranges_and_odd_files(spark, tmp_path, ranges):
    long = "line of it\n" * 400
    texts = {"long": f'h,i\n1,"{long}"\n2,"x"\n', "open": 'h,i\n3,"never closed\nat all', "none": "", "only": "h,i\n",
             "blank": 'h,i\n\n4,5" tall\n\n6,"y"'}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    ranges(300)
    rows = sorted(map(tuple, read_quoted_csv(spark, str(tmp_path), "h int, i string").collect()))
    assert rows[:2] == [(1, long), (2, "x")] and rows[3:] == [(4, '5" tall'), (6, "y")]
    assert rows[2][0] == 3 and rows[2][1].endswith("never closed\nat all")
    records = [r.record for r in csv_records(spark, str(tmp_path / "long.csv"), Quoting()).collect()]
    assert sorted(records) == sorted(["h,i", f'1,"{long}"', '2,"x"'])


@pytest.mark.parametrize("line, outside, inside", [
    ("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('a,"b', True, False), ('x""y', False, True), ('"a""', True, False),
    ('"a"",b', True, False), ('"",b', False, True), ('"a",b,"c', True, True), ("", False, True),
])
def test_states(line, outside, inside):
    assert Quoting().ends_inside(line, False) is outside
    assert Quoting().ends_inside(line, True) is inside


def test_backslash_states():
    quoting = Quoting(escape="\\")
    assert quoting.ends_inside('"a\\"', False) and not quoting.ends_inside('"a\\\\"', False) and quoting.ends_inside("\\", True)


def test_a_table_can_replace_itself(spark, tmp_path):
    folder = str(tmp_path)
    schema = "n long, t string"
    save_table(spark.createDataFrame([(1, 'a\n"b"'), (2, "c")], schema), "t.csv", folder)
    save_table(load_table(spark, "t.csv", folder, schema, multi_line=True).filter("n = 1"), "t.csv", folder)
    assert [tuple(r) for r in load_table(spark, "t.csv", folder, schema, multi_line=True).collect()] == [(1, 'a\n"b"')]
    assert [p.name for p in tmp_path.iterdir()] == ["t.csv"]
