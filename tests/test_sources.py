import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import queries
from gradewise.sources import export_readable, preview, read_delimited, scratch_path, table_profile
from gradewise.sources.delimited import has_spanning_cells, unclean_line
from gradewise.sources.scratch import materialize
from gradewise.sources.spanning import _composed, _pieces, line_ends, spanning_records

# Files whose cells stay within their lines, and files where telling needs the whole file.
CLEAN = {
    "plain": 'k\tt\n1\ta\n2\tb\n',
    "quoted": 'k\tt\n1\t"a b"\n2\t"tab\there"\n',
    "escaped quote": 'k\tt\n1\t"a \\" b"\n2\tx\n',
    "inch mark": 'k\tt\n1\t5" pipe\n2\tx"y\n',
    "empty cells": 'k\tt\n1\t\n2\t""\n',
    "blank last line": 'k\tt\n1\ta\n\n2\tb\n',
}
SPANNING = {
    "two lines": 'k\tt\n1\t"a\nb"\n2\tc\n',
    "quotes that only look paired": 'k\tt\n1\tfoo"\n2\t"bar\nx"\n',
    "false close and real open": 'k\tt\nfoo"\t"bar\nz"\n2\tc\n',
    "carriage return": 'k\tt\r\n1\ta\r\n',
    "only separators": 'k\tt\n\t\n1\ta\n',
}


def _file(tmp_path, text):
    path = tmp_path / "table.tsv"
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("name", CLEAN)
def test_clean_files_read_the_same_in_splits(spark, tmp_path, name):
    path = _file(tmp_path, CLEAN[name])
    assert not has_spanning_cells(spark, path)
    whole = read_delimited(spark, path, schema="k string, t string", multi_line=True)
    split = read_delimited(spark, path, schema="k string, t string", multi_line=False)
    assert sorted(whole.collect(), key=str) == sorted(split.collect(), key=str)


def test_clean_lines_read_the_same_on_random_files(spark, tmp_path):
    rng = random.Random(5)
    pieces = ["a", "b", '"', "\t", "\n", "\\", " ", '\\"', '"a"', '\t"', '"\t', '"\n', '""']
    for i in range(400):
        body = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 10)))
        (tmp_path / f"f{i}.tsv").write_bytes(f"k\tt\tu\n{body}\n1\t2\t3\n".encode())
    file = F.col("_metadata.file_name").alias("file")
    lines = spark.read.text(str(tmp_path), lineSep="\n").select(file, "value")
    unclean = lines.groupBy("file").agg(F.bool_or(unclean_line(F.col("value"))).alias("unclean"))
    clean = {r["file"] for r in unclean.filter("not unclean").collect()}
    assert len(clean) > 50
    whole, split = (
        sorted(
            (
                tuple(r)
                for r in read_delimited(spark, str(tmp_path), schema="k string, t string, u string", multi_line=m)
                .select(file, "k", "t", "u")
                .collect()
                if r["file"] in clean
            ),
            key=str,
        )
        for m in (True, False)
    )
    assert whole == split


@pytest.mark.parametrize("name", SPANNING)
def test_files_that_may_span_lines_are_told(spark, tmp_path, name):
    assert has_spanning_cells(spark, _file(tmp_path, SPANNING[name]))


@pytest.mark.parametrize("spanning", [False, True])
def test_large_files_are_split(spark, tmp_path, with_conf, spanning):
    cell = '"two\nlines"' if spanning else "one line"
    text = "k\tt\n" + "".join(f"{i}\t{cell}\n" for i in range(5000))
    with_conf(spark__sql__files__maxPartitionBytes="4k", spark__sql__files__openCostInBytes="0")
    df = read_delimited(spark, _file(tmp_path, text), schema="k int, t string")
    assert df.rdd.getNumPartitions() > 1
    assert df.distinct().count() == 5000
    assert df.select("t").distinct().first()[0] == cell.strip('"')


def random_table(rng, records, width=3):
    """Cells with and without quotes, over lines, with escaped quotes, separators, and quotes amid text."""
    inside = ["a", "\n", "\t", '\\"', "\\\\", " ", "b\n", "\n\n"]
    outside = ["a", "b", "1", '5"', " ", '\\"']

    def cell():
        if rng.random() < 0.5:
            return "x" * (rng.random() < 0.7) + "".join(rng.choice(outside) for _ in range(rng.randint(0, 3)))
        return '"' + "".join(rng.choice(inside) for _ in range(rng.randint(0, 8))) + '"'

    return "".join("\t".join(cell() for _ in range(width)) + "\n" for _ in range(records))


def test_records_put_together_are_those_of_whole_files(spark, tmp_path):
    """Tables, and texts of random pieces; what is unclear is left out and said to be."""
    rng = random.Random(11)
    pieces = ["a", "b", "\t", "\n", '"', '\t"', '"\t', '"\n', '\n"', '\\"', "\\\\", " ", '"a"', '""', "\n\n", "12"]
    for i in range(400):
        junk = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        body = junk if i % 2 else random_table(rng, rng.randint(1, 8))
        (tmp_path / f"f{i:03}.tsv").write_bytes(f"k\tt\tu\n{body}".encode())
    files = sorted(str(f) for f in tmp_path.glob("*.tsv"))
    _, unclear = spanning_records(spark, files, "\t")
    sure = sorted(set(files) - {"/" + f.split(":", 1)[1].lstrip("/") for f in unclear})
    assert 250 < len(sure) < 400
    records, none = spanning_records(spark, sure, "\t")
    assert none == []
    schema = "k string, t string, u string"
    for options in ({}, {"lineSep": "\n"}):
        parsed = records.select(F.from_csv("record", schema, {"sep": "\t", "multiLine": "true", **options}).alias("r"))
        whole = spark.read.options(header=True, sep="\t", multiLine=True, **options).schema(schema).csv(sure)
        assert sorted(map(str, parsed.select("r.*").collect())) == sorted(map(str, whole.collect()))


def test_records_do_not_depend_on_where_a_file_is_split(spark):
    """Pieces of random splits, composed, against the same lines as one split."""
    rng = random.Random(2)
    tables = ["k\tt\tu\n" + random_table(rng, 30) for _ in range(12)]
    lines = [(t, i, line) for t, text in enumerate(tables) for i, line in enumerate(text[:-1].split("\n"))]
    outside, inside = line_ends(F.col("line"), "\t")
    ends = spark.createDataFrame(lines, "t int, i int, line string").select("t", "i", "line", outside, inside)
    by_table = {}
    for r in sorted(ends.collect(), key=lambda r: (r.t, r.i)):
        by_table.setdefault(r.t, []).append(tuple(r)[2:])

    def records(rows, cuts):
        blocks = [sum(c <= i for c in cuts) for i in range(len(rows))]
        columns = [["f"] * len(rows), blocks, *zip(*rows)]
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["file", "block", "line", "o", "i"])
        pieces = [r for b in _pieces(iter([batch])) for r in b.to_pylist()]
        last = {p["block"]: p for p in pieces}
        states = _composed(pa.Table.from_pylist(list(last.values()))).to_pylist()
        assert all(s["is_sure"] for s in states)
        starts, texts = {s["block"]: s["state"] for s in states}, []
        for p in pieces:
            if p["out_outside" if starts[p["block"]] == 0 else "out_inside"] == 2:
                raise AssertionError("unclear")
            begins = p["in_outside" if starts[p["block"]] == 0 else "in_inside"] == 0
            texts += [[p["text"]]] if begins else []
            if not begins:
                texts[-1].append(p["text"])
        return [t for t in map("\n".join, texts) if t]

    for rows in by_table.values():
        one = records(rows, [])
        assert one[0] == "k\tt\tu" and len(one) == 31
        for _ in range(30):
            cuts = sorted(rng.sample(range(1, len(rows)), rng.randint(1, min(12, len(rows) - 1))))
            assert records(rows, cuts) == one


def test_a_cell_longer_than_splits_is_one_cell(spark, tmp_path, with_conf):
    with_conf(spark__sql__files__maxPartitionBytes="16k", spark__sql__files__openCostInBytes="0")
    long = "line\n" * 20_000
    path = _file(tmp_path, f'k\tt\n1\t"{long}end"\n2\t"{long}"\n3\tx\n')
    rows = read_delimited(spark, path, schema="k int, t string", lineSep="\n", min_splits=2).collect()
    assert sorted(map(tuple, rows)) == [(1, f"{long}end"), (2, long), (3, "x")]


@pytest.mark.parametrize("cell", ['"left\nopen', '"two" words\nend', '"a\n"b'])
def test_files_that_end_unclearly_are_read_whole(spark, tmp_path, with_conf, cell):
    path = _file(tmp_path, "k\tt\n" + '1\t"two\nlines"\n' * 2000 + f"2\t{cell}\n")
    whole = read_delimited(spark, path, schema="k string, t string", multi_line=True)
    with_conf(spark__sql__files__maxPartitionBytes="16k", spark__sql__files__openCostInBytes="0")
    found = read_delimited(spark, path, schema="k string, t string", min_splits=2)
    assert found.rdd.getNumPartitions() == 1
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_names_and_types_of_files_that_span_lines(spark, tmp_path, with_conf):
    rows = '1\t2.5\t"a\nb"\t"2024-01-01\n10:00:00"\n2\t\tc\t\n'
    path = _file(tmp_path, '"k\n1"\tv\tt\td\n' + rows * 1500)
    whole = [read_delimited(spark, path, infer=i, multi_line=True) for i in (True, False)]
    with_conf(spark__sql__files__maxPartitionBytes="16k", spark__sql__files__openCostInBytes="0")
    found = [read_delimited(spark, path, infer=i, min_splits=2) for i in (True, False)]
    for ours, theirs in zip(found, whole):
        assert ours.dtypes == theirs.dtypes and ours.rdd.getNumPartitions() > 1
        assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))
    assert found[0].columns[0] == "k\n1" and dict(found[0].dtypes)["v"] == "double"
    assert dict(found[0].dtypes)["d"] == "string" and {kind for _, kind in found[1].dtypes} == {"string"}


def test_other_quotes_and_long_separators_are_read_whole(spark, tmp_path, with_conf):
    with_conf(spark__sql__files__maxPartitionBytes="1k", spark__sql__files__openCostInBytes="0")
    path = _file(tmp_path, "k\tt\n" + "".join(f"{i}\t'two\nlines'\n" for i in range(500)))
    assert read_delimited(spark, path, quote="'").count() == 500
    path = _file(tmp_path, "k||t\n" + "".join(f'{i}||"two\nlines"\n' for i in range(500)))
    assert read_delimited(spark, path, sep="||").count() == 500


def test_many_escapes_do_not_break_the_check(spark, tmp_path):
    path = _file(tmp_path, 'k\tt\n1\t"' + '\\"' * 20000 + '"\n')
    assert not has_spanning_cells(spark, path)
    assert read_delimited(spark, path).count() == 1


MIXED = {
    "clean.tsv": "k\tt\n" + "".join(f"{i}\tone line\n" for i in range(2000)),
    "deep/span.tsv": "k\tt\n" + "".join(f'{i}\t"two\nlines"\n' for i in range(2000, 2010)),
    "deep/crlf.tsv": "k\tt\r\n3000\ta\r\n",
    "other.txt": 'k\tt\n4000\t"left\nout"\n',
}


@pytest.mark.parametrize("options", [{"recursiveFileLookup": True}, {"pathGlobFilter": "*.tsv"}, {"recursiveFileLookup": True, "pathGlobFilter": "*.tsv"}, {"modifiedAfter": "2001-01-01T00:00:00"}])
@pytest.mark.parametrize("schema", [None, "k int, t string"])
def test_rows_do_not_depend_on_the_split_size(spark, tmp_path, with_conf, options, schema):
    for name, text in MIXED.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    whole = read_delimited(spark, str(tmp_path), schema=schema, multi_line=True, **options)
    wanted = sorted(map(tuple, whole.collect()))
    for size in ("128m", "4k"):
        with_conf(spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes="0")
        found = read_delimited(spark, str(tmp_path), schema=schema, **options)
        assert found.dtypes == [("k", "int"), ("t", "string")]
        assert sorted(map(tuple, found.collect())) == wanted
    if options != {"pathGlobFilter": "*.tsv"}:
        assert found.rdd.getNumPartitions() > 4  # one unclear file leaves the clean one in splits


def test_types_of_apart_read_files_meet(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("k\tv\te\tc\n1\t2\t\t007\n")
    (tmp_path / "b.tsv").write_text('k\tv\te\tc\n2\t2.5\t3\t"x\ny"\n')
    df = read_delimited(spark, str(tmp_path))
    assert df.dtypes == [("k", "int"), ("v", "double"), ("e", "int"), ("c", "string")]
    assert sorted(map(tuple, df.collect())) == [(1, 2.0, None, "007"), (2, 2.5, 3, "x\ny")]


def test_partition_columns_stay(spark, tmp_path):
    for part, cell in (("p=1", "plain"), ("p=2", '"two\nlines"')):
        (tmp_path / part).mkdir()
        (tmp_path / part / "f.tsv").write_text(f"k\tt\n1\t{cell}\n")
    rows = read_delimited(spark, str(tmp_path)).collect()
    assert sorted((r.k, r.t, r.p) for r in rows) == [(1, "plain", 1), (1, "two\nlines", 2)]


def test_types_are_inferred_and_empty_cells_are_null(spark, tmp_path):
    df = read_delimited(spark, _file(tmp_path, "a\tb\tc\n1\t2.5\tx\n2\t\ty\n3\t1e3\t\n"))
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, 2.5, "x"), (2, None, "y"), (3, 1000.0, None)]


def test_one_bad_number_makes_the_column_text(spark, tmp_path):
    assert read_delimited(spark, _file(tmp_path, "a\n1\noops\n")).dtypes == [("a", "string")]


def test_export_leaves_out_technical_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.0], [2.0])], "k int, features array<double>, unscaled_features array<double>")
    for exclude in (None, set()):
        export_readable(df, str(tmp_path / "out"), exclude)
        assert read_delimited(spark, str(tmp_path / "out"), sep=",").columns == ["k"]
    export_readable(df.drop("features"), str(tmp_path / "out"), {"unscaled_features", "k"} - {"k"})
    assert read_delimited(spark, str(tmp_path / "out"), sep=",").collect() == [(1,)]


def test_export_keeps_microseconds(spark, tmp_path):
    df = spark.sql("select timestamp_ntz'2024-01-01 10:11:12.123456' t, timestamp'2024-01-01 10:11:12.654321' z")
    export_readable(df, str(tmp_path / "out"))
    assert read_delimited(spark, str(tmp_path / "out"), schema=df.schema, sep=",").collect() == df.collect()


def test_profile_counts_and_names(spark, products):
    rows = table_profile(products).orderBy("position").collect()
    assert [r["column"] for r in rows] == products.columns
    assert {(r["n_rows"], r["n_columns"]) for r in rows} == {(7, 10)}
    assert rows[2]["type"] == "double"


def test_preview_is_long_and_ordered(products):
    long = preview(products, 2, order_by="row_id").collect()
    assert len(long) == 2 * len(products.columns)
    assert [(r["row"], r["field"], r["value"]) for r in long[:2]] == [
        (1, "row_id", "1"),
        (1, "nutrition_grade_fr", "a"),
    ]
    assert preview(products).count() == len(products.columns)
    assert preview(products, 3, transpose=False).count() == 3


def test_scratch_tables_go_to_the_folder_the_session_names(spark, products):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(folder)
    stored = materialize(products, "products", ("nutrition_grade_fr",))
    assert stored.columns == products.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, products.collect()))
    assert all(f.startswith(f"file:{folder}") or f.startswith(f"file://{folder}") for f in stored.inputFiles())


def test_no_task_writes_more_than_a_file_of_spanning_cells(spark, tmp_path, monkeypatch):
    rows = [(i, f'first "{i}"\nsecond', "en", "s", 20) for i in range(90)] + [(90, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.files_for(docs) == 1
    size = sum(len(r[1] or "") for r in rows)
    assert queries.files_for(docs, 500) == -(-size // 500)
    assert queries.files_for(docs.limit(0)) == 1
    monkeypatch.setattr(queries, "files_for", lambda docs: 4)
    read = queries.tsv_one_spanning_file(spark, str(tmp_path))
    assert sorted(map(tuple, read.collect())) == sorted(rows, key=lambda r: r[0])
    written = []
    monkeypatch.setattr(queries, "export_readable", lambda df, path, sep: written.append(df) or export_readable(df, path, sep=sep))
    queries.tsv_one_spanning_file(spark, str(tmp_path))
    assert max(r["count"] for r in written[0].groupBy(F.spark_partition_id()).count().collect()) <= 30
