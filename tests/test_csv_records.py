"""CSV records over byte ranges: quotes, line breaks and malformed lines against the csv module on the whole file."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tributary.sources import csv_records as C
from tributary.sources.files import TARGETS_CSV_SCHEMA, ingest_files
from tributary.storage.tables import read_table, was_loaded

CELL = st.lists(st.sampled_from(["a", "é", '"', ",", "\n", "\r\n", " ", "1"]), max_size=6).map("".join)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(CELL, CELL), max_size=12), st.integers(1, 40), st.booleans(), st.sampled_from(["\n", "\r\n"]))
def test_ranges_of_any_size_give_the_files_records(spark, tmp_path_factory, rows, range_bytes, end, newline):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=newline, quoting=csv.QUOTE_ALL)
    writer.writerows([("b", "a"), *rows])
    text = out.getvalue() if end else out.getvalue().removesuffix(newline)
    path = tmp_path_factory.mktemp("csv") / "f.csv"
    path.write_bytes(text.encode())
    want, line = [], 1
    for record in csv.reader(io.StringIO(text, newline="")):
        raw = sum(c.count("\n") for c in record) + 1
        want.append((line, [record[1] or None, record[0] or None, None]))
        line += raw
    got = C.read_records(spark, f"file://{path}", ["a", "b", "c"], range_bytes=range_bytes)
    assert sorted((r.line, r.cells) for r in got.collect()) == want[1:]
    assert got.where("problem is not null").count() == 0


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a,b\n' + "".join(f'{i},"x\n""{i}"""\n' for i in range(3000)))
    got = C.read_records(spark, f"file://{path}", ["a", "b"], range_bytes=4000)
    per_task = [n for n in got.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    assert len(per_task) > 3 and sum(per_task) == 3000
    assert all(r.cells == [str((r.line - 2) // 2), f'x\n"{(r.line - 2) // 2}"'] for r in got.collect())


BAD = ('ano,mes,loja_id,categoria,meta_valor\n2024,1,1,"Móveis\ngrandes",10.5\n2024,x,1,c,1\n\n2024,1\n2024,2,2,d,n/d\n'
       '2024,3,3,"e" f,2\n2024,4,4,g,\n')


def test_rejects_are_kept_and_counts_add_up(spark, scratch, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "metas_vendas.csv").write_bytes(BAD.encode() + b"2024,5,5,\xff,3\n")
    root = scratch("rejects")
    got = ingest_files(spark, f"file://{landing}", f"{root}/bronze", "run1", most_rejected=0.8)["metas_vendas.csv"]
    rows = read_table(spark, f"{root}/bronze/files_metas_vendas").orderBy("mes").collect()
    assert [(r.mes, r.categoria, r.meta_valor) for r in rows] == [(1, "Móveis\ngrandes", 10.5), (4, "g", None)]
    bad = {r.line: (r.file.rsplit("/", 1)[-1], r.reason, r._loaded_at) for r in
           read_table(spark, f"{root}/bronze/_rejects/files_metas_vendas").collect()}
    assert {k: v[1] for k, v in bad.items()} == {
        4: "mes: not a bigint", 6: "2 cells instead of 5", 7: "meta_valor: not a double",
        8: "quotes: ',' expected after '\"'", 10: "not UTF-8"}
    assert {v[0] for v in bad.values()} == {"metas_vendas.csv"} and {v[2] for v in bad.values()} == {"run1"}
    assert got.rows + len(bad) == 7
    # beyond the share the load fails and leaves all tables; without one any wrong record fails it
    for most in (0.5, 0.0):
        with pytest.raises(Exception):
            ingest_files(spark, f"file://{landing}", f"{root}/other", "run2", most_rejected=most)
    assert not was_loaded(spark, f"{root}/other/files_metas_vendas")
    assert TARGETS_CSV_SCHEMA.names == ["ano", "mes", "loja_id", "categoria", "meta_valor"]
