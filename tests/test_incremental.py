"""Ingestion and incremental maintenance: each path equals a full recompute."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tributary.functions.dates import EPOCH_TEXT
from tributary.operators import latest_version
from tributary.sources.bronze import write_append, write_truncate
from tributary.sources.files import LANDING_FILES, ingest_files, write_csv
from tributary.sources.relational import incremental_extract, watermark_or_epoch
from tributary.sources.rest_series import ingest_series, read_series
from tributary.storage.tables import Table, read_table
from tributary.streaming.upsert import incremental_upsert, refresh_partitions, stream_latest

SCHEMA = "k long, ts long, v string"


def _log(spark, n=400, keys=37, seed=3):
    import random
    rnd = random.Random(seed)
    data = [(rnd.randrange(keys), rnd.randrange(50), f"v{i}") for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((v is None, v) for v in t))


def test_upsert_equals_full_recompute(spark, scratch):
    log = _log(spark)
    batches = [log.where(F.col("ts") < 15), log.where((F.col("ts") >= 15) & (F.col("ts") < 30)),
               log.where(F.col("ts") >= 30)]
    got = incremental_upsert(batches, scratch("upsert"), ["k"], ["ts"], ["v"])
    assert _sorted(got) == _sorted(latest_version(log, ["k"], ["ts"], ["v"]))


def test_upsert_null_keys_and_untouched_rows(spark, scratch):
    log = spark.createDataFrame(
        [(None, 1, "a"), (1, 1, "b"), (2, 5, "c"), (None, 3, "d"), (1, 0, "e"), (3, 9, "f")],
        SCHEMA)
    batches = [log.where(F.col("ts") < 2), log.where(F.col("ts") >= 2)]
    got = incremental_upsert(batches, scratch("upsert_null"), ["k"], ["ts"], ["v"])
    assert _sorted(got) == _sorted(latest_version(log, ["k"], ["ts"], ["v"]))
    assert got.count() == 4  # one NULL-key group, like the full recompute


def test_stream_upsert_resumes_and_matches(spark, scratch):
    log = _log(spark, seed=5)
    root = scratch("stream")
    ids = []
    for lo, hi in ((0, 20), (20, 35), (35, 50)):
        log.where((F.col("ts") >= lo) & (F.col("ts") < hi)).write.mode("append").parquet(
            f"{root}/bronze")
        _, merged, _ = stream_latest(spark, f"{root}/bronze", log.schema, f"{root}/state",
                                     f"{root}/ckpt", ["k"], ["ts"], ["v"])
        ids.extend(merged)
    assert ids == [0, 1, 2]  # each run only processed the newly landed files
    # a run without new files merges nothing
    _, merged, got = stream_latest(spark, f"{root}/bronze", log.schema, f"{root}/state",
                                   f"{root}/ckpt", ["k"], ["ts"], ["v"])
    assert merged == []
    assert _sorted(got) == _sorted(latest_version(log, ["k"], ["ts"], ["v"]))


FACT = "venda_id long, total double, ano long, mes long"


def _files(path):
    import glob
    import os
    return {f: os.path.getmtime(f) for f in glob.glob(path.removeprefix("file:") + "/*/*/*/part-*")}


def test_refresh_moves_and_removes_rows(spark, scratch):
    path = scratch("fact") + "/t"
    old = spark.createDataFrame([(1, 1.0, 2024, 1), (2, 2.0, 2024, 2), (4, 4.0, 2024, 4), (5, 5.0, None, None),
                                 (6, 6.0, None, None)], FACT)
    Table(spark, path).replace(old, ("ano", "mes"))
    untouched = {f: t for f, t in _files(path).items() if "mes=4" in f}
    # sale 1 is cancelled, 2 moves from February to March, 3 is new, 5 gets a date
    now = spark.createDataFrame([(2, 2.5, 2024, 3), (3, 3.0, 2024, 3), (5, 5.0, 2024, 1), (4, 4.0, 2024, 4)], FACT)
    changed = spark.createDataFrame([(1,), (2,), (2,), (3,), (5,)], "venda_id long")
    done = refresh_partitions(lambda keys: now.join(keys, "venda_id", "left_semi"), path, changed)
    assert [r[0] for r in _sorted(done.old)] == [1, 2, 5] and [r[0] for r in _sorted(done.new)] == [2, 3, 5]
    got = done.rows
    assert _sorted(got) == [(2, 2.5, 2024, 3), (3, 3.0, 2024, 3), (4, 4.0, 2024, 4), (5, 5.0, 2024, 1),
                            (6, 6.0, None, None)]
    assert {f: t for f, t in _files(path).items() if "mes=4" in f} == untouched
    # the last sale of a month and of the NULL month goes: their partitions go too
    none = now.limit(0)
    gone = spark.createDataFrame([(5,), (6,)], "venda_id long")
    got = refresh_partitions(lambda keys: none, path, gone).rows
    assert [r[0] for r in _sorted(got)] == [2, 3, 4]
    table = Table(spark, path)
    assert {p["path"].rsplit("/", 1)[0] for p in table.head()[1]["parts"]} == {"ano=2024/mes=3", "ano=2024/mes=4"}
    assert {f: t for f, t in _files(path).items() if "mes=4" in f} == untouched
    # the months in which the rows lie may be given: no other is searched
    months = spark.createDataFrame([(2024, 3)], "ano long, mes long")
    again = refresh_partitions(lambda keys: now.where("venda_id = 99"), path, spark.createDataFrame([(2,), (4,)], "venda_id long"),
                               had=months)
    assert [r[0] for r in _sorted(again.rows)] == [3, 4]
    # nothing changed, nothing written
    before = table.log.newest()
    refresh_partitions(lambda keys: none, path, spark.createDataFrame([(77,)], "venda_id long"))
    assert table.log.newest() == before


def test_failed_load_keeps_the_old_table(spark, scratch):
    import pytest
    path = scratch("safe") + "/t"
    write_truncate(spark.createDataFrame([("1",)], "v string"), path)
    bad = spark.createDataFrame([("2",), ("x",)], "v string").repartition(2).select(
        F.col("v").cast("long").cast("string").alias("v"))
    with pytest.raises(Exception):
        write_truncate(bad, path)
    assert [r.v for r in read_table(spark, path).collect()] == ["1"]
    # a failing rebuild of a gold model, and a session that overwrites partitions dynamically
    from tributary.plans.layers import materialize
    root = scratch("safe_gold")
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "x long, ano long, mes long")
    materialize(rows, root, "gold", "t", ("ano", "mes"))
    with pytest.raises(Exception):
        materialize(rows.withColumn("x", F.concat(F.lit("q"), "x").cast("long")), root, "gold", "t", ("ano", "mes"))
    assert read_table(spark, f"{root}/gold/t").count() == 2
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        again = materialize(rows.filter("mes = 2"), root, "gold", "t", ("ano", "mes"))
        assert [r.x for r in again.collect()] == [2]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_csv_columns_by_header_name(spark, scratch, tmp_path):
    import csv
    import pytest
    landing = tmp_path / "in"
    landing.mkdir()
    with open(landing / "metas_vendas.csv", "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerows([["mes", "ano", "extra", "meta_valor", "categoria", "loja_id"],
                          [1, 2024, "x", 1.5, 'Moveis "Premium"', 3], [2, 2024, "", "", 'a "b", c', 4]])
    with open(landing / "notes.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows([["what"], ["12"], ["1.5"], ["5D"]])
    root = scratch("headers")
    files = {**LANDING_FILES, "notes.csv": ("files_notes", None)}
    ingest_files(spark, f"file://{landing}", f"{root}/bronze", "run", files)
    rows = read_table(spark, f"{root}/bronze/files_metas_vendas").orderBy("mes").collect()
    assert [(r.ano, r.mes, r.loja_id, r.categoria, r.meta_valor) for r in rows] == [
        (2024, 1, 3, 'Moveis "Premium"', 1.5), (2024, 2, 4, 'a "b", c', None)]
    notes = read_table(spark, f"{root}/bronze/files_notes").collect()
    assert sorted((r.what, r.what_kind, r.what_long, r.what_double) for r in notes) == [
        ("1.5", "float", None, 1.5), ("12", "int", 12, 12.0), ("5D", "string", None, None)]
    # a malformed cell fails the load and leaves the table
    (landing / "metas_vendas.csv").write_text("ano,mes,loja_id,categoria,meta_valor\n2024,x,1,c,1\n")
    with pytest.raises(Exception):
        ingest_files(spark, f"file://{landing}", f"{root}/bronze", "run2")
    assert read_table(spark, f"{root}/bronze/files_metas_vendas").count() == 2


def test_series_http_answer_is_taken_whole(monkeypatch):
    import io
    from tributary.sources import rest_series as R
    asked = []

    def opener(url, timeout):
        asked.append(url)
        return io.BytesIO(b'[{"data": "31/12/2020", "valor": "1,5"}, {"data": "02/01/2021", "valor": null}]')

    monkeypatch.setattr(R.urllib.request, "urlopen", opener)
    reader = R.SeriesReader({"series": "dolar:1,ipca:433", "start": "2021-01-01", "end": "2024-01-01",
                             "url": "https://x/{code}?from={start}&to={end}"})
    parts = reader.partitions()
    assert len(parts) == 2                        # one request per series
    assert list(reader.read(parts[0])) == [("dolar", 1, "31/12/2020", "1,5"), ("dolar", 1, "02/01/2021", None)]
    assert asked == ["https://x/1?from=01/01/2021&to=01/01/2024"]


def test_requests_are_made_again(monkeypatch):
    import io
    import urllib.error
    import pytest
    from tributary.sources import rest_series as R
    waited, answers = [], []

    def opener(url, timeout):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return io.BytesIO(answer)

    def refused(code):
        return urllib.error.HTTPError("https://x", code, "no", None, None)

    monkeypatch.setattr(R.urllib.request, "urlopen", opener)
    monkeypatch.setattr(R.time, "sleep", waited.append)
    answers[:] = [refused(503), TimeoutError(), b"[]"]
    assert R._get("https://x", 1) == b"[]" and waited == [5.0, 10.0]
    answers[:] = [refused(429)] * 4
    with pytest.raises(urllib.error.HTTPError):
        R._get("https://x", 1)
    answers[:] = [refused(404), b"[]"]
    with pytest.raises(urllib.error.HTTPError):
        R._get("https://x", 1)
    assert answers == [b"[]"]


def test_indicator_mean_is_not_rounded(spark):
    from tributary.operators import monthly_vs_indicator
    sales = spark.createDataFrame([(dt.date(2024, 1, 5), 10.0)], "data date, total double")
    rates = spark.createDataFrame([(dt.date(2024, 1, 1), 4.8916), (dt.date(2024, 1, 2), 4.9234)],
                                  "data date, dolar double")
    assert monthly_vs_indicator(sales, rates, indicator="dolar").first().dolar_medio == 4.9075


def test_append_guard_watermark_and_counts(spark, scratch):
    path = scratch("bronze") + "/t"
    assert watermark_or_epoch(spark, path) == EPOCH_TEXT
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10)), (2, dt.datetime(2024, 1, 2))],
                                "id long, updated_at timestamp")
    first = write_append(incremental_extract(src, "updated_at", EPOCH_TEXT, "run1", "erp.t"), path)
    assert (first.rows, first.written) == (2, True)
    since = watermark_or_epoch(spark, path, "updated_at")
    assert since == "2024-01-02T00:00:00"
    empty = write_append(incremental_extract(src, "updated_at", since, "run2", "erp.t"), path)
    assert (empty.rows, empty.written) == (0, False)
    assert read_table(spark, path).count() == 2
    # truncate replaces
    write_truncate(src.limit(1), path)
    assert read_table(spark, path).count() == 1


def test_landing_csv_missing_file_is_skipped(spark, scratch):
    root = scratch("landing")
    targets = spark.createDataFrame([(2024, 1, 1, "Móveis", 15000.0), (2024, 1, 2, "a,b", 1.5)],
                                    "ano long, mes long, loja_id long, categoria string, "
                                    "meta_valor double")
    write_csv(targets, f"{root}/in/metas_vendas.csv")
    res = ingest_files(spark, f"{root}/in", f"{root}/bronze", "run")
    assert res["lojas.csv"] is None and res["metas_vendas.csv"].rows == 2
    table = LANDING_FILES["metas_vendas.csv"][0]
    back = read_table(spark, f"{root}/bronze/{table}")
    assert sorted(r.categoria for r in back.collect()) == ["Móveis", "a,b"]
    assert set(back.columns) >= {"_loaded_at", "_source"}


def test_series_source_partitions_and_parsing(spark, scratch, tmp_path):
    api = tmp_path / "api"
    api.mkdir()
    (api / "s1.json").write_text(json.dumps([
        {"data": "02/01/2023", "valor": "5,25"}, {"data": "03/01/2024", "valor": "5,5"},
        {"data": "01/01/2019", "valor": "1"}]))
    url = f"file://{api}/s{{code}}.json"
    raw = read_series(spark, {"dolar": 1}, dt.date(2022, 1, 1), dt.date(2024, 12, 30), url)
    assert raw.rdd.getNumPartitions() == 1        # one request per series
    assert sorted(r.data for r in raw.collect()) == ["02/01/2023", "03/01/2024"]
    path = scratch("series") + "/series"
    res = ingest_series(spark, {"dolar": 1}, dt.date(2024, 12, 31), url, path, "run")
    assert res.rows == 2
    vals = sorted(r.valor for r in read_table(spark, path).collect())
    assert vals == [5.25, 5.5]


def test_ingest_incremental_loop_both_watermarks(spark, scratch):
    from tributary.sources.relational import TableSpec, ingest_incremental
    src = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 2))],
        "id long, updated_at timestamp")
    specs = (TableSpec("vendas", "updated_at"),)
    for on_cursor, expect_second in ((False, 0), (True, 1)):
        root = scratch(f"erp_{on_cursor}")
        first = ingest_incremental(spark, lambda s: src, root, "2024-01-01T07:00:00", specs,
                                   watermark_on_cursor=on_cursor)
        assert first["vendas"].rows == 2
        # a row committed late: its cursor is older than the last run's clock
        late = src.unionByName(spark.createDataFrame(
            [(3, dt.datetime(2020, 1, 3))], "id long, updated_at timestamp"))
        second = ingest_incremental(spark, lambda s: late, root, "2024-01-02T07:00:00", specs,
                                    watermark_on_cursor=on_cursor)
        assert second["vendas"].rows == expect_second


def test_normalise_types_decimal_and_date(spark):
    from decimal import Decimal
    from tributary.sources.bronze import normalise_types
    df = spark.createDataFrame([(Decimal("10.50"), dt.date(2024, 3, 1), "x")],
                               "p decimal(10,2), d date, s string")
    r = normalise_types(df).first()
    assert (r.p, r.d, r.s) == (10.5, "2024-03-01", "x")


def test_stream_upsert_many_micro_batches_in_one_run(spark, scratch):
    log = _log(spark, seed=11)
    root = scratch("stream_many")
    for lo, hi in ((0, 10), (10, 25), (25, 40), (40, 50)):
        (log.where((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1)
         .write.mode("append").parquet(f"{root}/bronze"))
    _, merged, got = stream_latest(spark, f"{root}/bronze", log.schema, f"{root}/state",
                                   f"{root}/ckpt", ["k"], ["ts"], ["v"], max_files_per_trigger=1)
    assert merged == [0, 1, 2, 3]        # one file per micro-batch, chained versions
    assert _sorted(got) == _sorted(latest_version(log, ["k"], ["ts"], ["v"]))


def test_jdbc_range_covers_the_new_rows_only(spark, scratch):
    from tributary.sources.relational import TableSpec, bounds_query, ingest_incremental, range_reads
    spec = TableSpec("vendas", "updated_at")
    assert bounds_query(spec, "2024-01-01T00:00:00") == (
        "(SELECT MIN(id) AS lo, MAX(id) AS hi FROM vendas WHERE updated_at > '2024-01-01T00:00:00') bounds")
    assert "WHERE" not in bounds_query(spec)
    assert [range_reads(1, 10, 16), range_reads(0, 10**9, 16), range_reads(5, 5, 16)] == [1, 16, 1]
    asked = []

    def source(spec, since):
        asked.append(since)
        return spark.createDataFrame([(1, dt.datetime(2020, 1, 1))], "id long, updated_at timestamp")

    ingest_incremental(spark, source, scratch("since"), "2024-01-01T07:00:00", (spec,))
    assert asked == [EPOCH_TEXT]
