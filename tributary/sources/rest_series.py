"""Economic time series from an HTTP JSON API, as a Spark data source.

``spark.read.format("series_api")`` plans one input partition per
(series, date slice), so series and years are fetched in parallel by the
executors instead of one after another in the driver.  Each partition makes
one GET ``url`` request, with ``{code}``, ``{start}`` and ``{end}``
(``dd/MM/yyyy``) filled in, and expects a JSON array of
``{"data": "dd/MM/yyyy", "valor": "<number>"}``.  Storage locations
(local, ``file:``, ``hdfs://``, ``s3://`` ... through ``pyarrow.fs``) are
accepted as well: a JSON file, or a folder of JSON-lines part files such as
a recorded response, which is how the tests replay it offline.

Options: ``series`` (``name:code,name:code``), ``start``/``end``
(``yyyy-MM-dd``), ``url``, ``slice_days`` (default 365) and ``timeout``
(seconds, default 30).  Rows are returned as text; value parsing happens in
Spark (``tributary.sources.bronze.normalise_series_rows``).
"""

from __future__ import annotations

import datetime as dt
import http.client
import json
import sys
import time
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tributary.session import qualified_path
from tributary.sources.bronze import LoadResult, normalise_series_rows, write_truncate
from tributary.sources.schemas import SERIES_BRONZE

# The economic series loaded every run, name -> series code
# (dollar selling rate, daily; Selic rate, daily; IPCA inflation, monthly).
SERIES = {"dolar": 1, "selic": 11, "ipca": 433}

SOURCE_NAME = "series_api"
SCHEMA = "serie string, codigo bigint, data string, valor string"
WINDOW_DAYS = 3 * 365


class SeriesSlice(InputPartition):
    def __init__(self, name: str, code: int, start: dt.date, end: dt.date):
        super().__init__((name, code, start.isoformat(), end.isoformat()))
        self.name, self.code, self.start, self.end = name, code, start, end


def _br(d: dt.date) -> str:
    return d.strftime("%d/%m/%Y")


def _parse_br(text: str) -> dt.date:
    day, month, year = (int(x) for x in text.strip().split("/"))
    return dt.date(year, month, day)


def _records(body: str) -> list[dict]:
    body = body.strip()
    if not body:
        return []
    if body.startswith("["):
        return json.loads(body)
    return [json.loads(line) for line in body.splitlines() if line.strip()]


# A request is made again so often, after so many seconds that double each time.
RETRIES, WAIT_SECONDS = 3, 5.0


def _get(url: str, timeout: float, retries: int = RETRIES, wait: float = WAIT_SECONDS) -> bytes:
    """GET ``url``; network failures and answers that say "later" (429, 5xx) are tried again, others raise at once."""
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as resp:  # noqa: S310
                return resp.read()
        except (OSError, http.client.HTTPException) as error:  # urllib's errors and time-outs are OSErrors
            code = getattr(error, "code", None)
            if attempt == retries or code is not None and code != 429 and code < 500:
                raise
            time.sleep(wait * 2 ** attempt)
    raise AssertionError("unreachable")


def _fetch(url: str, timeout: float) -> list[dict]:
    """GET ``url`` and return its records; raises on HTTP errors that stay.

    Non-HTTP locations (local paths, ``file:``, ``hdfs://``, ``s3://`` ...)
    are read with ``pyarrow.fs``; a folder yields all its ``*.json`` files
    (JSON arrays or JSON lines), e.g. a replay written by Spark.
    """
    scheme = urllib.parse.urlparse(url).scheme
    if scheme in ("http", "https"):
        return _records(_get(url, timeout).decode("utf-8"))
    from pyarrow import fs as pafs
    if scheme == "file" or not scheme:
        filesystem, path = pafs.LocalFileSystem(), urllib.parse.urlparse(url).path or url
    else:
        filesystem, path = pafs.FileSystem.from_uri(url)
    info = filesystem.get_file_info(path)
    if info.type == pafs.FileType.Directory:
        files = sorted(f.path for f in filesystem.get_file_info(pafs.FileSelector(path))
                       if f.path.endswith(".json"))
    else:
        files = [path]
    rows: list[dict] = []
    for f in files:
        with filesystem.open_input_stream(f) as stream:
            rows.extend(_records(stream.read().decode("utf-8")))
    return rows


class SeriesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.series = [(n.strip(), int(c)) for n, c in
                       (item.split(":") for item in options["series"].split(","))]
        self.start = dt.date.fromisoformat(options["start"])
        self.end = dt.date.fromisoformat(options["end"])
        self.url = options["url"]
        # One request per series and window unless a slice length is given.
        days = (self.end - self.start).days + 1
        self.slice_days = int(options.get("slice_days") or max(1, days))
        self.timeout = float(options.get("timeout", "30"))

    def partitions(self):
        parts = []
        for name, code in self.series:
            lo = self.start
            while lo <= self.end:
                hi = min(self.end, lo + dt.timedelta(days=self.slice_days - 1))
                parts.append(SeriesSlice(name, code, lo, hi))
                lo = hi + dt.timedelta(days=1)
        return parts

    def read(self, partition: SeriesSlice):
        url = self.url.format(code=partition.code, start=_br(partition.start),
                              end=_br(partition.end))
        # The API's answer is the slice; a replayed file holds the whole series.
        replay = urllib.parse.urlparse(url).scheme not in ("http", "https")
        for rec in _fetch(url, self.timeout):
            if not replay or partition.start <= _parse_br(rec["data"]) <= partition.end:
                valor = rec.get("valor")
                yield (partition.name, partition.code, rec["data"],
                       None if valor is None else str(valor))


class SeriesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SeriesReader:
        return SeriesReader(self.options)


def register(spark: SparkSession) -> None:
    """Register the data source with the session.

    The reader classes are shipped to the Python workers by value, so the
    workers do not need this package installed or on their path.
    """
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SeriesDataSource)


def extraction_window(run_date: dt.date, days: int = WINDOW_DAYS) -> tuple[dt.date, dt.date]:
    """``[run_date - days, run_date]``: the sliding window loaded every run."""
    return run_date - dt.timedelta(days=days), run_date


def read_series(spark: SparkSession, series: dict[str, int], start: dt.date, end: dt.date,
                url: str, slice_days: int | None = None, timeout: float = 30) -> DataFrame:
    """All ``series`` between ``start`` and ``end`` as raw text rows.

    A location without a scheme is one of Spark's default file system.
    """
    register(spark)
    if not urllib.parse.urlparse(url).scheme:
        fixed = url.split("{")[0].rpartition("/")[0]
        url = qualified_path(spark, fixed) + url[len(fixed):]
    spec = ",".join(f"{n}:{c}" for n, c in series.items())
    return (spark.read.format(SOURCE_NAME).option("series", spec)
            .option("start", start.isoformat()).option("end", end.isoformat())
            .option("url", url).option("slice_days", str(slice_days or ""))
            .option("timeout", str(timeout)).load())


def ingest_series(spark: SparkSession, series: dict[str, int], run_date: dt.date, url: str,
                  bronze_path: str, loaded_at: str, permissive: bool = False) -> LoadResult:
    """Truncate-load the window of every series into one bronze table.

    One read fetches all (series, slice) partitions in parallel; the table
    is partitioned by ``serie`` and replaced as a whole, also when the API
    returns nothing (the window is the table's whole content).
    """
    start, end = extraction_window(run_date)
    rows = normalise_series_rows(read_series(spark, series, start, end, url), permissive)
    stamped = rows.withColumns({
        "_loaded_at": F.lit(loaded_at),
        "_source": F.concat(F.lit("series_"), F.col("codigo").cast("string"))})
    # Declared bronze schema (plus the series name the table is partitioned by).
    bronze = stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                              for f in SERIES_BRONZE.fields], "serie")
    return write_truncate(bronze, bronze_path, partition_by=["serie"])
