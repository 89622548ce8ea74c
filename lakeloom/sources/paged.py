"""Paged record sources as a Spark data source.

A fetcher is any picklable object with ``fetch(page, size, token)`` returning
``(records, total)`` and ``login()`` returning a token; it raises
``TokenExpired`` when the token is no longer good. Pages are dealt to
partitions as ranges, so they are fetched in parallel on the executors.
"""

from __future__ import annotations

import base64
import math
import pickle
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# Workers receive this module with the job and need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TokenExpired(Exception):
    """The server refused the token."""


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Session:
    """A token that is renewed once whenever it expires."""

    def __init__(self, fetcher):
        self.fetcher, self.token = fetcher, fetcher.login()

    def get(self, page: int, size: int):
        try:
            return self.fetcher.fetch(page, size, self.token)
        except TokenExpired:
            self.token = self.fetcher.login()
            return self.fetcher.fetch(page, size, self.token)


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, fetcher, size: int, parallel: int):
        self.names, self.fetcher, self.size, self.parallel = schema.names, fetcher, size, parallel

    def partitions(self):
        _, total = _Session(self.fetcher).get(1, 1)
        pages = math.ceil(total / self.size)
        step = max(1, math.ceil(pages / self.parallel))
        return [PageRange(p, min(p + step - 1, pages)) for p in range(1, pages + 1, step)]

    def read(self, partition: PageRange):
        session = _Session(self.fetcher)
        for number in range(partition.first, partition.last + 1):
            records, _ = session.get(number, self.size)
            for record in records:
                yield tuple(record.get(name) for name in self.names)


class PagedSource(DataSource):
    """``spark.read.format("paged")`` with options fetcher, page_size and parallel."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def reader(self, schema: StructType) -> DataSourceReader:
        fetcher = pickle.loads(base64.b64decode(self.options["fetcher"]))
        return PagedReader(schema, fetcher, int(self.options.get("page_size", 1000)),
                           int(self.options.get("parallel", 64)))


def read_pages(spark: SparkSession, fetcher, schema: StructType | str, page_size: int = 1000, parallel: int = 64) -> DataFrame:
    """All records of a paged source."""
    spark.dataSource.register(PagedSource)
    packed = base64.b64encode(cloudpickle.dumps(fetcher)).decode()
    return (spark.read.format("paged").schema(schema).option("fetcher", packed)
            .option("page_size", page_size).option("parallel", parallel).load())


def require_complete(df: DataFrame, total: int) -> int:
    """Fail unless as many rows arrived as the source declared (Q03)."""
    rows = df.count()
    if rows != total:
        raise ValueError(f"expected {total} records, received {rows}")
    return rows


class FilePages:
    """Pages kept as JSON-lines files ``<root>/page=<n>``, as a source without a server.

    ``expire_at`` makes the token expire once on that page.
    """

    def __init__(self, root: str, page_size: int, total: int, expire_at: int | None = None):
        self.root, self.page_size, self.total, self.expire_at = root, page_size, total, expire_at
        self.logins = 0

    def login(self) -> str:
        self.logins += 1
        return f"token-{self.logins}"

    def fetch(self, page: int, size: int, token: str):
        import json

        from pyarrow import fs

        if size != self.page_size:
            return [], self.total
        if page == self.expire_at and token == "token-1":
            raise TokenExpired(page)
        store, root = (fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:")
                       else (fs.LocalFileSystem(), self.root))
        records = []
        for info in store.get_file_info(fs.FileSelector(f"{root}/page={page}")):
            if info.is_file and info.base_name.endswith(".json"):
                with store.open_input_stream(info.path) as stream:
                    records += [json.loads(line) for line in stream.read().decode().splitlines() if line]
        return records, self.total
