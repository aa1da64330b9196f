"""A source that is read page by page until an empty one.

Page ``n`` lies in ``<root>/page=<n>`` as JSON lines; the folder stands in for an
API that answers one request per page. Partition ``i`` of ``p`` asks for the pages
``i, i + p, i + 2p, ...`` and stops at its first empty or missing one, so no reader
has to know how many pages there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


# Workers get the classes below with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Stride(InputPartition):
    def __init__(self, first: int, step: int):
        self.first, self.step = first, step


class PagedReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema = schema
        self.root = options["path"]
        self.base_page = int(options.get("basePage", 1))
        self.readers = int(options.get("readers", 8))

    def partitions(self):
        return [_Stride(self.base_page + i, self.readers) for i in range(self.readers)]

    def read(self, partition: _Stride) -> Iterator:
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        page, found = partition.first, True
        while found:
            found = False
            for block in self._blocks(page, wanted):
                found = found or block.num_rows > 0
                yield block
            page += partition.step

    def _blocks(self, number: int, wanted) -> Iterator:
        """The rows of one page, a block of its text at a time; nothing when there is no such page."""
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.json as pajson

        uri = f"{self.root}/page={number}"
        store, folder = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        if store.get_file_info(folder).type == pafs.FileType.NotFound:
            return
        parts = [f for f in store.get_file_info(pafs.FileSelector(folder))
                 if f.is_file and f.size and f.base_name.endswith(".json")]
        for part in parts:
            with store.open_input_stream(part.path) as lines:
                options = pajson.ParseOptions(explicit_schema=wanted)
                for block in pajson.open_json(lines, parse_options=options):
                    table = pa.Table.from_batches([block]).select(wanted.names).cast(wanted)
                    yield from table.to_batches()


class PagedSource(DataSource):
    """``spark.read.format("pages").schema(...).load(root)``."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self):
        raise ValueError("declare the schema of the pages")

    def reader(self, schema) -> PagedReader:
        return PagedReader(schema, self.options)
