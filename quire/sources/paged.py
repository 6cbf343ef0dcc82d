"""A partitioned reader of paged text (S1, S2): long files whose pages end at
a separator (form feed), read by byte ranges.

The driver asks for the names and sizes of the files only, and packs their
ranges into tasks of about equal bytes, so that many short files are few tasks.
Each task opens its files at the starts of its ranges and streams blocks; a
page belongs to the range that its first byte is in, so a file of any length is
read by many tasks, each page once, and no task holds more than a block and a
page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.session import materialize

#: Bytes of a task's ranges and of one read; what opening a file counts for.
SPLIT, BLOCK, OPEN = 64 << 20, 1 << 20, 64 << 10


@dataclass
class FileRanges(InputPartition):
    """(path, start, end) of each range of a task."""
    ranges: list


class PagedText(DataSource):
    """``paged_text``: rows of (file, range, n, start, text): the range's first
    byte, the page's number in the range (from 1) and its first byte. Options: ``path`` (a file
    or a folder, read with its subfolders, names with a leading ``_`` or ``.``
    left out), ``split`` (bytes of a range), ``separator``."""

    @classmethod
    def name(cls):
        return "paged_text"

    def schema(self):
        return "file string, range bigint, n bigint, start bigint, text string"

    def reader(self, schema):
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("split", SPLIT))
        self.separator = options.get("separator", "\f").encode()
        if self.split < 1 or not self.separator:
            raise ValueError("split and separator must not be empty")
        if any(self.separator[:n] == self.separator[-n:] for n in range(1, len(self.separator))):
            # "---" would be cut at its first or second byte, by where a range starts.
            raise ValueError("a separator must not overlap itself")

    def partitions(self):
        from pyarrow import fs
        filesystem, root = fs.FileSystem.from_uri(self.path)
        top = filesystem.get_file_info(root)
        files = [top] if top.type == fs.FileType.File else filesystem.get_file_info(
            fs.FileSelector(root, recursive=True))
        shown = [f for f in files if f.type == fs.FileType.File and not any(
            p[:1] in ("_", ".") for p in f.path[len(root):].split("/"))]
        ranges = [(f.path, at, min(at + self.split, f.size))
                  for f in sorted(shown, key=lambda f: f.path) for at in range(0, f.size, self.split)]
        return [FileRanges(x) for x in packed(ranges, self.split)] or [FileRanges([])]

    def read(self, partition):
        from pyarrow import fs
        filesystem, _ = fs.FileSystem.from_uri(self.path)
        for path, start, end in partition.ranges:
            with filesystem.open_input_file(path) as f:
                for n, (at, page) in enumerate(pages_of_range(f, start, end, self.separator), 1):
                    yield path, start, n, at, page.decode("utf-8", "replace")


def packed(ranges: list, split: int) -> list:
    """Ranges in order, as lists of at most ``split`` bytes, or of one range."""
    lists, size = [], 0
    for r in ranges:
        cost = r[2] - r[1] + min(OPEN, split)
        if not lists or size + cost > split + min(OPEN, split):
            lists.append([])
            size = 0
        lists[-1].append(r)
        size += cost
    return lists


def pages_of_range(f, start: int, end: int, separator: bytes, block: int = BLOCK):
    """(first byte, bytes) of the pages that begin in ``[start, end)``. A page
    begins at 0 and after each separator; the file's last page needs none after
    it, and a file that ends in one has an empty last page, which begins at its
    end and is not read, as it is in no range."""
    # A separator that ends at ``start`` makes a page begin there.
    at = max(start - len(separator), 0)
    f.seek(at)
    buffer, from_ = b"", at      # ``from_``: place of the buffer's first byte
    inside = start == 0          # the buffer begins a page of this range
    while True:
        cut = buffer.find(separator)
        if cut >= 0:
            if inside:
                yield from_, buffer[:cut]
            from_, buffer = from_ + cut + len(separator), buffer[cut + len(separator):]
            inside = True
            if from_ >= end:
                return
            continue
        if not inside:
            # Nothing of this range yet: keep what may be half a separator.
            keep = len(separator) - 1
            drop = max(len(buffer) - keep, 0)
            from_, buffer = from_ + drop, buffer[drop:]
            if from_ >= end:
                return
        # Blocks grow with an unfinished page, so a long page is not searched
        # from its start for every block.
        more = f.read(max(block, len(buffer)))
        if not more:
            if inside and buffer:
                yield from_, buffer
            return
        buffer += more


def read_pages(spark: SparkSession, path: str, split: int = SPLIT, separator: str = "\f") -> DataFrame:
    """(file, page_no, start, text): all pages of the files under ``path``,
    numbered from 1 in each file. Pages are counted by range, and a range's
    pages go on from the sum before it: the files are read twice, and the texts
    are neither sorted nor shuffled (a row for each range is).

    Empty pages count and are returned (S1's readers skip them); bytes that are
    no UTF-8 become the replacement mark; an empty file has no page; an empty
    folder gives no rows."""
    spark.dataSource.register(PagedText)
    pages = spark.read.format("paged_text").option("split", split).option("separator", separator).load(path)
    counts = pages.groupBy("file", "range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range that has pages; written, so that its size is known.
    counts = materialize(counts.select("file", "range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return pages.join(counts, ["file", "range"]).select("file", (F.col("_off") + F.col("n")).alias("page_no"), "start", "text")
