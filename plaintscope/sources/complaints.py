"""Raw complaint extracts: delimited scan, null tokens, extraction grid, chunk union.

A1/A2: one job takes the header record of every file, then the files of one header are scanned
together with an all-text schema (no inference pass); the CSV reader handles quoted multi-line
narratives, and runs one task per file. Typed parsing happens in ``operators.clean`` so bad text becomes NULL instead of
failing the scan.
"""

from __future__ import annotations

from collections import deque
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NULL_TOKENS
from ..schema import RAW_HEADER, raw_schema


CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession):
    return (spark.read.option("header", True).option("multiLine", True)
            .option("escape", '"').option("mode", "PERMISSIVE"))


ORDER = ("_file", "_block", "_pos")

# One file to a partition, whatever its size: a split as large as any file, opened at that cost.
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60),
                "spark.sql.files.minPartitionNum": "1", "spark.sql.files.maxPartitionNum": str((1 << 31) - 1)}


def header_records(spark: SparkSession, path) -> list[tuple[str, str]]:
    """(file, text of its first record) of every file with a record, found in one job.

    A task opens one file and stops soon after the header's last line (a quoted name may hold line
    breaks), so little behind it is read. Blank lines before the header are passed over, as the
    CSV reader does. The settings for that live in a session of their own; the caller's stay as they
    are. Where a session refuses them, the result is the same: only a file's first split counts,
    tasks read their files to the end, and a header that a split cuts off stands for its file alone."""
    probe = spark.newSession()
    for key, value in {**_WHOLE_FILES, "spark.sql.execution.arrow.maxRecordsPerBatch": "500"}.items():
        probe.conf.set(key, value)
    one_file_each = all(probe.conf.get(key) == value for key, value in _WHOLE_FILES.items())

    def row(name, record, closed):
        text = "\n".join(record)
        return pa.RecordBatch.from_pydict({"file": [name], "header": [text if closed else f"{text}\0{name}"]})

    def first(batches):
        at, record, done = None, [], False
        for batch in batches:
            for name, block, line in zip(*(c.to_pylist() for c in batch.columns)):
                if name != at:
                    if record and not done:
                        yield row(at, record, False)
                    at, record, done = name, [], False
                if done or block != 0 or (not record and not line.strip()):
                    continue
                record.append(line)
                if sum(x.count('"') for x in record) % 2 == 0:
                    yield row(name, record, True)
                    done = True
            if done and one_file_each:
                deque(islice(batches, 10), maxlen=0)  # a worker that ends its input is used again
                return
        if record and not done:  # a quote that never closes
            yield row(at, record, False)

    lines = probe.read.text(path).select("_metadata.file_path", "_metadata.file_block_start", "value")
    found = lines.mapInArrow(first, "file string, header string").collect()
    jvm = spark.sparkContext._jvm  # the metadata column names files as URIs
    return [(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["file"])).toString(), r["header"]) for r in found]


def read_complaints(spark: SparkSession, path, header=RAW_HEADER, keep_corrupt: bool = False,
                    keep_order: bool = False) -> DataFrame:
    """A1: header CSV with quoted fields and embedded newlines, every column text.

    Columns are found by name: each file's own header is read (``header_records``), files of one header are
    scanned together, and the wanted columns are projected in the order of ``header``
    (compared without case and outer blanks). Other columns are dropped; a file that lacks
    a wanted column is an error. ``keep_corrupt`` adds the text of records with too few or
    too many fields as ``_corrupt_record`` (NULL for sound ones). ``keep_order`` adds the input order
    for keep-last as ``ORDER``: file path (chunk files are named in extraction order), split offset,
    place in the split; it is taken per header, before the scans are united. A quoted newline may stand
    anywhere, so one file is one task: convert large extracts to Parquet once.
    """
    by_text: dict[str, list[str]] = {}
    for f, text in sorted(header_records(spark, path)):
        by_text.setdefault(text, []).append(f)
    groups: dict[tuple[str, ...], list[str]] = {}
    for files in by_text.values():  # one small read per distinct header, not per file
        names = tuple(_csv(spark).csv(files[0]).columns)
        groups.setdefault(names, []).extend(files)
    if not groups:
        none = spark.createDataFrame([], raw_schema(tuple(header) + ((CORRUPT,) if keep_corrupt else ())))
        return none.select("*", *_place(F.lit(""), F.lit(0))) if keep_order else none
    parts = []
    for names, paths in groups.items():
        at = {n.strip().lower(): i for i, n in reversed(list(enumerate(names)))}
        missing = [h for h in header if h.strip().lower() not in at]
        if missing:
            raise ValueError(f"{paths[0]}: no column {', '.join(missing)}")
        own = [f"c{i}" for i in range(len(names))]
        df = _csv(spark).schema(raw_schema((*own, CORRUPT))).option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
        cols = [F.col(own[at[h.strip().lower()]]).alias(h) for h in header]
        place = _place(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")) if keep_order else []
        parts.append(df.select(*cols, *([CORRUPT] if keep_corrupt else []), *place))
    return reduce(DataFrame.unionByName, parts)


def _place(file, block) -> list:
    return [file.alias("_file"), block.cast("long").alias("_block"), F.monotonically_increasing_id().alias("_pos")]


def normalize_nulls(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """A3: every string field equal to a null token becomes NULL."""
    toks = [F.lit(t) for t in tokens]
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(*toks), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def union_chunks(*dfs: DataFrame) -> DataFrame:
    """A5: union of extracts whose column order (or set) differs."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def extract_grid(products: DataFrame, start, end, days: int = 7) -> DataFrame:
    """A4: per product, inclusive `days`-day chunks from start to end, the last one clipped.

    ``products`` is a one-column DataFrame of product names; ``start``/``end`` are
    date columns or literals (scalar subqueries work). No cross join: each product
    row generates its own chunk list.
    """
    start_c = F.lit(start).cast("date") if isinstance(start, str) else start
    end_c = F.lit(end).cast("date") if isinstance(end, str) else end
    n_chunks = F.floor(F.datediff(end_c, start_c) / days).cast("int")
    return (products
            .select("product", F.explode(F.sequence(F.lit(0), n_chunks)).alias("chunk_no"))
            .withColumn("chunk_start", F.date_add(start_c, F.col("chunk_no") * days))
            .withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), end_c)))


def chunk_coverage(complaints: DataFrame, products: DataFrame, start, end,
                   days: int = 7) -> DataFrame:
    """A4 audit: rows received per (product, chunk), empty chunks kept with 0.

    Membership is an equi-join on the chunk number computed per row, so no range
    join is needed; the per-chunk counts are aggregated before the join.
    """
    start_c = F.lit(start).cast("date") if isinstance(start, str) else start
    end_c = F.lit(end).cast("date") if isinstance(end, str) else end
    day = F.to_date("date_received")
    counts = (complaints
              .where(day.between(start_c, end_c))
              .groupBy("product",
                       F.floor(F.datediff(day, start_c) / days).cast("int").alias("chunk_no"))
              .agg(F.count(F.lit(1)).alias("records")))
    grid = extract_grid(products, start_c, end_c, days)
    return (grid.join(counts, ["product", "chunk_no"], "left")
            .select("product", "chunk_no", "chunk_start", "chunk_end",
                    F.coalesce("records", F.lit(0)).cast("bigint").alias("records")))
