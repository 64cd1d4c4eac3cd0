"""Reading and writing of input tables, and their fingerprints."""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from risklens.operators.small import attach, is_pinned, pin

# Encodings tried in order.
ENCODINGS = ("utf-8", "gbk", "gb18030", "iso-8859-1")
STANDARD = ("utf-8", "iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32")
#: Encodings whose line breaks, commas and quotes aren't single bytes.
WIDE = ("utf-16", "utf-16be", "utf-16le", "utf-32")
_QUOTED_FIELD = re.compile(rb'(?:^|,)"')


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, path, block, seq): the bytes of all lines, by file and part of the file, in their order."""
    return spark.read.text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))


def _ends_open(line: bytes, open_: bool) -> bool:
    """Whether a quoted field is open at the end of a line, from whether one was at its beginning."""
    if b'"' not in line:
        return open_
    at = 0
    while True:
        if open_:
            at = line.find(b'"', at) + 1
            if not at:
                return True
            if line[at:at + 1] == b'"':  # a doubled quote is one character of the field
                at += 1
                continue
        # A quote opens a field only where the field begins.
        found = _QUOTED_FIELD.search(line, at) if at else _QUOTED_FIELD.match(line) or _QUOTED_FIELD.search(line)
        if not found:
            return False
        open_, at = True, found.end()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes]]]:
    """The lines of each part of a file, batch by batch; a part's batches follow one another."""
    for b in batches:
        paths, blocks, values = (b.column(i).to_pylist() for i in (1, 2, 0))
        at = 0
        for i in range(1, len(b) + 1):
            if i == len(b) or (paths[i], blocks[i]) != (paths[at], blocks[at]):
                yield (paths[at], blocks[at]), values[at:i]
                at = i


def _verdicts(spark: SparkSession, path: str) -> DataFrame:
    """Pinned row for each part of a file: which encodings decode it, and whether a quoted field is open at its end.

    ``after_0`` and ``after_1`` tell the latter for parts that begin outside and inside such a field, ``breaks`` whether
    a line that isn't inside one at the beginning of the part ends inside one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[bool]] = {}
        for key, lines in _blocks(batches):
            state = seen.setdefault(key, [True] * len(ENCODINGS) + [False, False, True])
            data = b"\n".join(lines)
            for i, encoding in enumerate(ENCODINGS):
                if state[i]:
                    try:
                        data.decode(encoding)
                    except UnicodeDecodeError:
                        state[i] = False
            if b'"' in data:
                for line in lines:
                    state[-2:] = _ends_open(line, state[-2]), _ends_open(line, state[-1])
                    state[-3] |= state[-2]
            else:
                state[-3] |= state[-2]
        if seen:
            yield pa.RecordBatch.from_pydict({"path": [k[0] for k in seen], "block": [k[1] for k in seen],
                                              **{f: [v[i] for v in seen.values()] for i, f in enumerate(flags)}})

    flags = [*[f"e{i}" for i in range(len(ENCODINGS))], "breaks", "after_0", "after_1"]
    schema = "path string, block bigint, " + ", ".join(f"{f} boolean" for f in flags)
    return pin(_lines(spark, path).select("value", "path", "block").mapInArrow(run, schema))


def _encoding(verdicts: DataFrame) -> str:
    flags = [f"e{i}" for i in range(len(ENCODINGS))]
    row = verdicts.agg(*[F.bool_and(f).alias(f) for f in flags]).first()
    return next(e for e, f in zip(ENCODINGS, flags) if row[f] is not False)


def detect_encoding(spark: SparkSession, path: str) -> str:
    """First encoding that decodes every line of every file; the last one decodes any bytes."""
    return _encoding(_verdicts(spark, path))


def _begin_states(verdicts: DataFrame) -> DataFrame:
    """(path, block, open): whether each part of a file begins inside a quoted field.

    A part either fixes the state after it, or keeps or turns the one before: so the state follows from the last
    part that fixes it and the number of turns since.
    """
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("after_0") & ~F.col("after_1")).cast("int")
    fixed = F.col("after_0") == F.col("after_1")
    rows = verdicts.withColumn("turns", F.sum(turns).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct(F.col("after_0").cast("int").alias("state"), "turns")), ignorenulls=True).over(before)
    so_far = F.coalesce(F.last("turns").over(before), F.lit(0))
    state = F.coalesce(last["state"], F.lit(0)) + so_far - F.coalesce(last["turns"], F.lit(0))
    return pin(rows.select("path", "block", (state % 2 == 1).alias("open")))


def _records(spark: SparkSession, path: str, encoding: str, verdicts: DataFrame) -> DataFrame:
    """(value, head): records as text, and whether they are the first of their file.

    Lines inside a quoted field are joined, across the parts of a file too.
    """
    states = _begin_states(verdicts)
    lines = attach(_lines(spark, path), states, ["path", "block"])
    if not is_pinned(states):  # the join has moved lines
        lines = lines.sortWithinPartitions("path", "block", "seq")
    names = ("value", "path", "block", "begins", "ends", "head")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, begins, open_, first = None, [], True, False, False
        out: list[tuple] = []

        def close(ends: bool) -> None:
            nonlocal held, first
            if any(map(bytes.strip, held)) or not (begins and ends):  # records of blanks only don't count
                out.append((b"\n".join(held), *key, begins, ends, first))
                first = False
            held = []

        for b in chain(batches, (None,)):
            for line, path, block, start in zip(*(b.column(i).to_pylist() for i in range(4))) if b is not None else ():
                if (path, block) != key:
                    if held:
                        close(not open_)
                    key, begins, open_, first = (path, block), not start, start, block == 0
                elif not open_:
                    close(True)
                    begins = True
                held.append(line)
                open_ = _ends_open(line, open_)
            if b is None and held:
                close(not open_)
            if out:
                kinds = (pa.binary(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], list(names))
                out = []

    schema = "value binary, path string, block bigint, begins boolean, ends boolean, head boolean"
    found = lines.select("value", "path", "block", "open").mapInArrow(run, schema)
    whole = found.where("begins AND ends").select("value", "head")
    if not attach(verdicts, states, ["path", "block"]).where("IF(open, after_1, after_0)").isEmpty():
        # At most two pieces of a part belong to records that go over its ends.
        order = Window.partitionBy("path").orderBy("block", "begins")
        pieces = found.where("NOT (begins AND ends)").withColumn("record", F.sum(F.col("begins").cast("int")).over(order))
        joined = pieces.groupBy("path", "record").agg(F.max("head").alias("head"), F.array_sort(F.collect_list(
            F.struct("block", "begins", "value"))).alias("p"))
        whole = whole.unionByName(joined.select(F.expr(
            "aggregate(slice(p, 2, size(p)), p[0].value, (a, x) -> a || X'0A' || x.value)").alias("value"), "head"))
    return _text(whole, encoding)


def _text(df: DataFrame, encoding: str) -> DataFrame:
    """Bytes as text; those that the encoding can't decode become replacement characters."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [x.decode(encoding, "replace") for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), b.column(1)], ["value", "head"])
    return df.mapInArrow(decode, "value string, head boolean")


def _header(records: DataFrame) -> list[str]:
    """Column names of the first file's first record; empty ones get their place, repeated ones too."""
    first = records.where("head").orderBy("value").first()
    names = next(csv.reader([first.value])) if first else []
    return [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(n.lstrip("\ufeff") for n in names)]


def read_csv(spark: SparkSession, path: str, *, keys: tuple[str, ...] = (),
             encoding: str | None = None, schema: StructType | str | None = None) -> DataFrame:
    """CSV with header; key columns always stay text, so leading zeros survive.

    One pass looks at all bytes: without ``encoding`` it finds the first that decodes them all; bytes that a given
    one can't decode become replacement characters. Quoted fields may hold line breaks (read as line feeds)
    and doubled quotes; such files are still read in parts.
    """
    reader = spark.read.options(header=True, escape='"')
    if encoding and encoding.lower() in WIDE:
        lines, reader = None, reader.options(encoding=encoding, multiLine=True)
    else:
        verdicts = _verdicts(spark, path)
        enc = encoding or _encoding(verdicts)
        # If no line ends inside a field when its part is taken to begin outside, all parts do begin outside.
        plain = enc.lower() in STANDARD and verdicts.where("breaks").isEmpty()
        lines = None if plain else _records(spark, path, enc, verdicts)
        reader = reader.option("encoding", enc) if lines is None else reader

    def read(given) -> DataFrame:
        if lines is None:
            return given.csv(path)
        # The reader takes a table of texts in the JVM, so no line goes through Python once more.
        texts = getattr(lines.where("NOT head").select("value")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        return DataFrame(given.option("header", False)._jreader.csv(texts), spark)

    names = None if lines is None else _header(lines)
    if schema is None:
        guessed = read(reader.option("inferSchema", True))
        names = names or guessed.columns
        types = [*[f.dataType for f in guessed.schema.fields], *[StringType()] * len(names)]
        schema = StructType([StructField(n, StringType() if n.lstrip("\ufeff") in keys else t) for n, t in zip(names, types)])
    out = read(reader.option("inferSchema", False).schema(schema))
    return out.toDF(*[c.lstrip("\ufeff") for c in out.columns])


def read_table(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Parquet, JSON or CSV by file ending."""
    if path.endswith((".csv", ".txt")):
        return read_csv(spark, path, **kw)
    if path.endswith((".json", ".jsonl")):
        return spark.read.json(path, multiLine=path.endswith(".json"))
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, paths: dict[str, str], required: tuple[str, ...] = (),
                **kw) -> dict[str, DataFrame]:
    """Named set of tables; missing optional ones are left out."""
    out = {}
    for name, path in paths.items():
        try:
            out[name] = read_table(spark, path, **kw)
        except Exception as err:  # the reader reports a missing path in several ways
            if name in required or "PATH_NOT_FOUND" not in str(err):
                raise
    return out


def write_prepared(df: DataFrame, path: str, key: str, partition_by: tuple[str, ...] = ()) -> None:
    """Prepared table as Parquet, key as text."""
    out = df.withColumn(key, F.col(key).cast("string"))
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_prepared(spark: SparkSession, path: str, key: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn(key, F.col(key).cast("string"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and order-free sum of row hashes: equal tables give equal rows.

    A row's hash is the first 60 bits of the MD5 of its values as text, in the order of their names,
    each with its length before it; null has the length -1.
    """
    values = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-1:"))
              for t in (F.col(f"`{c}`").cast("string") for c in sorted(df.columns))]
    number = F.conv(F.substring(F.md5(F.concat(*values)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(number).cast("string").alias("hash_sum"))


def load_dictionary(tables: DataFrame, fields: DataFrame) -> DataFrame:
    """Field list with the display name of its table (empty where the table is unknown)."""
    names = tables.groupBy("table_name").agg(F.min("table_title").alias("table_title"))
    return (fields.join(names, "table_name", "left")
            .withColumn("table_title", F.coalesce("table_title", F.lit(""))))


# Python workers needn't have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
