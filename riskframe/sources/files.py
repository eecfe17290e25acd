"""CSV sources: discovery, header, text scan, typed scan, head and row positions."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskframe.contract import CSV_BOOLEANS, READER_MISSING, TYPING_ROWS
from riskframe.functions import strip
from riskframe.sources.scratch import materialize

ORDINAL = "row_ordinal"
_REAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_INFINITE = r"(?i)^[+-]?inf(inity)?\z"
_LINE = "__line"
_INTEGER = r"^[+-]?[0-9]+\z"
#: Kinds of cells as bits, and how many columns' kinds one 64-bit number holds.
_BOOLEAN, _WHOLE, _REAL_NUMBER, _TEXT, _PER_NUMBER = 1, 2, 4, 8, 15


def discover_csv(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, path, bytes)`` of the CSV files directly in a folder, by name.

    The binary-file source lists files without opening them as long as ``content`` is not
    asked for, so this costs a listing whatever the files hold.
    """
    try:
        listed = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        )
    except AnalysisException as error:
        raise FileNotFoundError(f"no such folder: {folder}") from error
    files = listed.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        F.col("length").alias("bytes"),
    )
    first = files.select("path").first()
    if first is None:
        if _is_file(spark, folder):
            raise NotADirectoryError(f"not a folder: {folder}")
        raise FileNotFoundError(f"no CSV files in {folder}")
    if _location(first.path) == _location(folder):
        raise NotADirectoryError(f"not a folder: {folder}")
    return files.orderBy("file_name")


def _is_file(spark: SparkSession, path: str) -> bool:
    listed = spark.read.format("binaryFile").load(path).select("path").first()
    return listed is not None and _location(listed.path) == _location(path)


def _location(path: str) -> str:
    scheme, colon, rest = path.partition(":/")
    return "/" + (rest if colon else path).strip("/")


def csv_columns(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names of a CSV file, stripped; an empty or unreadable header is an error."""
    names = _raw_header(spark, path)
    return [name.strip() for name in names]


def _raw_header(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    try:
        names = spark.read.csv(_paths(path), header=True, quote='"', escape='"').columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source not found: {path}") from error
        raise ValueError(f"cannot read the header of {path}: {error}") from error
    if not names:
        raise ValueError(f"cannot read the header of {path}: the file is empty")
    return names


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def read_text_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    multiline: bool = False,
    with_ordinal: bool = False,
    surplus: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every column as text, so leading zeros survive; reader-level missing cells are null.

    A folder of part files with one header is one source. Each file's header is checked
    against the first, so reordered columns are an error and never read under a wrong name.
    ``multiline`` allows line breaks inside quotes but makes files unsplittable.
    ``with_ordinal`` adds ``row_ordinal``, a struct that orders rows by file and position.
    A row with more cells than the header is an error when it is read; with ``surplus`` its line is
    given in a column of that name instead, null for other rows. Missing cells are null.
    """
    names = _raw_header(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _LINE]])
    # Cells are counted in whole rows only, so the parser must not skip columns.
    raw = spark.read.option("columnPruning", False).csv(
        _paths(path), schema=schema, header=True, quote='"', escape='"',
        nullValue="", emptyValue="", enforceSchema=False, multiLine=multiline,
        columnNameOfCorruptRecord=_LINE,
    )
    over = _surplus(len(names))
    wanted = [n for n in names if columns is None or n.strip() in columns]
    cells = [
        F.when(~F.col(_quoted(n)).isin(*READER_MISSING), F.col(_quoted(n))).alias(n.strip())
        for n in wanted
    ]
    if surplus is not None:
        cells.append(over.alias(surplus))
    elif wanted:
        error = F.raise_error(F.concat(F.lit("more cells than the header: "), over)).cast("string")
        cells[0] = F.when(over.isNotNull(), error).otherwise(cells[0]).alias(wanted[0].strip())
    if with_ordinal:
        cells.append(file_ordinal().alias(ORDINAL))
    return raw.select(*cells)


#: Bytes of a file that are read at a time, and at most, in search of its first line.
_CHUNK, _LONGEST = 1 << 16, 1 << 22


def _opened(path: str):
    """A byte stream of a file by the stores that Arrow reads."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":/")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/") if colon else path)
    store, name = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:/{rest}")
    return store.open_input_stream(name)


def first_line(path: str) -> str | None:
    """The first line of a file that is not blank, null without one; reads little more than that."""
    held = b""
    with _opened(path) as stream:
        while len(held) < _LONGEST:
            chunk = stream.read(_CHUNK)
            held += chunk
            lines = held.split(b"\n")
            for line in lines if not chunk else lines[:-1]:
                if line.strip():
                    return line.rstrip(b"\r").decode("utf-8")
            if not chunk:
                return None
    raise ValueError("the first line is too long")


def first_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_name, path, bytes, line, error)`` of each CSV file directly in a folder: its first line that is
    not blank, null without one, or why it cannot be read.

    Each file's first bytes are read, by tasks of a group of files each. In a store that only
    Spark's own readers reach, the lines come from a text scan instead.
    """
    files = discover_csv(spark, folder)
    sample = files.select("path").first().path
    try:
        _opened(sample).close()
    except Exception:  # noqa: BLE001 - whatever Arrow says of a store it does not know
        text = spark.read.option("pathGlobFilter", "*.csv").text(folder)
        lines = text.select(
            F.col("_metadata.file_name").alias("file_name"), "value",
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"),
        )
        lines = lines.filter((F.col("block") == 0) & (F.trim("value") != ""))
        first = lines.groupBy("file_name").agg(F.min_by("value", "row").alias("line"))
        return files.join(first, "file_name", "left").withColumn("error", F.lit(None).cast("string"))

    def read(batches):
        import pyarrow as pa

        for b in batches:
            lines, errors = [], []
            for path in b.column(1).to_pylist():
                line = error = None
                try:
                    line = first_line(path)
                except Exception as failure:  # noqa: BLE001 - it is reported with the file
                    error = f"{type(failure).__name__}: {(str(failure).splitlines() or [''])[0]}"
                lines.append(line)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lines, pa.string()), pa.array(errors, pa.string())], names=[*b.schema.names, "line", "error"])

    return files.mapInArrow(read, "file_name string, path string, bytes long, line string, error string")


def unreadable_files(files: DataFrame) -> dict[str, str]:
    """Errors, by name, of the files ``(file_name, path)`` that cannot be read to their end.

    Each file is opened by itself, so a failure is one file's and ends no job.
    """

    def read(batches):
        import pyarrow as pa

        for b in batches:
            found = []
            for name, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    with _opened(path) as stream:
                        while stream.read(1 << 20):
                            pass
                except Exception as failure:  # noqa: BLE001 - it is reported with the file
                    found.append((name, f"{type(failure).__name__}: {(str(failure).splitlines() or [''])[0]}"))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names=["file_name", "error"])

    rows = files.mapInArrow(read, "file_name string, error string")
    return {r.file_name: r.error for r in rows.collect()}


def header_names(line: str) -> list[str]:
    """The names in a header line, stripped."""
    return [name.strip() for name in next(csv.reader([line]))]


def read_folder_csv(spark: SparkSession, folder: str, layouts: DataFrame, names: Sequence[str], width: int, only: Column) -> DataFrame:
    """Text scan of those CSV files of a folder that ``only``, a test of ``_metadata``, picks, whatever their headers.

    Lines become cells once, by position; ``layouts`` says per ``__file`` at which position each of
    ``names`` stands (``__at``, null where the file lacks it) and how many names its header has
    (``__width``, at most ``width``). Files are picked when they are listed; rows of files without a
    layout are left out. Adds the origin of each row: ``__file``, ``__block``, ``__row``, and
    ``__surplus``, the line of a row with too many cells.
    """
    # One more than any header has, so that every row with as many cells as its header keeps its line.
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*(f"c{i}" for i in range(width + 1)), _LINE]])
    raw = spark.read.option("columnPruning", False).option("pathGlobFilter", "*.csv").csv(
        folder, schema=schema, header=True, quote='"', escape='"', nullValue="", emptyValue="",
        columnNameOfCorruptRecord=_LINE,
    ).filter(only)
    cells = F.array(*[F.col(f"c{i}") for i in range(width + 1)])
    raw = raw.select(
        cells.alias("__cells"),
        # A row without its line has one cell more than the widest header.
        F.col(_LINE).isNull().alias("__full"),
        F.coalesce(_LINE, F.concat_ws(",", *[F.coalesce(f"c{i}", F.lit("")) for i in range(width + 1)])).alias(_LINE),
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    ).join(layouts, "__file")
    # Only a filled cell beyond the header, or an empty one at the end, can make a row too long.
    beyond = F.get("__cells", F.col("__width")).isNotNull() | F.col(_LINE).endswith(",")
    commas = F.regexp_count(F.regexp_replace(_LINE, '"[^"]*"', ""), F.lit(","))
    cell = lambda j: F.get("__cells", F.get("__at", F.lit(j)))
    return raw.select(
        *[F.when(~cell(j).isin(*READER_MISSING), cell(j)).alias(n) for j, n in enumerate(names)],
        "__file", "__block", "__row",
        F.when(F.col("__full") | (beyond & (commas >= F.col("__width"))), F.col(_LINE)).alias("__surplus"),
    )


def _surplus(width: int) -> Column:
    # The line is there for rows with too few or too many cells; commas outside quotes tell which.
    commas = F.regexp_count(F.regexp_replace(_LINE, '"[^"]*"', ""), F.lit(","))
    return F.when(commas >= width, F.col(_LINE))


def file_ordinal() -> Column:
    """Position of a row read from files: file, block within it, row within the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _kind(cell: Column) -> Column:
    """What a cell reads as, one of four bits: boolean, whole number, other number, text. Missing cells have none."""
    text = strip(cell)
    whole = text.rlike(_INTEGER) & text.try_cast("bigint").isNotNull()
    return (
        F.when(text.isNull(), 0)
        .when(text.isin(*CSV_BOOLEANS), _BOOLEAN)
        .when(whole, _WHOLE)
        .when(text.rlike(_REAL) | text.rlike(_INFINITE), _REAL_NUMBER)
        .otherwise(_TEXT)
        .cast("bigint")
    )


def _kinds(columns: Sequence[str]) -> list[Column]:
    """Aggregates that hold the kinds each column has: four bits a column, so many columns a number.

    An or of bits is the same in any order and when a task counts twice.
    """
    sums = []
    for at in range(0, len(columns), _PER_NUMBER):
        group = columns[at : at + _PER_NUMBER]
        bits = [F.shiftleft(_kind(F.col(_quoted(name))), 4 * i) for i, name in enumerate(group)]
        sums.append(F.bit_or(reduce(lambda x, y: x.bitwiseOR(y), bits)).alias(f"kinds{at}"))
    return sums


def _types_of(columns: Sequence[str], seen: dict[str, int | None]) -> dict[str, T.DataType]:
    types: dict[str, T.DataType] = {}
    for i, name in enumerate(columns):
        group = i - i % _PER_NUMBER
        kinds = ((seen.get(f"kinds{group}") or 0) >> (4 * (i - group))) & 15
        if kinds == _BOOLEAN:
            types[name] = T.BooleanType()
        elif kinds == _WHOLE:
            types[name] = T.LongType()
        elif kinds & ~(_WHOLE | _REAL_NUMBER) == 0:
            types[name] = T.DoubleType()
        else:
            types[name] = T.StringType()
    return types


def infer_types(df: DataFrame) -> dict[str, T.DataType]:
    """Type of every text column, decided over all rows in one aggregate.

    Whole numbers that fit 64 bits are long, other numbers double, true/false words
    boolean, the rest text. A column without any value is double.
    """
    seen = df.agg(*_kinds(df.columns)).first().asDict() if df.columns else {}
    return _types_of(df.columns, seen)


def typed_table(text: DataFrame) -> DataFrame:
    """The text columns with their types, as a written table: cells are parsed once.

    The first rows give a guess by which cells are stored, each with its text where the guess does
    not give that back. The kinds of all cells are gathered while the table is written, and they
    alone decide the types: a column that was guessed wrong is made again from what is stored.
    """
    names = text.columns
    guess = infer_types(text.sparkSession.createDataFrame(text.take(TYPING_ROWS), text.schema))
    stored = []
    for i, name in enumerate(names):
        cell, value = F.col(_quoted(name)), _typed(name, guess[name])
        stored.append(value.alias(f"v{i}"))
        if not isinstance(guess[name], T.StringType):
            stored.append(F.when(~value.cast("string").eqNullSafe(cell), cell).alias(f"t{i}"))
    seen = Observation()
    table = materialize(text.observe(seen, *_kinds(names)).select(*stored), "typed")
    types = _types_of(names, seen.get)
    final = []
    for i, name in enumerate(names):
        value, kept = F.col(f"v{i}"), f"t{i}"
        if types[name] != guess[name]:
            value = _cast(F.coalesce(kept, value.cast("string")) if kept in table.columns else value, types[name])
        final.append(value.alias(name))
    return table.select(*final)


def apply_types(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Cast text columns to the given types; columns not named stay as they are."""
    return df.select(*[_typed(name, types.get(name)).alias(name) for name in df.columns])


def _typed(name: str, dtype: T.DataType | None) -> Column:
    return _cast(F.col(_quoted(name)), dtype)


def _cast(cell: Column, dtype: T.DataType | None) -> Column:
    if dtype is None or isinstance(dtype, T.StringType):
        return cell
    text = strip(cell)
    if isinstance(dtype, T.DoubleType):
        endless = F.regexp_replace(F.lower(text), "inf(inity)?", "Infinity")
        text = F.when(text.rlike(_INFINITE), endless).otherwise(text)
    return text.try_cast(dtype)


def read_typed_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    types: dict[str, T.DataType] | None = None,
    multiline: bool = False,
    materialize_types: bool = False,
) -> DataFrame:
    """Typed scan with an optional column subset; an unknown column is an error.

    Types are inferred over the chosen columns unless given: by a pass of its own before the lazy
    scan, or with ``materialize_types`` while the typed columns are written, in one pass in all.
    """
    text = read_text_csv(spark, path, multiline, columns=columns)
    if columns is not None:
        unknown = [c for c in columns if c not in text.columns]
        if unknown:
            raise ValueError(f"no such column(s) in {path}: {', '.join(unknown)}")
        text = text.select(*[_quoted(c) for c in columns])
    if types is None and materialize_types and text.columns:
        return typed_table(text)
    return apply_types(text, infer_types(text) if types is None else types)


def row_count(df: DataFrame) -> DataFrame:
    """Number of logical rows as ``(n)``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def head(df: DataFrame, n: int = TYPING_ROWS, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows in the given order: a top-n per task, then one merge of n rows each.

    Without an order Spark has none to keep, so the caller states one; a text scan offers
    ``row_ordinal``.
    """
    if not order_by:
        raise ValueError("head needs order_by: a frame has no row order of its own")
    return df.orderBy(*order_by).limit(n)


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "index") -> DataFrame:
    """Add a contiguous 0-based position in the given (total) order, without a global window.

    Rows are range-partitioned and written once; each range's size then gives the offset of
    the next. The offsets are one row per range, so that join is a bounded broadcast.
    """
    ranged = materialize(
        df.repartitionByRange(*order_by).withColumn("__range", F.spark_partition_id()),
        "ranged",
    )
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__range")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order_by))
    return (
        ranged.withColumn("__inside", inside)
        .join(F.broadcast(offsets), "__range")
        .withColumn(name, F.col("__offset") + F.col("__inside") - 1)
        .drop("__range", "__inside", "__offset")
    )
