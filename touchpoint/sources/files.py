"""File sources: folders of JSON, JSON Lines, CSV, exports and raw text.

All readers are lazy. A Spark file scan passes over files of zero length and files whose name starts
with ``.`` or ``_``; ``unread_files`` lists them as rejects, so that no file goes missing unnoticed.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, VariantType

from touchpoint.functions.text import strip
from touchpoint.operators.joins import lookup_join
from touchpoint.operators.keys import running_total
from touchpoint.operators.validate import REASON, Checked, flag_first, split_checked, with_reason
from touchpoint.paths import folder_files, is_folder, open_input
from touchpoint.schemas import SPEAKER_STORAGE, struct_type

CORRUPT = "_corrupt_record"
#: Column with the position of a row: struct of file, start of its block and place in the scan; a later row is larger.
POSITION = "_at"
#: Column with the text of a refused row.
REFUSED = "_refused"
LINE_ENDS = "\\r\\n|\\r|\\n"
TRAILING = "trailing characters after the document"
BLANK_LINE = "blank line"
MANY_DOCUMENTS = "more than one JSON document in a file; read it as JSON Lines"


def require_folder(spark: SparkSession, folder: str) -> str:
    if not is_folder(spark, folder):
        raise FileNotFoundError(f"no folder at {folder}")
    return folder


def _glob(suffixes: list[str] | None) -> dict[str, str]:
    return {"pathGlobFilter": "*{" + ",".join(suffixes) + "}"} if suffixes else {}


def list_folder(spark: SparkSession, folder: str, suffixes: list[str] | None = None) -> DataFrame:
    """Files of a folder, not of its subfolders: path, name and length. File contents are not read."""
    reader = spark.read.format("binaryFile").options(recursiveFileLookup="false", **_glob(suffixes))
    files = reader.load(require_folder(spark, folder)).select("path", F.substring_index("path", "/", -1).alias("name"), "length")
    passed = spark.createDataFrame(_passed_over(spark, folder, suffixes), files.schema)
    return files.where(F.col("length") > 0).union(passed)


def _passed_over(spark: SparkSession, folder: str, suffixes: list[str] | None) -> list[tuple[str, str, int]]:
    """Path, name and length of the files of a folder that a scan does not read; markers of Spark's writers are no data."""
    return [
        (path, name, length)
        for path, name, length in folder_files(spark, folder)
        if (length == 0 or name.startswith(("_", "."))) and name != "_SUCCESS" and (not suffixes or name.endswith(tuple(suffixes)))
    ]


def unread_files(spark: SparkSession, folder: str, suffixes: list[str] | None = None) -> DataFrame:
    """Rejects for the files of a folder that a scan passes over: (row_key, reject_reason); the key is the file name."""
    rows = [
        (name, "empty file" if length == 0 else "file names that start with _ or . are not read")
        for _, name, length in _passed_over(spark, require_folder(spark, folder), suffixes)
    ]
    return spark.createDataFrame(rows, f"row_key string, {REASON} string")


def file_origin(field: str) -> Column:
    """``file_path`` or ``file_name`` of a row's file, as it is on disk: Spark reports it URL-encoded."""
    return F.url_decode(F.replace(F.col(f"_metadata.{field}"), F.lit("+"), F.lit("%2B")))


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def position(field: str = "file_name") -> Column:
    """Position of a row of a scan. Rows of a block are read in order by one task, so later rows have larger positions."""
    return F.struct(
        file_origin(field).alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place")
    ).alias(POSITION)


def row_numbers(df: DataFrame, every: DataFrame, name: str) -> DataFrame:
    """Add the 1-based number of a row in its file to rows with a position.

    ``every`` has the positions of all rows of the same scan. It is reduced to one row per block before anything moves;
    the numbers follow from the counts of the blocks before, so no row is sorted. Two scans of the same
    files under the same settings are packed alike, so ``every`` may be another scan that reads no content.
    """
    blocks = every.groupBy(F.col(f"{POSITION}.file").alias("_file_of"), F.col(f"{POSITION}.block").alias("_block_of")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(f"{POSITION}.place").alias("_first")
    )
    before = Window.partitionBy("_file_of").orderBy("_block_of").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    shifts = blocks.select(F.struct(F.col("_file_of").alias("file"), F.col("_block_of").alias("block")).alias("_block"), shift)
    keyed = df.withColumn("_block", F.struct(f"{POSITION}.file", f"{POSITION}.block"))
    return keyed.join(shifts, "_block", "left").withColumn(name, F.col(f"{POSITION}.place") + F.col("_shift")).drop("_block", "_shift")


def positioned_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their position: (_at, line)."""
    return spark.read.text(path).select(position("file_path"), F.col("value").alias("line"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their 1-based number in the file: (path, line_no, line).

    A file of any size is read in parallel, and its lines are neither shuffled nor sorted.
    """
    numbered = row_numbers(positioned_lines(spark, path), positioned_lines(spark, path).select(POSITION), "line_no")
    return numbered.select(F.col(f"{POSITION}.file").alias("path"), "line_no", "line")


def read_csv_columns(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with declared column types."""
    return spark.read.schema(schema).options(header="true", enforceSchema="false").csv(path)


def read_csv_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV in which any malformed line fails the job."""
    return spark.read.schema(schema).options(header="true", mode="FAILFAST", enforceSchema="false").csv(path)


def _headers(files: DataFrame) -> DataFrame:
    """Column names of every file, read by the tasks from its first line: (_file, _names)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_file": frame["name"], "_names": [_column_names(p) for p in frame["path"]]})

    return files.select("path", "name").mapInPandas(run, "_file string, _names array<string>")


def _column_names(path: str) -> list[str]:
    """The first record of a file, which may hold quoted line breaks; no more than it is read."""
    with open_input(path) as stream:
        return next(csv.reader(io.TextIOWrapper(io.BufferedReader(stream), "utf-8-sig", newline="")), [])


def read_csv_folder(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """The good rows of ``read_csv_rows``."""
    return read_csv_rows(spark, folder, multi_line).valid


def read_csv_rows(spark: SparkSession, folder: str, multi_line: bool = True) -> Checked:
    """``flag_csv_rows`` split into good rows and rejects with the file as their key and the number of the row in the file."""
    flagged = flag_csv_rows(spark, folder, multi_line)

    def rejects() -> DataFrame:
        refused = flagged.where(F.col(REASON).isNotNull())
        return row_numbers(refused, flagged.select(POSITION), "row_no").withColumn("row_key", F.col("_file"))

    return Checked(lambda: flagged.where(F.col(REASON).isNull()).drop(REASON), rejects)


def flag_csv_rows(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """All rows of all CSV files of a folder by column name, with ``_file`` (name of the file), position and reject reason.

    A row with more cells than its file's header has columns is refused; missing cells at the end are null.

    One read of files with different headers would take one file's header and map the others by
    position. So the files are read by position, in one scan, and each row is then laid out by the
    header of its own file. Only column names reach the driver. Turn ``multi_line`` off for files
    without line breaks inside quotes, so that large files are split.
    """
    headers = _headers(list_folder(spark, folder, [".csv"]).where("length > 0 AND NOT startswith(name, '_') AND NOT startswith(name, '.')"))
    summary = headers.agg(F.max(F.size("_names")).alias("width"), F.count(F.lit(1)).alias("n_files")).first()
    if not summary["n_files"]:
        raise ValueError(f"no CSV files in {folder}")
    columns = [
        row["name"]
        for row in headers.select("_file", F.posexplode("_names").alias("place", "name"))
        .groupBy("name")
        .agg(F.min(F.struct("_file", "place")).alias("first"))
        .orderBy("first")
        .select("name")
        .collect()
    ]
    values = [f"_c{i}" for i in range(summary["width"])]
    rows = (
        spark.read.schema(", ".join(f"{v} string" for v in [*values, CORRUPT]))
        .options(header="true", multiLine=str(multi_line).lower(), escape='"', pathGlobFilter="*.csv", columnNameOfCorruptRecord=CORRUPT)
        .csv(folder)
        .select(F.array(*values).alias("_values"), _record_cells(F.col(CORRUPT), values).alias("_n_cells"), file_origin("file_name").alias("_file"), position())
    )
    laid_out = lookup_join(rows, headers, "_file")

    def named(name: str) -> Column:
        place = F.array_position("_names", name).cast("int")
        return F.when(place > 0, F.get("_values", place - 1)).alias(name)

    return flag_extra_cells(laid_out, F.col("_n_cells"), F.size("_names")).select(*[named(name) for name in columns], "_file", POSITION, REASON)


def flag_extra_cells(df: DataFrame, cells: Column, width: Column) -> DataFrame:
    ragged = F.concat(cells.cast("string"), F.lit(" cells under "), width.cast("string"), F.lit(" columns"))
    return flag_first(df, F.when(cells > width, ragged))


def _record_cells(record: Column, values: list[str]) -> Column:
    """Cells of a row: the parser hands over the text of a row that has not exactly as many of them as ``values``.

    The values are named although they decide nothing, because Spark refuses to read the text of bad rows alone.
    """
    return F.when(record.isNull() | (F.length(F.concat_ws("", *values)) < 0), len(values)).otherwise(csv_cells(record))


def _commas(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))


def csv_cells(record: Column) -> Column:
    """Number of cells of a CSV record, in time linear in its length.

    The pieces between quotes are walked once. A quote opens a cell at the start of the record, after a comma, and right
    behind a closing one (a doubled quote inside a cell); any other quote outside of a quoted cell is a character of it.
    """
    pieces = F.split(record, '"', -1)
    first = F.element_at(pieces, 1)
    start = F.struct(F.lit(False).alias("inside"), ((first == "") | first.endswith(",")).alias("opens"), _commas(first).alias("n"))

    def step(state: Column, piece: Column) -> Column:
        opened = ~state["inside"] & state["opens"]
        opens = F.when(state["inside"], (piece == "") | piece.endswith(",")).otherwise(piece.endswith(","))
        return F.struct(opened.alias("inside"), opens.alias("opens"), (state["n"] + F.when(opened, 0).otherwise(_commas(piece))).alias("n"))

    walked = F.aggregate(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), start, step, lambda state: state["n"])
    return F.when(record.contains('"'), walked).otherwise(_commas(record)) + 1


def attach_sidecars(rows: DataFrame, spark: SparkSession, folder: str) -> Checked:
    """``flag_sidecars`` split into good rows and rejects with the file as their key."""
    flagged = split_checked(flag_sidecars(rows, spark, folder))
    return flagged.then(lambda valid: valid, lambda rejects: rejects.withColumn("row_key", F.col("_file")))


def flag_sidecars(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add ``event_url`` from the JSON file with the same stem as each row's CSV file.

    Rows of a file whose sidecar is missing, malformed, or has no url are refused.
    """
    sidecars = (
        spark.read.schema(f"event_url string, {CORRUPT} string")
        .options(multiLine="true", mode="PERMISSIVE", pathGlobFilter="*.json")
        .json(require_folder(spark, folder))
        .select(
            file_stem(file_origin("file_name")).alias("_stem"),
            F.col("event_url").alias("_url"),
            F.col(CORRUPT).isNotNull().alias("_malformed"),
        )
    )
    stemmed = rows.drop("event_url").withColumn("_stem", file_stem(F.col("_file")))
    joined = lookup_join(stemmed, sidecars, "_stem")
    reason = (
        F.when(F.col("_malformed").isNull(), "required metadata file not found")
        .when(F.col("_malformed"), "malformed metadata file")
        .when(F.coalesce("_url", F.lit("")) == "", "event_url missing or empty in metadata file")
    )
    return flag_first(joined, reason).withColumnRenamed("_url", "event_url").drop("_stem", "_malformed")


def _with_corrupt(schema: str) -> StructType:
    return StructType(struct_type(schema).fields + [StructField(CORRUPT, StringType(), True)])


def parse_json(
    df: DataFrame, value: str, schema: str, required: tuple[str, ...] = (), trailing: str = TRAILING, raw: tuple[str, ...] = ()
) -> Checked:
    """``flag_json`` split into documents, and refused texts with the reason."""
    kept = [c for c in df.columns if c != value]
    fields = [f.name for f in struct_type(schema).fields]
    flagged = flag_json(df, value, schema, required, trailing, raw)
    return Checked(
        lambda: flagged.where(F.col(REASON).isNull()).select(*kept, *fields),
        lambda: flagged.where(F.col(REASON).isNotNull()).select(*kept, F.col(REFUSED).alias(value), REASON),
    )


def flag_json(
    df: DataFrame, value: str, schema: str, required: tuple[str, ...] = (), trailing: str = TRAILING, raw: tuple[str, ...] = ()
) -> DataFrame:
    """Parse a JSON text column against a schema; other columns are kept, the text of a refused row as ``_refused``.

    Refused: empty text, text that does not parse, more text after the document (which the parser
    alone would pass over), a required field that is absent, a string field with a value of another type
    (which the parser would turn into text), unless the field is in ``raw`` and takes any JSON as text.
    """
    kept = [c for c in df.columns if c not in (value, REASON)]
    given = struct_type(schema)
    strings = [f.name for f in given.fields if isinstance(f.dataType, StringType) and f.name not in raw]
    # String fields are read as variants, which know what they held; the list around the document shows whether it is alone.
    loose = StructType([StructField(f.name, VariantType() if f.name in strings else f.dataType) for f in given.fields])
    wrapped = StructType([StructField("documents", ArrayType(loose)), StructField(CORRUPT, StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    text = F.from_json(F.concat(F.lit('{"documents":['), value, F.lit("\n]}")), wrapped, options)
    # A generator is parsed once: filters on what it makes stay above it, where a projection's would repeat the parse.
    listed = df.select("*", F.explode(F.array(text)).alias("_parsed"))
    documents = F.col("_parsed.documents")
    parsed = listed.withColumn("_doc", F.get(documents, F.lit(0)))
    filled = F.coalesce(strip(F.col(value)), F.lit("")) != ""
    fits = F.coalesce(F.col(f"_parsed.{CORRUPT}").isNull() & (F.size(documents) == 1) & F.col("_doc").isNotNull(), F.lit(False))
    # Only a refused text is parsed again, to tell a document with more text behind it from what is none.
    again = F.from_json(value, _with_corrupt(schema), options)
    single = F.size(F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>")) == 1
    goes_on = F.when(fits | ~filled, False).otherwise(F.coalesce(again.isNotNull() & again[CORRUPT].isNull() & ~F.coalesce(single, F.lit(False)), F.lit(False)))
    rules = [
        (filled, "empty document"),
        (fits | ~filled | goes_on, "not a document of this schema"),
        (~goes_on, trailing),
        *[(_is_there(name, name in strings) | ~fits, f"missing {name}") for name in required],
        *[(F.coalesce(F.schema_of_variant(F.col(f"_doc.{name}")), F.lit("VOID")).isin("STRING", "VOID") | ~fits, f"{name} is not a string") for name in strings],
    ]
    fields = [_text_field(f.name) if f.name in strings else F.col(f"_doc.{f.name}").alias(f.name) for f in given.fields]
    return with_reason(parsed, rules).select(*kept, *fields, F.when(F.col(REASON).isNotNull(), F.col(value)).alias(REFUSED), REASON)


def _is_there(name: str, is_variant: bool) -> Column:
    field = F.col(f"_doc.{name}")
    return field.isNotNull() & ~F.is_variant_null(field) if is_variant else field.isNotNull()


def _text_field(name: str) -> Column:
    return F.try_variant_get(F.col(f"_doc.{name}"), "$", "string").alias(name)


def read_json_docs(
    spark: SparkSession, folder: str, schema: str, suffixes: list[str], required: tuple[str, ...] = ()
) -> Checked:
    """One JSON document per file, with ``_file`` (path).

    A file that holds several documents is a reject with a hint.
    """
    return parse_json(_whole_files(spark, folder, suffixes).drop(POSITION), "value", schema, required, MANY_DOCUMENTS)


def flag_json_docs(
    spark: SparkSession, folder: str, schema: str, suffixes: list[str], required: tuple[str, ...] = ()
) -> DataFrame:
    """The documents of ``read_json_docs``, flagged, with their position."""
    return flag_json(_whole_files(spark, folder, suffixes), "value", schema, required, MANY_DOCUMENTS)


def _whole_files(spark: SparkSession, folder: str, suffixes: list[str]) -> DataFrame:
    files = spark.read.options(**_glob(suffixes)).text(require_folder(spark, folder), wholetext=True)
    return files.select(file_origin("file_path").alias("_file"), position("file_path"), "value")


def flag_json_lines(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """One JSON document per line, flagged, with the position of the line; the reason of a blank line is ``BLANK_LINE``."""
    lines = positioned_lines(spark, path).withColumn(REASON, F.when(strip(F.col("line")) == "", BLANK_LINE))
    return flag_json(lines, "line", schema, required)


def read_json_lines(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = ()) -> Checked:
    """One JSON document per line; blank lines are skipped; rejects carry path and line number.

    Only the rejects pay for numbering the lines: the counts of the blocks are joined to them.
    """
    def filled() -> DataFrame:
        return positioned_lines(spark, path).where(strip(F.col("line")) != "")

    def rejects() -> DataFrame:
        refused = parse_json(filled(), "line", schema, required).rejects
        numbered = row_numbers(refused, positioned_lines(spark, path).select(POSITION), "line_no")
        return numbered.select(F.col(f"{POSITION}.file").alias("path"), "line_no", "line", REASON)

    return Checked(lambda: parse_json(filled(), "line", schema, required).valid.drop(POSITION), rejects)


def read_speakers(spark: SparkSession, path: str) -> DataFrame:
    """Speakers of the dimension file, a document with one list: (idx, name, email, aliases).

    ``idx`` is the place in the list, which decides between equal names. A document that is
    malformed or not of this shape fails the job.
    """
    document = spark.read.schema(SPEAKER_STORAGE).options(multiLine="true", mode="FAILFAST").json(path)
    listed = document.select(F.posexplode("speakers_internal").alias("idx", "speaker"))
    return listed.select("idx", "speaker.*").withColumn(
        "aliases", F.coalesce("aliases", F.array().cast("array<string>"))
    )


def require_suffix(path: str, suffix: str) -> str:
    if not path.lower().endswith(suffix):
        raise ValueError(f"not a {suffix} file: {path}")
    return path


def read_compact_text(spark: SparkSession, folder: str, suffixes: list[str] | None = None) -> DataFrame:
    """Every file as one string, lines stripped and joined; nothing is parsed."""
    files = spark.read.options(**_glob(suffixes)).text(require_folder(spark, folder), wholetext=True)
    compact = F.array_join(F.transform(F.split("value", LINE_ENDS), strip), "")
    return files.select(file_origin("file_path").alias("_file"), compact.alias("payload"))


def read_csv_slice(spark: SparkSession, path: str, skip_rows: int = 0, n_rows: int | None = None) -> Checked:
    """CSV file with ``skip_rows`` physical lines before its header, and at most ``n_rows`` rows.

    Both are counted per file when the path holds several. All columns are strings; blank lines
    are no rows; ``line_no`` is kept so that the order of the file can be restored. A row with more cells than the header
    is a reject with its path and line number; it counts as one of the ``n_rows``.
    """
    lines = numbered_lines(spark, path)
    header = lines.where(F.col("line_no") == skip_rows + 1).select("line").first()
    if header is None:
        raise ValueError(f"no header after {skip_rows} lines in {path}")
    names = [name.strip() for name in next(csv.reader([header["line"]]))]
    schema = ", ".join(f"`{name}` string" for name in names)
    rows = lines.where((F.col("line_no") > skip_rows + 1) & (F.col("line") != ""))
    if n_rows is not None:
        counted = running_total(rows, ["path"], ["line_no"], F.lit(1), "row_no")
        rows = counted.where(F.col("row_no") <= n_rows)
    flagged = flag_extra_cells(rows, csv_cells(F.col("line")), F.lit(len(names)))
    refused = F.col(REASON).isNotNull()
    return Checked(
        lambda: flagged.where(~refused).select("line_no", F.from_csv("line", F.lit(schema), {"escape": '"'}).alias("row")).select("line_no", "row.*"),
        lambda: flagged.where(refused).select(F.concat("path", F.lit(":"), F.col("line_no").cast("string")).alias("row_key"), "path", "line_no", "line", REASON),
    )


def read_exports(spark: SparkSession, folder: str) -> DataFrame:
    """Text exports, one file per call: (path, value), line ends made equal."""
    files = spark.read.text(require_folder(spark, folder), wholetext=True, pathGlobFilter="*.srt")
    return files.select(file_origin("file_path").alias("path"), F.regexp_replace("value", LINE_ENDS, "\n").alias("value"))
