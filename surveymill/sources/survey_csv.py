"""Scan of survey editions: CSV files with a header row, all cells as text.

Spark's own reader parses the files, with records that may span lines (``multiLine``): a file is one task's work, and
parallel work comes from many files, or from landing an edition as Parquet (see ``landing``). Columns are
addressed by position, because headers hold quotes, dots, parentheses and duplicates.

Any number of files and editions takes the same few jobs. One finds the header row of every file: the first line that is
not blank, by Spark's reader of lines, which is far cheaper than parsing and cuts files into splits. Only files whose header
is more than that line are parsed for it. The header rows are a small table, and
the records are scanned, once, as it says: the widest header, and whether blank lines come before one.

Records end at line feeds; a carriage return before one is not kept, nor one that ends a record's last cell. Blank
lines, of nothing but blanks and tabs, are no records. Files of one edition whose headers differ are an error. A
record of more cells than the header is rejected: an error where rows are asked for, a row of the
reject table where that is. Spark keeps the text of records that do not have as many cells as the schema; it has as many
commas more than the cells that are seen as there are cells but one. How many cells a rejected record has is where a mark
added to its text is found.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.functions.text import literal, null_tokens
from surveymill.sources.lake import SMALL_ROWS, is_small, small, stage, work_folder

_FILES = {"pathGlobFilter": "*.csv", "recursiveFileLookup": True}
_PARSE = {"multiLine": True, "escape": '"', "maxCharsPerColumn": -1, "lineSep": "\n"}
_RAW, _N, _MARK = "_raw", "_n", "\x02end of record\x03"
#: A cell that starts with a closed quoted part: its content, and the text that follows.
_QUOTED = r'\A"([^"]*+(?:""[^"]*+)*+)"(?s:(.*))\z'
#: The next cell of a record, after a comma.
_NEXT_CELL = r',("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'
_COUNTED = 8  # cells beyond the schema that are still counted
_YEAR = r"/survey_year=(\d+)/"
HEADS = "file string, blank long, header array<string>, closed boolean"


@dataclass(frozen=True)
class Edition:
    """Header names by position, and the raw rows with columns ``c0`` ... as text."""

    headers: list[str]
    rows: DataFrame


@dataclass(frozen=True)
class Editions:
    """Any number of editions: their headers ``(survey_year, pos, header)``, and rows ``(survey_year, c0, c1 ...)``, as wide as
    the widest edition.

    ``rejects`` holds ``(survey_year, file, record, reason)`` of the records that are not rows; ``rows`` fails on them
    unless the scan was told that they are looked after.
    """

    catalog: DataFrame
    rows: DataFrame
    rejects: DataFrame | None = None


def csv_files(spark: SparkSession, path) -> DataFrame:
    """``(path, length, modified, file)`` of the CSV files at or below a path; contents are not read. ``file`` is the path as
    scans name it."""
    listed = spark.read.format("binaryFile").options(**_FILES).load(path)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("file"))


def unique_names(header_row: list[str | None]) -> list[str]:
    """Header texts with blanks named by position and repeats numbered ``x``, ``x.1``, ``x.2``."""
    names = [text or f"Unnamed: {pos}" for pos, text in enumerate(header_row)]
    taken, seen = set(names), {}
    for pos, text in enumerate(names):
        repeats = seen.get(text, 0)
        seen[text] = repeats + 1
        if not repeats:
            continue
        while f"{text}.{repeats}" in taken:
            repeats += 1
        names[pos] = f"{text}.{repeats}"
        taken.add(names[pos])
        seen[text] = repeats + 1
    return names


def clean(rows: DataFrame) -> DataFrame:
    """All cells with null tokens turned into nulls."""
    return rows.selectExpr(*[f"{null_tokens(c)} AS {c}" for c in rows.columns])


# --- first records -------------------------------------------------------------------------------


def _columns(width: int) -> list[str]:
    return [f"c{pos}" for pos in range(width)]


def _scan(spark: SparkSession, paths, width: int, header: bool) -> DataFrame:
    """Records with the first ``width`` cells, the text of those with another number of cells, file and number."""
    schema = ", ".join(f"{c} string" for c in (*_columns(width), _RAW))
    read = spark.read.options(**_FILES, **_PARSE, header=header, columnNameOfCorruptRecord=_RAW).schema(schema).csv(paths)
    return read.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("number"))


def _is_blank() -> Column:
    """Spark reads no text without a cell, so the first one is asked as well."""
    return F.coalesce((F.btrim(F.coalesce("c0", F.lit("")), F.lit(" \t\r")) == "") & F.col(_RAW).rlike(r"\A[ \t]*\z"), F.lit(False))


def _header_cells(text: str) -> tuple[list[str], bool]:
    """The cells of a header row, and whether its last quote is closed."""
    csv.field_size_limit(sys.maxsize)
    try:
        return next(csv.reader(io.StringIO(text, newline=""), strict=True)), True
    except csv.Error:
        return [], False


def _one_line(text: str | None) -> tuple[list[str] | None, bool | None]:
    """The cells of a header that is no more than this line; nothing if it may be."""
    if text is None:
        return None, None
    cells, closed = _header_cells(text)
    if not closed or not "".join(cells).strip(" \t\r"):
        return None, None
    return cells, True


def first_records(spark: SparkSession, paths) -> DataFrame:
    """``(file, blank, header, closed)`` of every file with a record: whether lines of blanks come before its first one, and
    that one.

    A written table, a row for each file. Line numbers are compared within one plan only, in which both scans cut the
    files alike.
    """
    folder = work_folder(spark)
    lines = spark.read.options(**_FILES, lineSep="\n").text(paths)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("number"))
    first = lines.filter("block = 0")
    shown = F.expr("IF(ascii(value) > 32, true, btrim(value, ' \t\r') <> '')")  # most lines need no look at all of them
    numbers = first.groupBy("file").agg(F.min(F.when(F.col("value") != "", F.col("number"))).alias("begin"), F.min(F.when(shown, F.col("number"))).alias("head"))
    listed = csv_files(spark, paths).filter("length > 0").select("file")
    numbers = numbers.filter("head IS NOT NULL").select("begin", "head")
    if is_small(listed):  # a row for each file, as many as ``numbers``
        numbers = F.broadcast(numbers)
    heads = first.join(numbers, F.col("number") == F.col("head"))
    picked = heads.select("file", (F.col("head") - F.col("begin")).alias("blank"), F.expr("IF(is_valid_utf8(value), value, NULL)").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _heads(batch, [_one_line(text) for text in batch.column(2).to_pylist()])

    found = stage(picked.mapInArrow(run, HEADS), f"{folder}/first-lines").filter("closed")
    others = [unquote(row["file"]) for row in listed.join(found, "file", "left_anti").collect()]  # files with longer headers
    return found.unionByName(_parsed_first_records(spark, others, f"{folder}/first-records")) if others else found


def _heads(batch: pa.RecordBatch, cells: list[tuple]) -> pa.RecordBatch:
    header = pa.array([c for c, _ in cells], pa.list_(pa.field("element", pa.string())))
    closed = pa.array([ok for _, ok in cells], pa.bool_())
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), header, closed], ["file", "blank", "header", "closed"])


def _parsed_first_records(spark: SparkSession, paths, folder: str) -> DataFrame:
    """:func:`first_records` of files whose first record may span lines: a minimum of record numbers for each file, joined back
    to the same scan."""
    scanned = _scan(spark, paths, 1, header=False)  # so the text is there of all records but those of one cell
    blank = F.col(_RAW).isNull() & (F.btrim(F.coalesce("c0", F.lit("")), F.lit(" \t\r")) == "")
    numbers = scanned.groupBy("file").agg(F.min("number").alias("begin"), F.min(F.when(~blank, F.col("number"))).alias("head"))
    numbers = numbers.filter("head IS NOT NULL").withColumnRenamed("file", "of")
    if len(paths) <= SMALL_ROWS:
        numbers = F.broadcast(numbers)
    heads = scanned.join(numbers, (F.col("file") == F.col("of")) & (F.col("number") == F.col("head")))
    picked = heads.select("file", (F.col("head") - F.col("begin")).alias("blank"), _RAW, "c0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, firsts = (batch.column(i).to_pylist() for i in (2, 3))
            yield _heads(batch, [([(first or "").removesuffix("\r")], True) if text is None else _header_cells(text) for text, first in zip(texts, firsts, strict=True)])

    return stage(picked.mapInArrow(run, HEADS), folder)


def _checked(heads: DataFrame, by: Column) -> DataFrame:
    """``(edition, header)``, one row for each edition; an error if a header is not closed or files differ in it."""
    broken = heads.filter("NOT closed").first()
    if broken is not None:
        raise ValueError(f"the header of {broken['file']} has a quoted cell that is never closed")
    headers = heads.groupBy(by.alias("edition"), "header").agg(F.min("file").alias("file"))
    mixed = headers.groupBy("edition").agg(F.count("*").alias("n"), F.min("file").alias("a"), F.max("file").alias("b")).filter("n > 1").first()
    if mixed is not None:
        raise ValueError(f"files with different headers: {mixed['a']}, {mixed['b']}")
    return headers.select("edition", "header")


# --- records -------------------------------------------------------------------------------------


def _records(spark: SparkSession, paths, width: int, heads: DataFrame, close_quotes: bool = False) -> DataFrame:
    """``(cells..., _raw, _n, file)`` of all records but blank ones and headers, without the carriage return of a line end.
    ``_n`` is the number of cells; of more than ``width``, some number over it. To ``close_quotes``, the text is wanted of all
    records that are rows: ``width`` must be more than any header's."""
    columns = _columns(width)
    count = f"IF({_RAW} IS NULL, {width}, {_commas(_RAW)} - {_commas('concat_ws(' + ', '.join([literal(''), *columns]) + ')')} + 1)"
    found = _data_records(spark, paths, width, heads).selectExpr(*columns, _RAW, f"{count} AS {_N}", "file")
    cut = [f"IF({_N} = {n} AND endswith({c}, '\r'), left({c}, length({c}) - 1), {c}) AS {c}" for n, c in enumerate(columns, 1)]
    records = found.selectExpr(*cut, _RAW, _N, "file")
    return _close_quotes(records, width) if close_quotes else records


def _close_quotes(records: DataFrame, width: int) -> DataFrame:
    """Records whose text is kept, with the quotes taken off cells that have text after the closing one (``"x"s`` is ``xs``).

    Spark leaves such a cell as it is but for doubled quotes, so the content is taken from the text of the record. Only
    records with a cell that begins with a quote are looked at.
    """
    columns = _columns(width)
    listed, mark = ", ".join(columns), "\x02"
    found = f"regexp_extract_all(concat(',', {_RAW}), {literal(_NEXT_CELL)}, 1)"
    head, tail = (f"regexp_extract(get(texts, i), {literal(_QUOTED)}, {n})" for n in (1, 2))
    closed = f"IF(btrim({tail}, ' \t\r') = '', c, concat(replace({head}, '\"\"', '\"'), {tail}))"
    cells = f"transform(array({found}), texts -> transform(array({listed}), (c, i) -> IF(startswith(c, '\"'), {closed}, c)))[0]"
    some = f"contains(concat_ws({literal(mark)}, '', {listed}), {literal(mark + chr(34))})"
    looked = records.selectExpr("*", f"CASE WHEN {_RAW} IS NOT NULL AND {some} THEN {cells} END AS closed")
    return looked.selectExpr(*[f"IF(closed IS NULL, {c}, closed[{n}]) AS {c}" for n, c in enumerate(columns)], _RAW, _N, "file")


def _commas(text: str) -> str:
    return f"(length({text}) - length(replace({text}, ',', '')))"


def _data_records(spark: SparkSession, paths, width: int, heads: DataFrame) -> DataFrame:
    if not heads.agg(F.max("blank")).first()[0]:
        return _scan(spark, paths, width, header=True).filter(~_is_blank())
    scanned = _scan(spark, paths, width, header=False).filter(~_is_blank())
    numbers = scanned.groupBy("file").agg(F.min("number").alias("head")).withColumnRenamed("file", "of")
    if is_small(heads):  # a row for each file, as many as ``numbers``
        numbers = F.broadcast(numbers)
    return scanned.join(numbers, F.col("file") == F.col("of")).filter("number > head")


def _cell_count(width: int, most: int) -> str:
    """Cells of a record that is read as ``width`` columns: exact up to _COUNTED more than ``most``, then one beyond that."""
    schema = ", ".join(f"{c} string" for c in _columns(most + _COUNTED + 1))
    options = ", ".join(f"'{k}', '{str(v).lower()}'" for k, v in _PARSE.items() if k != "lineSep")
    ends = ", ".join(f"coalesce(endswith(s.{c}, '{_MARK}'), false)" for c in _columns(most + _COUNTED + 1))
    read = f"from_csv(concat({_RAW}, ',', '{_MARK}'), '{schema}', map({options}))"
    place = f"transform(array({read}), s -> array_position(array({ends}), true))[0]"
    return f"CASE WHEN {_RAW} IS NULL THEN {width} ELSE coalesce(nullif({place}, 0) - 1, {most + _COUNTED + 1}) END"


def _reason(width: int, most: int, header_width: str) -> str:
    return f"concat('a record has ', {_cell_count(width, most)}, ' cells, the header has ', {header_width})"


def _record(width: int) -> str:
    """The text of a record; of one that has as many cells as the schema, which Spark does not keep, an equal one."""
    as_is = "map('escape', '\"', 'ignoreLeadingWhiteSpace', 'false', 'ignoreTrailingWhiteSpace', 'false')"
    return f"coalesce({_RAW}, to_csv(struct({', '.join(_columns(width))}), {as_is}))"


def _fail_on_long(records: DataFrame, width: int, most: int, header_width: str) -> DataFrame:
    """The records, with an error for one that is too long. A filter, so that no choice of columns drops the test."""
    text = f"concat({_reason(width, most, header_width)}, ': ', left({_record(width)}, 200))"
    return records.filter(F.expr(f"IF({_N} > {header_width}, CAST(raise_error({text}) AS BOOLEAN), true)"))


def scan_edition(spark: SparkSession, path: str, close_quotes: bool = False) -> Edition:
    """All rows of one edition's CSV files, cells as raw text. ``close_quotes``: a cell in which text follows the closing
    quote loses its quotes, as in pandas; else it is left as Spark reads it, quotes and all."""
    heads = first_records(spark, path)
    headers = _checked(heads, F.lit(0)).first()
    if headers is None:
        raise ValueError(f"no header row below {path}")
    names = unique_names(headers["header"])
    width = max(2, len(names)) + close_quotes
    records = _records(spark, path, width, heads, close_quotes)
    return Edition(names, _fail_on_long(records, width, max(2, len(names)), str(len(names))).select(*_columns(len(names))))


def header_catalog(spark: SparkSession, headers: DataFrame) -> DataFrame:
    """``(survey_year, pos, header)`` of ``(edition, header)`` rows, repeats numbered; a written table."""
    named = "edition int, header array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [unique_names(row) for row in batch.column(1).to_pylist()]
            column = pa.array(names, pa.list_(pa.field("element", pa.string())))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["edition", "header"])

    found = headers.mapInArrow(run, named).select(F.col("edition").alias("survey_year"), F.posexplode("header").alias("pos", "header"))
    return stage(found, f"{work_folder(spark)}/headers")


def scan_editions(
    spark: SparkSession, paths: Mapping, files: DataFrame | None = None, years: int | None = None, rejects: bool = False, close_quotes: bool = True
) -> Editions:
    """All editions in one plan, the paths of their folders by year.

    The year of a file is that of the ``survey_year=YYYY`` folder it lies in; or what ``files`` ``(file, survey_year)`` says, a row for
    each file, for ``years`` years. ``close_quotes`` as in :func:`scan_edition`. ``rejects``: records that are too long are left out of ``rows`` and are the rows of ``rejects``.
    """

    def dated(frame: DataFrame) -> DataFrame:
        if files is None:
            return frame.withColumn("survey_year", F.regexp_extract("file", _YEAR, 1).cast("int"))
        return frame.join(small(files), "file")

    where = list(paths.values())
    heads = dated(first_records(spark, where))
    catalog = header_catalog(spark, _checked(heads, F.col("survey_year")))
    widths = catalog.groupBy("survey_year").agg(F.count("*").cast("int").alias("width"))
    n, most = widths.agg(F.count("*"), F.max("width")).first()
    if n < (len(paths) if years is None else years):
        found = {row["survey_year"] for row in widths.select("survey_year").collect()}
        raise ValueError(f"no header row below {next(path for year, path in paths.items() if year not in found)}")
    width = max(2, most) + close_quotes
    if is_small(heads):  # then what is known of a file comes in one join
        of_file = F.broadcast(heads.select("file", "survey_year").join(widths, "survey_year"))
        records = _records(spark, where, width, heads, close_quotes).join(of_file, "file")
    else:
        records = dated(_records(spark, where, width, heads, close_quotes)).join(small(widths), "survey_year")
    columns = ["survey_year", *_columns(most)]
    if not rejects:
        return Editions(catalog, _fail_on_long(records, width, max(2, most), "width").select(*columns))
    long = F.expr(f"{_N} > width")
    rejected = records.filter(long).selectExpr("survey_year", "file", f"{_record(width)} AS record", f"{_reason(width, max(2, most), 'width')} AS reason")
    return Editions(catalog, records.filter(~long).select(*columns), rejected)
