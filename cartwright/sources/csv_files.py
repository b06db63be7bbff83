"""CSV input under the contract, CSV output of aggregates, and content fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import contract as c
from cartwright.functions.parsing import all_of, exprs, listed, literal, named, parsed
from cartwright.operators.validation import union_all
from cartwright.sources import folders

CORRUPT = "_corrupt_record"
# A SHA-256 in hex, and the digits that fit a signed 64-bit integer.
DIGEST_DIGITS, LIMB_DIGITS = 64, 15
# A limb's bits that are summed together: 64-bit sums hold 2^43 rows of them.
PIECE_BITS = 20


class ContractError(ValueError):
    """The input folder does not satisfy the six-table contract."""


def text_schema(headers: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in (*headers, CORRUPT)])


def _reader(source, headers: tuple[str, ...], has_header: bool, multi_line: bool = False):
    """``source`` is a session's ``read`` or ``readStream``."""
    # Without column pruning a row is judged malformed on its full width, whatever is selected.
    return (
        source.schema(text_schema(headers))
        .option("header", has_header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def scan_csv(spark: SparkSession, path: str, headers: tuple[str, ...], multi_line: bool = False) -> DataFrame:
    """Every column as text; a row of the wrong width keeps its text in the corrupt column.

    ``path`` is a file or a folder of part files.  A quote inside quotes is doubled.
    Records end at line ends, so large files are split over many tasks; ``multi_line``
    reads quoted line breaks, at the price of one task per file.
    """
    return _reader(spark.read, headers, True, multi_line).csv(path)


def stream_csv(spark: SparkSession, path: str, headers: tuple[str, ...], files_per_batch: int = 1000) -> DataFrame:
    """The files of a folder as they arrive, read like ``scan_csv`` reads them."""
    return _reader(spark.readStream, headers, True).option("maxFilesPerTrigger", files_per_batch).csv(path)


def with_lineage(rows: DataFrame, source_file: str, ingested_at: datetime) -> DataFrame:
    return rows.withColumns({"_source_file": F.lit(source_file), "_ingested_at": F.lit(ingested_at)})


def file_name(table: str) -> str:
    return f"{table}.csv"


def read_inputs(spark: SparkSession, folder: str, ingested_at: datetime, multi_line: bool = False) -> dict[str, DataFrame]:
    return {
        table: with_lineage(
            scan_csv(spark, f"{folder}/{file_name(table)}", headers, multi_line), file_name(table), ingested_at
        )
        for table, headers in c.HEADERS.items()
    }


def register_views(sources: dict[str, DataFrame]) -> list[str]:
    names = []
    for table, rows in sources.items():
        rows.createOrReplaceTempView(f"raw_{table}_raw")
        names.append(f"raw_{table}_raw")
    return names


# --- contract inspection ---------------------------------------------------------------------


def inspect_table(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """One row: header verdict, data rows, rows of the wrong width and bytes, in one pass.

    The header is the first record of each file; it is found by the smallest row id in
    the split that starts the file, so no file is read twice.
    """
    headers = c.HEADERS[table]
    fields = ", ".join(f"'h{i}', `{name}`" for i, name in enumerate(headers))
    rows = _reader(spark.read, headers, False, multi_line).csv(path).selectExpr(
        "_metadata.file_path AS file",
        "_metadata.file_size AS bytes",
        "CASE WHEN _metadata.file_block_start = 0 THEN monotonically_increasing_id() END AS position",
        f"CAST({CORRUPT} IS NOT NULL AS INT) AS malformed",
        f"named_struct({fields}, 'malformed', CAST({CORRUPT} IS NOT NULL AS INT)) AS record",
    )
    per_file = rows.groupBy("file").agg(
        *exprs(
            "count(1) AS lines", "sum(malformed) AS malformed_lines", "min_by(record, position) AS first", "max(bytes) AS bytes"
        )
    )
    # The first name may carry a byte-order mark.
    names = ["replace(first.h0, '\ufeff', '')", *[f"first.h{i}" for i in range(1, len(headers))]]
    header_ok = all_of("first.malformed = 0", *[f"{n} <=> {literal(h)}" for n, h in zip(names, headers, strict=True)])
    return per_file.agg(
        *exprs(
            f"{literal(table)} AS table_name",
            "count(1) AS files",
            f"coalesce(bool_and({header_ok}), false) AS header_ok",
            "coalesce(sum(lines - 1), 0) AS data_rows",
            "coalesce(sum(malformed_lines - first.malformed), 0) AS wrong_width_rows",
            "coalesce(sum(bytes), 0) AS bytes",
        )
    )


def check_files(spark: SparkSession, folder: str) -> None:
    """Refuse links and empty files before anything is read; the first fault in contract order is reported.

    A link may lead out of the delivered folder, and an empty part is a file whose writing broke off.
    Names that begin with a dot or underscore are not data.
    """
    for table in c.HEADERS:
        name = file_name(table)
        found = folders.entry(spark, f"{folder}/{name}")
        if found is None:
            raise ContractError(f"Required input is missing: {name}")
        if found.is_link:
            raise ContractError(f"{name} is a symbolic link")
        parts = [found]
        if found.is_folder:
            parts = [part for part in folders.entries(spark, f"{folder}/{name}") if not part.name.startswith((".", "_"))]
        for part in parts:
            shown = name if part is found else f"{name}/{part.name}"
            if part.is_link:
                raise ContractError(f"{shown} is a symbolic link")
            if not part.is_folder and part.size == 0:
                raise ContractError(f"{shown} is an empty file")
        if not parts:
            raise ContractError(f"{name} is empty")


def inspect_inputs(spark: SparkSession, folder: str, multi_line: bool = False) -> dict[str, dict]:
    """Check all six tables; the first violated table in contract order is reported."""
    frames = []
    for table in c.HEADERS:
        try:
            frames.append(inspect_table(spark, f"{folder}/{file_name(table)}", table, multi_line))
        except AnalysisException as exc:
            raise ContractError(f"Required input is missing: {file_name(table)}") from exc
    found = {row["table_name"]: row.asDict() for row in union_all(frames).collect()}
    for table in c.HEADERS:
        report = found[table]
        if report["files"] == 0:
            raise ContractError(f"{file_name(table)} is empty")
        if not report["header_ok"]:
            raise ContractError(f"{file_name(table)} does not have the {len(c.HEADERS[table])} contract headers")
        if report["wrong_width_rows"]:
            raise ContractError(f"{file_name(table)} has {report['wrong_width_rows']} rows of the wrong width")
        if report["data_rows"] == 0:
            raise ContractError(f"{file_name(table)} has no data rows")
    return found


# --- fingerprints ------------------------------------------------------------------------------


def fingerprint(rows: DataFrame, name: str, columns: Iterable[str]) -> DataFrame:
    """Row count and an order-free SHA-256 over the rows' own digests.

    Sums of digest limbs combine on the map side and do not depend on file layout or
    row order; a repeated row changes the sum.  The limbs cover all digits of a row's
    digest.  A field enters with its length, and NULL as a mark of its own, so no
    content looks like another's.
    """
    fields = ", ".join(
        f"CASE WHEN `{n}` IS NULL THEN 'n' ELSE concat('v', char_length(CAST(`{n}` AS STRING)), ':', CAST(`{n}` AS STRING)) END"
        for n in columns
    )

    starts = range(1, DIGEST_DIGITS + 1, LIMB_DIGITS)

    def piece(start: int, shift: int) -> str:
        return f"CAST(coalesce(sum(shiftright(l{start}, {shift}) & {(1 << PIECE_BITS) - 1}), 0) AS DECIMAL(38,0)) * {1 << shift}"

    # A limb is summed in pieces, as integers: adding decimals of so many digits row by row takes several times as long.
    limbs = ", ".join(" + ".join(piece(start, shift) for shift in range(0, 4 * LIMB_DIGITS, PIECE_BITS)) for start in starts)
    digests = rows.selectExpr(f"sha2(concat({fields}), 256) AS d")
    return digests.selectExpr(*[f"CAST(conv(substring(d, {start}, {LIMB_DIGITS}), 16, 10) AS BIGINT) AS l{start}" for start in starts]).agg(
        *exprs(
            f"{literal(name)} AS table_name",
            "count(1) AS row_count",
            f"sha2(concat_ws(':', {limbs}, count(1)), 256) AS content_sha256",
        )
    )


def fingerprints(sources: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([fingerprint(sources[t], t, list(headers)) for t, headers in c.HEADERS.items()])


def combine(digests: dict[str, str]) -> str:
    """The same combined digest from the six collected table digests."""
    text = "".join(f"{table}\n{digests[table]}\n" for table in c.HEADERS)
    return hashlib.sha256(text.encode()).hexdigest()


def combined_fingerprint(per_table: DataFrame) -> DataFrame:
    """One digest over (table, digest) in contract order."""
    entry = "concat(table_name, '\\n', content_sha256, '\\n')"
    order = f"array_position(array({listed(c.HEADERS)}), table_name)"
    parts = f"array_sort(collect_list(struct({order} AS o, {entry} AS e)))"
    return per_table.agg(
        *exprs("sum(row_count) AS row_count", f"sha2(array_join({parts}.e, ''), 256) AS combined_sha256")
    )


# --- aggregates out and in -----------------------------------------------------------------------


# Rows of an export that one task sorts and writes.
PART_ROWS = 1_000_000


def write_aggregate(rows: DataFrame, path: str, sort_keys: tuple[str, ...], row_count: int | None = None, part_rows: int = PART_ROWS) -> None:
    """An ordered CSV export with headers: one part up to ``part_rows`` rows, beyond it one per ``part_rows``.

    Parts hold ascending ranges of the sort keys (NULL first), so their name order is the order of all rows and no
    task sees more than its range.  Each has the header; ``export_lines`` reads them on as one file.  Rows with equal
    keys share a part.  ``row_count`` spares counting the rows.  Without rows there is one part with the header alone.
    CSV has no line for a NULL in a lone column; exports have more columns.
    """
    keys = [key for key in sort_keys if key in rows.columns]
    count = row_count if row_count is not None else rows.count()
    parts = max(1, -(-count // part_rows)) if keys else 1
    placed = rows.repartition(1) if parts == 1 else rows.repartitionByRange(parts, *keys)
    if keys:
        placed = placed.sortWithinPartitions(*keys)
    placed.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)


def export_lines(spark: SparkSession, path: str) -> Iterator[str]:
    """The physical lines of an ordered export as of one file: parts in order, the header once.

    Lines are read as they are asked for, so the driver holds a buffer, not the export.  A record with a line break
    inside quotes spans lines; headers of exports are column names without line breaks.
    """
    names = [entry.name for entry in folders.entries(spark, path) if entry.name.startswith("part-")]
    # Part numbers are padded to five digits and may have more.
    for position, name in enumerate(sorted(names, key=lambda name: (len(name), name))):
        lines = folders.text_lines(spark, f"{path}/{name}")
        header = next(lines, None)
        if position == 0 and header is not None:
            yield header
        yield from lines


def read_type(dtype: T.DataType) -> str | None:
    """How a published column is read back: numbers as DOUBLE, dates and times as TIMESTAMP, the rest as text."""
    if isinstance(dtype, T.NumericType):
        return "DOUBLE"
    return "TIMESTAMP" if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) else None


def read_aggregate(spark: SparkSession, path: str, like: T.StructType, part: str | None = None) -> DataFrame:
    """Read a published aggregate with the types of the layer it was made from; what does not parse becomes NULL.

    With ``part`` a column of that name says which file a row stands in; names ascend with the order of the rows.
    """
    types = {field.name.lower(): read_type(field.dataType) for field in like}
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    typed = {}
    for header in rows.columns:
        name, value = header.strip().lower(), f"`{header}`"
        typed[name] = parsed(value, types[name]) if types.get(name) else value
    if part:
        rows, typed[part] = rows.withColumn(part, F.col("_metadata.file_name")), f"`{part}`"
    return rows.selectExpr(*named(typed))


def read_aggregates(spark: SparkSession, folder: str, like: Mapping[str, T.StructType]) -> tuple[dict[str, DataFrame], list[str]]:
    """All published aggregates of a release and the names of the missing ones."""
    present, missing = {}, []
    for name, schema in like.items():
        try:
            present[name] = read_aggregate(spark, f"{folder}/{name}.csv", schema)
        except AnalysisException:
            missing.append(name)
    return present, missing
