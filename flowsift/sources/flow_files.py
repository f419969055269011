"""Flow exports in CSV files: finding, reading, fingerprinting, shaping."""

from __future__ import annotations

from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.functions import digest
from flowsift.functions.order import row_text
from flowsift.functions.text import na_to_null
from flowsift.session import landed
from flowsift.spec import DEFAULT_SPEC, FlowSpec

ROW_ID = "_row"
CORRUPT = "_corrupt"
#: Bytes of a file that a task hashes, and that it holds at a time.
PIECE, READ_BYTES = 256 << 20, 4 << 20


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException:
        return False
    return True


def discover(spark: SparkSession, custom: str | None, folder: str, default: str) -> str:
    """The custom path, else the default file, else all CSV files of the folder."""
    choices = [custom, f"{folder.rstrip('/')}/{default}", f"{folder.rstrip('/')}/*.csv"]
    for path in choices:
        if path and path_exists(spark, path):
            return path
    raise FileNotFoundError(f"No flow file: looked for '{default}' and *.csv in {folder}")


def read_flow_csv(
    spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Every column as text, missing-value tokens as NULL, names stripped.

    `_row` orders rows as they stand in the files; it is taken at the scan, before
    anything is shuffled. A line with more or fewer fields than the header is kept
    whole in `_corrupt`, which is NULL for all others; split_corrupt tells them apart.
    A file whose header differs from the first one's fails the read instead of
    shifting columns; read_flow_files takes such files together.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .option("escape", '"')
    )
    named = reader.csv(path).schema
    # A line is only known to be malformed when all of it is parsed.
    raw = (
        reader.option("mode", "PERMISSIVE").option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(T.StructType([*named, T.StructField(CORRUPT, T.StringType())]))
        .csv(path)
    )
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    values = [na_to_null(F.col(f"`{c}`")).alias(c) for c in named.names]
    # Spark reads no malformed lines when nothing else of a file is asked for.
    line = F.concat(F.col(CORRUPT), F.substring(F.coalesce(F.col(f"`{named.names[0]}`"), F.lit("")), 1, 0))
    return strip_names(raw.select(*values, line.alias(CORRUPT), position.alias(ROW_ID)))


def read_flow_files(
    spark: SparkSession, path: str | list[str], encoding: str = "ISO-8859-1"
) -> DataFrame:
    """read_flow_csv for exports of several days, whose headers may differ.

    Files are grouped by their header line. Each group is read with its own header, and the groups
    are joined by column name (stripped, and by letters of any case where that names one column);
    a column that a group lacks is NULL in its rows. The columns stand in the order of the first
    header in which they appear, headers being ordered by their first file.
    """
    groups = _by_header(spark, path, encoding)
    tables = [read_flow_csv(spark, files, encoding) for files in groups]
    if len(tables) == 1:
        return tables[0]
    names: dict[str, str] = {}
    for table in tables:
        own = [c.lower() for c in table.columns]
        for c in table.columns:
            if own.count(c.lower()) == 1:
                names.setdefault(c.lower(), c)
            else:  # names that differ in case only stay apart
                names.setdefault(c, c)
    names.pop(CORRUPT, None), names.pop(ROW_ID, None)
    aligned = []
    for table in tables:
        own = [c.lower() for c in table.columns]
        holds = {c if own.count(c.lower()) > 1 else c.lower(): c for c in table.columns}
        aligned.append(table.select(
            *[(F.col(f"`{holds[k]}`") if k in holds else F.lit(None).cast("string")).alias(name)
              for k, name in names.items()], CORRUPT, ROW_ID))
    out = aligned[0]
    for table in aligned[1:]:
        out = out.unionByName(table)
    return out


def _by_header(spark: SparkSession, path: str | list[str], encoding: str) -> list[list[str]]:
    """Files by header line, each group and the groups in the order of their names. Only the first
    line of each file is taken; there is one row per file."""
    lines = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.rtrim("value").alias("line"))
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("line", "row").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found = sorted(r["files"] for r in groups.select("files").collect())
    return found or [[path] if isinstance(path, str) else path]


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows without `_corrupt`, and the malformed lines as they stand in the file."""
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, raw.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), ROW_ID)


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def find_label(columns: list[str], spec: FlowSpec = DEFAULT_SPEC) -> str:
    """The label column, or the first column with "label" in its name."""
    if spec.label_col in columns:
        return spec.label_col
    for c in columns:
        if "label" in c.lower():
            return c
    raise ValueError(f"no column named '{spec.label_col}' and none with 'label' in its name: {columns}")


def resolve_features(
    columns: list[str], spec: FlowSpec = DEFAULT_SPEC
) -> tuple[dict[str, str], list[str]]:
    """(feature -> column that holds it, features without a column), names compared stripped."""
    by_name = {c.strip(): c for c in columns}
    found, missing = {}, []
    for feature in spec.features:
        names = [a.strip() for a in spec.aliases_of(feature)]
        source = next((by_name[n] for n in names if n in by_name), None)
        if source is None:
            missing.append(feature)
        else:
            found[feature] = source
    return found, missing


def shape_flows(
    df: DataFrame, spec: FlowSpec = DEFAULT_SPEC, keep: list[str] = ()
) -> tuple[DataFrame, list[str], list[str]]:
    """Features under their own names plus the label: (table, features, missing)."""
    named = strip_names(df)
    label = find_label(named.columns, spec)
    found, missing = resolve_features(named.columns, spec)
    cols = [F.col(f"`{c}`").alias(f) for f, c in found.items()]
    shaped = named.select(*cols, F.col(f"`{label}`").alias(spec.label_col), *keep)
    return shaped, list(found), missing


def file_fingerprints(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """First 16 hex digits of every file's SHA-256; Spark's file source has no row for an empty file.

    A file of up to PIECE bytes is one row of Spark's file source. SHA-256 has no parts that could be
    joined, so a longer file is read piece by piece, a job for each, and the state is handed from a task
    to the next.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files, length = reader.load(path), F.col("length")
    name, size = F.element_at(F.split("path", "/"), -1).alias("file"), length.alias("bytes")
    if not digest.resumable():
        return files.select(name, size, F.substring(F.sha2("content", 256), 1, 16).alias("fingerprint"))
    short = files.where(length <= PIECE).select(
        name, size, F.substring(F.sha2("content", 256), 1, 16).alias("fingerprint"))
    long = files.where(length > PIECE)
    n, longest = long.agg(F.count(F.lit(1)), F.max("length")).first()
    if not n:
        return short
    hashed = _hashed_by_piece(long.select("path", "length"), n, longest)
    return short.unionByName(hashed.select(name, size, F.substring("digest", 1, 16).alias("fingerprint")))


def _hashed_by_piece(files: DataFrame, n: int, longest: int) -> DataFrame:
    """path, length and SHA-256 of n files, of which a task reads PIECE bytes at most."""
    piece, block = PIECE, READ_BYTES
    held = files.withColumns({"state": F.lit(None).cast("binary"), "digest": F.lit(None).cast("string")})
    for start in range(0, longest, piece):

        def run(batches, start=start):
            for batch in batches:
                rows = batch.to_pylist()
                for row in rows:
                    end = min(start + piece, row["length"])
                    if start >= end:
                        continue
                    system, place = pa_fs.FileSystem.from_uri(quoted(row["path"]))
                    with system.open_input_file(place) as source:
                        source.seek(start)
                        for at in range(start, end, block):
                            data = source.read(min(block, end - at))
                            if len(data) < min(block, end - at):
                                raise OSError(f"{row['path']} is shorter than its {row['length']} bytes")
                            row["state"] = digest.advanced(row["state"], data)
                    if end == row["length"]:
                        row["digest"] = digest.finished(row["state"])
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

        # From one partition rows are dealt out in turn, one to a task.
        held = landed(held.coalesce(1).repartition(n).mapInArrow(run, held.schema), "sha256")
    return held


def quoted(path: str) -> str:
    """A path as Spark names it, as a URI: scheme and host stay, other characters are escaped."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}{colon}{quote(rest)}" if colon else f"file:{quote(path)}"


def row_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fingerprint of a table of any size that does not depend on row order.

    Sum and count of a 60-bit hash per row, hashed to 16 hex digits. Values go into the
    hash with their lengths, so no two rows of different values read alike.
    """
    rows, fingerprint = fingerprint_columns(df, columns)
    return df.agg(rows.alias("rows"), fingerprint.alias("fingerprint"))


def fingerprint_columns(df: DataFrame, columns: list[str]) -> tuple[Column, Column]:
    """Aggregates: number of rows and fingerprint."""
    piece = F.conv(F.substring(F.md5(row_text(df, columns)), 1, 15), 16, 10)
    total = F.coalesce(F.sum(piece.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
    rows = F.count(F.lit(1))
    text = F.concat_ws("|", rows.cast("string"), total.cast("string"))
    return rows, F.substring(F.sha2(text, 256), 1, 16)
