"""Fixed-width record files in Windows-1252, with a header and a trailer line per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import NULL_TEXTS

Layout = Sequence[tuple[str, int, int]]

_STRETCH = 7

#: Lines per file, about: a file is sorted and written by one task.
LINES_PER_FILE = 50_000

# Bytes 0x80-0x9F that Windows-1252 defines, as ISO-8859-1 reads them and as they are meant.
_BYTES = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_AS_READ = "".join(chr(b) for b in _BYTES)
_AS_MEANT = "".join(bytes([b]).decode("cp1252") for b in _BYTES)

# Every character that a line may hold.
_PRINTED = "".join(map(chr, [*range(0x20, 0x7F), *range(0xA0, 0x100)])) + _AS_MEANT


def from_windows_1252(c: Column | str) -> Column:
    """Text that was decoded as ISO-8859-1 to what its Windows-1252 bytes mean."""
    return F.translate(F.col(c) if isinstance(c, str) else c, _AS_READ, _AS_MEANT)


def parse_fields(
    lines: DataFrame, layout: Layout, *, line: str = "line", keep: Sequence[str] = ()
) -> DataFrame:
    """Cuts every field out of ``line``: trimmed text, null when missing.

    Columns in ``keep`` stay as they are.

    Finding a place in text counts its characters from the left, so the line is first cut
    into stretches of a few fields and each field is found within its stretch.
    """
    by_place = sorted(layout, key=lambda field: field[1])
    stretches = [by_place[i:i + _STRETCH] for i in range(0, len(by_place), _STRETCH)]
    pieces = lines.select(*[
        F.substring(line, s[0][1] + 1, s[-1][2] - s[0][1]).alias(f"_{i}")
        for i, s in enumerate(stretches)
    ], *keep)
    cuts = {
        name: f"trim(substring(_{i}, {start - s[0][1] + 1}, {end - start})) AS `{name}`"
        for i, s in enumerate(stretches) for name, start, end in s
    }
    missing = ", ".join(f"'{text}'" for text in ["", *NULL_TEXTS])
    return pieces.selectExpr(*[cuts[name] for name, _, _ in layout], *keep).selectExpr(*[
        f"CASE WHEN `{name}` NOT IN ({missing}) THEN `{name}` END AS `{name}`"
        for name, _, _ in layout
    ], *keep)


def to_windows_1252(c: Column | str) -> Column:
    """The reverse: text that, encoded as ISO-8859-1, has the bytes of Windows-1252."""
    return F.translate(F.col(c) if isinstance(c, str) else c, _AS_MEANT, _AS_READ)


def fits_windows_1252(c: Column) -> Column:
    """Whether all characters of a text have a byte, and none of them ends a line.

    Looking each character up takes long, so that is done for texts beyond ISO-8859-1 only.
    """
    return c.rlike(r"^[ -~\xA0-\xFF]*+\z") | (F.length(F.translate(c, _PRINTED, "")) == 0)


def _text_options(io):
    for name, value in (("encoding", "ISO-8859-1"), ("sep", "\u0001"), ("quote", ""),
                        ("escape", ""), ("header", True)):
        io = io.option(name, value)
    return io


def write_record_files(
    lines: DataFrame, folder: str, *, files: int, order: Sequence[str], header: str = "HEADER",
    line: str = "line", trailer: str = "TRAILER",
) -> None:
    """Writes lines as Windows-1252 record files, each with a header and a trailer line.

    Lines are dealt to ``files`` by their ``order`` columns, which tell them apart, and stand
    in that order. Beyond ``LINES_PER_FILE`` lines in each there are as many more files as it
    takes, so that no task's share grows with the lines. The trailer ends with the number of
    lines of its file.
    """
    files = max(files, -(-lines.count() // LINES_PER_FILE))
    at = F.pmod(F.xxhash64(*order), F.lit(files)).cast("int")
    body = lines.select(F.col(line).alias("line"), at.alias("file"), F.lit(0).alias("last"),
                        F.struct(*order).alias("at"))
    ends = body.groupBy("file").agg(
        F.format_string(f"{trailer}%010d", F.count(F.lit(1))).alias("line"),
        F.lit(1).alias("last"), F.max("at").alias("at"))
    rows = body.unionByName(ends).repartition(files, "file").sortWithinPartitions(
        "file", "last", "at")
    out = rows.select(to_windows_1252("line").alias(header), "file").write.partitionBy("file")
    _text_options(out).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(folder)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Body lines of record files: blank lines, each file's first and last line are gone.

    ``_ord`` is a line's file, split, and place in its split. The reader itself drops the
    header. A file's trailer is the last line of its last split that has any: a small
    aggregate finds one line per file, which is dropped while the lines are read. Both scans
    have the same columns and splits; the line itself is compared as well.
    """
    raw = _text_options(spark.read.schema("line string")).csv(path).select(
        "line",
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("place"),
        ).alias("_ord"),
    )
    last = raw.groupBy(F.col("_ord.path").alias("path")).agg(
        F.max_by(F.struct("_ord", "line"), F.struct("_ord.split", "_ord.place")).alias("last"))
    # One row per file, as many as the driver lists for the scan anyway.
    trailers = F.broadcast(last.select("last._ord", "last.line"))
    body = raw.join(trailers, ["_ord", "line"], "left_anti")
    return body.select(from_windows_1252("line").alias("line"), "_ord")


def read_records(spark: SparkSession, path: str | Sequence[str], layout: Layout) -> DataFrame:
    """Parsed fields of every body line, and the line's ``_ord``."""
    return parse_fields(read_lines(spark, path), layout, keep=["_ord"])


def lines_and_rejects(
    records: DataFrame, layout: Layout, *, keep: Sequence[str] = ()
) -> DataFrame:
    """Every record as a text line with its fields at their places, or why it has none.

    ``line`` is null where a field does not fit; then ``field`` is the first such field in
    the order of places, ``reason`` says whether its value is longer than the field or has a
    character that the file cannot hold, and ``value`` shows it. One pass gives both outputs.
    """
    parts, at, fields = [], 0, []
    for name, start, end in sorted(layout, key=lambda f: f[1]):
        value, width = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")), end - start
        if start > at:
            parts.append(F.lit(" " * (start - at)))
        parts.append(F.rpad(value, F.greatest(F.length(value), F.lit(width)), F.lit(" ")))
        fields.append(F.struct(F.lit(name).alias("field"), F.lit(width).alias("width"), value.alias("value")))
        at = end
    # A line of the right length without odd characters is good; only else its fields are judged.
    bad = F.filter(F.array(*fields), lambda f: (F.length(f["value"]) > f["width"]) | ~fits_windows_1252(f["value"]))
    wrong = F.when((F.length("line") != at) | ~fits_windows_1252(F.col("line")), bad[0])
    judged = records.select(*keep, F.concat(*parts).alias("line"), *[F.col(f"`{n}`") for n, _, _ in layout]).select(
        *keep, "line", wrong.alias("wrong"))
    long = F.length("wrong.value") > F.col("wrong.width")
    return judged.select(
        *keep, F.when(F.col("wrong").isNull(), F.col("line")).alias("line"), "wrong.field",
        F.when(long, F.lit("too long")).when(~long, F.lit("no such character")).alias("reason"), "wrong.value")


def to_lines(records: DataFrame, layout: Layout) -> DataFrame:
    """Records as text lines; a value that does not fit its field is an error."""
    checked = lines_and_rejects(records, layout)
    wrong = F.raise_error(F.concat_ws(" ", "field", F.lit("is longer than its field or cannot be written:"), "reason"))
    return checked.select(
        F.when(F.col("field").isNull(), F.col("line")).otherwise(wrong.cast("string")).alias("line"))
