"""CSV in and out."""

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo.functions.barrier import once
from saldo.functions.cells import beyond, missing_to_null, month_key
from saldo.operators.clean import MARKED, OVERFLOW, POSITION, check_headers, mark_of, marks
from saldo.schema import CLEAN

# What the bytes 0x80 to 0x9F mean in windows-1252, where they mean something.
_C1 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ",
    0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“",
    0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›",
    0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
_C1_FROM = "".join(chr(b) for b in _C1)
_C1_TO = "".join(_C1.values())
_C1_UNUSED = "[" + "".join(f"\\x{{{b:X}}}" for b in range(0x80, 0xA0) if b not in _C1) + "]"

#: Holds the line of a row whose fields are not as many as those of the header.
_MARKED = "_marked_line"
#: Of a packed file.
ROWS_PER_FILE = 1_000_000
_QUOTING = {"header": True, "quote": '"', "escape": '"'}


@dataclass(frozen=True)
class TextForm:
    """How to read a file: its encoding, and whether quoted values span lines."""

    encoding: str
    multi_line: bool


def _found(error: AnalysisException, path: str) -> Exception:
    if error.getCondition() == "PATH_NOT_FOUND":
        return FileNotFoundError(path)
    return error


def _detected(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """What tells the form: of all lines, or of those of each file."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        raise _found(error, path) from error
    value = F.col("value")
    as_latin = F.decode(value.cast("binary"), "ISO-8859-1")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return lines.select("value", F.col("_metadata.file_path").alias("file")).groupBy(*by).agg(
        F.bool_and(F.is_valid_utf8(value)).alias("utf8"),
        F.bool_or(as_latin.rlike(_C1_UNUSED)).alias("unused"),
        F.bool_or(quotes % 2 == 1).alias("open_quote"),
    )


def _form(seen: Row) -> TextForm:
    if seen.utf8 is None or seen.utf8:
        encoding = "utf-8"
    else:
        encoding = "iso-8859-1" if seen.unused else "windows-1252"
    return TextForm(encoding, bool(seen.open_quote))


def detect_form(spark: SparkSession, path: str) -> TextForm:
    """First of utf-8, windows-1252, iso-8859-1 that decodes every line, in one pass.

    An open quote at the end of a line means values that span lines. Those files cannot be
    split; others are.
    """
    return _form(_detected(spark, path).first())


def detect_forms(spark: SparkSession, path: str) -> dict[TextForm, list[str]]:
    """The files of each form, as `detect_form` finds it file by file; files without lines are in none."""
    found: dict[TextForm, list[str]] = {}
    for seen in _detected(spark, path, "file").collect():
        found.setdefault(_form(seen), []).append(unquote(seen.file))
    return found


def _from_latin(text: Column) -> Column:
    """windows-1252 text that was decoded as iso-8859-1: only 0x80 to 0x9F differ."""
    return F.translate(text, _C1_FROM, _C1_TO)


def _too_long(line: Column, fields: int) -> Column:
    """Whether a line has more fields than the header: commas outside of quoted values."""
    # A doubled quote ends one part and begins the next, so parts alternate by quote parity. The
    # scan is linear: a group under a star would hold a stack frame for each character.
    bare = F.regexp_replace(line, r'"[^"]*+(?:"|$)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= fields


def _read_form(spark: SparkSession, files: list[str], form: TextForm) -> DataFrame:
    """Rows of files of one form; a row of more fields than the header is an error when it is read."""
    latin = form.encoding != "utf-8"
    # Without column pruning, else a row's fields are not counted where few columns are asked for.
    reader = spark.read.options(**_QUOTING, multiLine=form.multi_line, enforceSchema=False, columnPruning=False).option(
        "encoding", "ISO-8859-1" if latin else "UTF-8")
    try:
        names = reader.csv(files)
        check_headers(names)
        # Rows with fewer fields are marked too; they stay, filled with NULL.
        marked = T.StructType([*names.schema.fields, T.StructField(_MARKED, T.StringType())])
        raw = reader.schema(marked).option("columnNameOfCorruptRecord", _MARKED).csv(files)
    except AnalysisException as error:
        raise _found(error, files[0]) from error
    line = F.col(_MARKED)
    # Spark reads the marked line only along with another column.
    first = F.coalesce(raw[f"`{names.columns[0]}`"], F.lit(""))
    refused = F.raise_error(F.concat(F.lit(f"more than {len(names.columns)} fields in row "), first, F.lit(": "), line))
    raw = raw.filter(F.when(_too_long(line, len(names.columns)), refused.cast("boolean")).otherwise(True))

    def value(name: str) -> Column:
        text = raw[f"`{name}`"]
        return missing_to_null(_from_latin(text) if form.encoding == "windows-1252" else text)

    file, block, _ = POSITION
    return raw.select(
        *[value(c).alias(c) for c in names.columns],
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(block),
    )


def read_raw_csv(spark: SparkSession, path: str, form: TextForm | None = None) -> DataFrame:
    """Every column as text, missing texts as NULL, each row with its place in the source.

    Each file is read by its own form. Give `form` to save the detection pass.
    """
    forms = {form: [path]} if form else detect_forms(spark, path)
    if len(forms) < 2:
        forms = {next(iter(forms), TextForm("utf-8", False)): [path]}
    else:
        # Names are taken as they are, not as patterns.
        forms = {f: [re.sub(r"([\\{}\[\]*?])", r"\\\1", name) for name in names] for f, names in forms.items()}
    read = [_read_form(spark, files, f) for f, files in forms.items()]
    every = read[0]
    for one in read[1:]:
        every = every.unionByName(one)
    return every.withColumn(POSITION[2], F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str, *, one_file: bool = False, packed: bool = False) -> None:
    """CSV with a header. `one_file` is for reports, whose rows are few.

    `packed` is for files read again by a job: about a fifth of the bytes, in gzip. Those cannot
    be split, so a file holds ROWS_PER_FILE at most; the readers here take either kind.
    """
    out = df.coalesce(1) if one_file else df
    form = {"compression": "gzip", "maxRecordsPerFile": ROWS_PER_FILE} if packed else {}
    (
        out.write.mode("overwrite").options(**form)
        .options(**_QUOTING, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A report as written by `write_csv`; another header or a value of another type is an error.

    A file was written by one task and is read by one, so values may span lines. An empty text
    is told from NULL: it has quotes.
    """
    return spark.read.schema(schema).options(
        **_QUOTING, mode="FAILFAST", enforceSchema=False, multiLine=True, nullValue="\0",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def with_texts(clean: DataFrame) -> DataFrame:
    """Clean rows as they are to be written: numbers beyond their columns as the texts they had."""
    if OVERFLOW not in clean.columns:
        return clean
    return clean.withColumns({c: F.coalesce(mark_of(c), F.col(c).cast("string")) for c in MARKED}).drop(OVERFLOW)


def read_clean_csv(spark: SparkSession, path: str, *, overflow: bool = False) -> DataFrame:
    """Clean rows as written by `write_csv`: declared types, any bad value is an error.

    A number beyond its column is an error too; with `overflow` it is NULL, and OVERFLOW holds
    its text.
    """
    read = T.StructType([T.StructField(f.name, T.StringType()) if f.name in MARKED else f for f in CLEAN.fields])
    try:
        df = spark.read.schema(read).options(**_QUOTING, mode="FAILFAST", enforceSchema=False).csv(path)
    except AnalysisException as error:
        raise _found(error, path) from error
    require_type(df, "order_date", T.DateType())
    texts = [f.name for f in read.fields if isinstance(f.dataType, T.StringType)]
    df = df.withColumns({c: missing_to_null(F.col(c)) for c in texts})
    types = {f.name: f.dataType for f in CLEAN.fields}
    df = once(df, {f"_typed_{c}": F.col(c).try_cast(types[c]) for c in MARKED})

    def value(c: str) -> Column:
        typed = F.col(f"_typed_{c}")
        good = typed.isNotNull() | F.col(c).isNull()
        if overflow:
            good = good | mark_of(c).isNotNull()
        error = F.raise_error(F.concat(F.lit(f"{c} is no number of its type: "), F.col(c))).cast(types[c])
        return F.when(good, typed).otherwise(error)

    if overflow:
        df = once(df, {f"_text_{c}": beyond(F.col(c), F.col(f"_typed_{c}")) for c in MARKED})
        df = df.withColumn(OVERFLOW, marks(df, {c: F.col(f"_text_{c}") for c in MARKED}))
    columns = [value(c).alias(c) if c in MARKED else F.col(c) for c in types]
    return df.select(*columns, *([OVERFLOW] if overflow else [])).withColumn("year_month", month_key(F.col("order_date")))


def require_type(df: DataFrame, column: str, expected: T.DataType) -> None:
    actual = df.schema[column].dataType
    if actual != expected:
        raise TypeError(f"{column} should be {expected.simpleString()}, is {actual.simpleString()}")
