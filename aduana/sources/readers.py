"""Readers: every one returns a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aduana.functions.codes import text_literal
from aduana.functions.dates import ntz
from aduana.functions.frames import quoted
from aduana.operators.filters import DAY_COLUMN, YEAR_PARTITION, latest_period
from aduana.sources.contracts import ORGANISATION, PLANNING, Contract, conform


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parquet_tree(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """All files called `file_name` at any depth below `root` (what `root/**/file_name` means elsewhere;
    in a Spark path `**` only matches one level)."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", file_name).parquet(root)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header. A value that does not parse becomes null and its row stays."""
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", enforceSchema=False)


_CORRUPT = "_corrupt_line"


def read_csv_with_rejects(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """`read_csv`, and what it could not read: `file, field, value` of every cell that did not parse and is null in the
    table, and of every line with too few or too many cells, as a null `field` with the line as its value.

    The second frame reads the files again when it is used; the table itself costs no more than without it.
    """
    whole = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*whole.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = spark.read.csv(
        path, schema=marked, header=True, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=_CORRUPT)
    bad = lines.select("*", F.col("_metadata.file_path").alias("_file")).where(f"{_CORRUPT} IS NOT NULL")
    # The same line with every cell as text tells which cells are there and did not become a value.
    texts = ", ".join(f"{quoted(f.name)} STRING" for f in whole)
    bad = bad.withColumn("_cells", F.expr(f"from_csv({_CORRUPT}, {text_literal(texts)})"))
    cells = ", ".join(
        f"if({quoted(f.name)} IS NULL AND _cells.{quoted(f.name)} IS NOT NULL, "
        f"struct({text_literal(f.name)} AS field, _cells.{quoted(f.name)} AS value), NULL)" for f in whole)
    bad = bad.withColumn("_bad", F.expr(f"filter(array({cells}), c -> c IS NOT NULL)"))
    line = f"array(struct(CAST(NULL AS STRING) AS field, {_CORRUPT} AS value))"
    rejects = bad.selectExpr("_file AS file", f"inline(if(size(_bad) = 0, {line}, _bad))")
    return read_csv(spark, path, whole), rejects


def read_facts(spark: SparkSession, location: str, contract: Contract) -> DataFrame:
    """Fact table in its contract's types, with all further columns it has.

    `location` is a Parquet folder if it holds a slash ("./facts" for one beside the job), else a catalog table. The day
    column of `write_facts` serves the footers only and is left out.
    """
    facts = conform(spark.read.parquet(location) if "/" in location else spark.table(location), contract)
    return facts.drop(DAY_COLUMN) if YEAR_PARTITION in facts.columns else facts


def read_source(spark: SparkSession, locations: dict[str, str], source: str = "org") -> DataFrame:
    """Route a source name: "org" is the organisation fact, "jp" the planning-board fact."""
    if source not in ("org", "jp"):
        raise ValueError(f'Unknown source {source!r}; use "org" or "jp"')
    return read_facts(spark, locations[source], ORGANISATION if source == "org" else PLANNING)


def latest_day(spark: SparkSession, path: str) -> DataFrame:
    """One row: the latest `day` of stored facts and their number, `records`, from the footers of the files; no column is read.

    Spark takes aggregates from Parquet footers in its second reader interface only, which this frame is read with.
    """
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        found = spark.read.parquet(path).agg(F.max(DAY_COLUMN).alias("day"), F.count(F.lit(1)).alias("records"))
        found._jdf.queryExecution().optimizedPlan()  # planned with these settings, whenever it runs
        return found
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def read_latest(spark: SparkSession, locations: dict[str, str], source: str = "org") -> DataFrame:
    """Records at the latest date of facts that `write_facts` laid out; empty without any date.

    The latest day comes from the footers, in a small job; then only its year's folder is read, and of this only row groups
    that hold the day.
    """
    facts = read_source(spark, locations, source)
    day = latest_day(spark, locations[source]).first()["day"]
    if day is None:
        return facts.where("false")
    last = facts.where(f"{YEAR_PARTITION} = {day.year} AND date >= {ntz(f'{day.isoformat()} 00:00:00')}")
    return latest_period(last)


_TABLE_TEXT = "array<array<string>>"


def _tables(responses: DataFrame, column: str) -> DataFrame:
    """Texts and their rows; null rows for a text that is no complete array of arrays. Blank texts are left out."""
    rows = f"from_json({quoted(column)}, '{_TABLE_TEXT}')"
    parsed = responses.selectExpr(f"{quoted(column)} AS _text", f"{rows} AS _rows").where("trim(_text) <> ''")
    # A row that is no array is null within the table.
    return parsed.selectExpr("_text", "if(exists(_rows, r -> r IS NULL), NULL, _rows) AS _rows")


def unreadable_responses(responses: DataFrame, column: str = "value") -> DataFrame:
    """The texts that `promote_header` cannot read, such as truncated pages and error objects, as column `text`."""
    return _tables(responses, column).where("_rows IS NULL").selectExpr("_text AS text")


def header_names(responses: DataFrame, column: str = "value") -> list[str]:
    """All column names in the headers of all texts, by their first place. Starts a job that returns one row per name."""
    names = _tables(responses, column).selectExpr("posexplode(get(_rows, 0)) AS (place, name)")
    rows = names.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()
    if not rows:
        raise ValueError("no header row: there is no text to read")
    return [r["name"] for r in rows]


def promote_header(
    responses: DataFrame, names: list[str] | None = None, column: str = "value", skip_unreadable: bool = False
) -> DataFrame:
    """Rows out of JSON texts that are arrays of arrays, whose first row holds the column names.

    Each text is matched to columns by its own header, so pages may differ in the order and number of their columns.
    `names` are the columns to return; without them all names of all headers are. A text that cannot be read fails the
    query, or is left to `unreadable_responses` with `skip_unreadable`. All values stay text.
    """
    if names is None:
        names = header_names(responses, column)
    tables = _tables(responses, column)
    if skip_unreadable:
        tables = tables.where("_rows IS NOT NULL")
    else:
        failure = "raise_error(concat('response is no table: ', left(_text, 100)))"
        tables = tables.selectExpr(f"coalesce(_rows, {failure}) AS _rows")
    # Places are looked up once per text; 0, for a name that a page lacks, becomes null.
    places = [f"nullif(int(array_position(get(_rows, 0), {text_literal(n)})), 0) - 1 AS _at{k}" for k, n in enumerate(names)]
    cells = tables.selectExpr(*places, "explode(slice(_rows, 2, size(_rows))) AS _row")
    return cells.selectExpr(*(f"get(_row, _at{k}) AS {quoted(n)}" for k, n in enumerate(names)))


def read_header_json(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Landed API responses, one JSON array of arrays per file. A file is one row, so it must fit into a task."""
    return promote_header(spark.read.text(path, wholetext=True), names)


def _split_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed arrays of arrays: `file`, `text`, `head` (it begins the file's array), `tail` (it ends it) and `rows`,
    null where the text is not a list of rows."""
    # A row's end is the line separator, so files are split like any text.
    pieces = spark.read.option("lineSep", "],").text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file"))
    pieces = pieces.where(r"value RLIKE '\\S'")
    first, last = r"'^\\s*\\[\\s*\\['", r"'\\]\\s*\\]\\s*$'"
    pieces = pieces.selectExpr("file", "value AS text", f"value RLIKE {first} AS head", f"value RLIKE {last} AS tail")
    opened = f"if(head, regexp_replace(text, {first}, '['), text)"
    whole = f"if(tail, regexp_replace({opened}, {last}, ']'), concat({opened}, ']'))"
    records = pieces.selectExpr("*", f"from_json(concat('[', {whole}, ']'), '{_TABLE_TEXT}') AS rows")
    return records.selectExpr("file", "text", "head", "tail", "if(exists(rows, r -> r IS NULL), NULL, rows) AS rows")


def _files(records: DataFrame) -> DataFrame:
    """The header of each file, and whether it has one and an end."""
    header = F.first(F.expr("if(head, get(rows, 0), NULL)"), ignorenulls=True)
    return records.groupBy("file").agg(header.alias("header"), F.max("head").alias("head"), F.max("tail").alias("tail"))


def unreadable_records(spark: SparkSession, path: str) -> DataFrame:
    """`file` and `text` of what `read_header_records` cannot read: an error object, a row with the row separator within a
    value, a row that breaks off, and with a null text a file without its header or its end."""
    records = _split_records(spark, path)
    broken = _files(records).where("NOT (head AND tail)").selectExpr("file", "CAST(NULL AS STRING) AS text")
    return records.where("rows IS NULL").select("file", "text").unionByName(broken)


def read_header_records(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Landed API responses as `read_header_json` reads them, for files larger than a task: a file is read by as many tasks as
    its size asks for, record by record, and its header is joined to its rows by the file's name.

    A piece that is no row fails the query and names its file, and so does a file without its header or its end; nothing is
    left out. A value with a `],` in it is such a piece: `read_header_json` reads that file. Without `names` a job collects
    the names in all headers.
    """
    records = _split_records(spark, path)
    failure = "raise_error(concat('no row in ', file, ': ', left(text, 100)))"
    records = records.selectExpr("file", "head", "tail", f"coalesce(rows, {failure}) AS rows")
    files = _files(records)
    if names is None:
        places = files.selectExpr("posexplode(header) AS (place, name)").groupBy("name").agg(F.min("place").alias("place"))
        names = [r["name"] for r in places.orderBy("place", "name").collect()]
        if not names:
            raise ValueError("no header row: there is no text to read")
    whole = "CASE WHEN NOT head THEN raise_error(concat('no header in ', file)) WHEN NOT tail THEN raise_error(concat('no end in ', file)) ELSE file END"
    places = [f"nullif(int(array_position(header, {text_literal(n)})), 0) - 1 AS _at{k}" for k, n in enumerate(names)]
    files = files.selectExpr(f"{whole} AS file", *places)
    rows = records.selectExpr("file", "explode(if(head, slice(rows, 2, size(rows)), rows)) AS row")
    cells = rows.join(files, "file", "left")
    return cells.selectExpr(*(f"get(row, _at{k}) AS {quoted(n)}" for k, n in enumerate(names)))
