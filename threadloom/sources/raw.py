"""Raw inputs and plain sinks."""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_folder


def scan_prefix(spark: SparkSession, prefix: str) -> DataFrame:
    """All Parquet files below a prefix, however their extension is written."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][aA][rR][qQ][uU][eE][tT]").parquet(prefix)


def patch_columns(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Adds columns that a file lacks."""
    return rows.withColumns({k: F.lit(v) if v is not None else F.lit(None).cast("timestamp") for k, v in defaults.items() if k not in rows.columns})


def to_utc(rows: DataFrame, column: str) -> DataFrame:
    """A time column from text or time; what can't be read becomes null."""
    return rows.withColumn(column, F.try_to_timestamp(F.col(column).cast("string")))


def toc_locations(rows: DataFrame, key: str, url: str) -> DataFrame:
    """(key, turn, path): where a table of contents may be, deepest folder first."""
    parts = F.filter(F.split(F.regexp_replace(url, "^https?://[^/]*|[?].*$", ""), "/"), lambda x: x != "")
    n = F.size(parts)
    paths = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n - i), "/"), F.lit("/toc.json"))))
    return rows.select(key, F.posexplode(paths).alias("turn", "path"))


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """A CSV with a header and a fixed choice of columns."""
    rows.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


#: The columns of a sheet of documents, in order.
DOCUMENT_SHEET = ["Order", "Product", "URL", "Title", "Body"]


def write_document_sheet(rows: DataFrame, path: str) -> None:
    """A CSV of the columns of DOCUMENT_SHEET, in UTF-8 behind a byte order mark, which spreadsheet programs ask for: the mark is
    the first character of each file's header. Files are ranges by Order, so their names sort as the rows do."""
    ordered = rows.select(*DOCUMENT_SHEET).repartitionByRange("Order").sortWithinPartitions("Order")
    marked = ordered.withColumnRenamed("Order", "\ufeffOrder")
    marked.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def csv_round_trip(rows: DataFrame, columns: list[str], schema: str) -> DataFrame:
    """What a reader of the written CSV gets, from the shared folder."""
    spark = rows.sparkSession
    path = new_folder(spark, "csv")
    write_csv(rows, path, columns)
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


SHEET = ["question_id", "title", "source_url", "asked_utc", "asker", "body_raw"]
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN, _REL = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def write_xlsx(rows: DataFrame, path: str, columns: list[str] = SHEET, most: int = 1_048_575) -> int:
    """One sheet of text cells under a header, written at the driver for people to open; the number of rows.

    A sheet holds 1,048,575 rows: a table with more is an error, and CSV its form. Rows stream to the driver by partition.
    """
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"a sheet holds {most} rows")
    text = lambda x: escape("".join(c for c in ("" if x is None else str(x)) if c >= " " or c in "\t\n\r")[:32_767])
    line = lambda cells: "<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{text(x)}</t></is></c>' for x in cells) + "</row>"
    count = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{_XML}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        z.writestr("_rels/.rels", f'{_XML}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_XML}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{_XML}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with z.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>{line(columns)}'.encode())
            for r in rows.select(*columns).toLocalIterator():
                sheet.write(line(r).encode())
                count += 1
            sheet.write(b"</sheetData></worksheet>")
    return count


def upload(files: DataFrame, put: Callable[[str, bytes], None], trigger: Callable[[], None] | None = None, name: str = "name", content: str = "content") -> int:
    """Calls `put(name, content)` for every row in the tasks, and once all are done `trigger()`, such as an indexer's run.

    A task that runs again puts its rows again, so `put` must overwrite. The number of rows is returned, as the tasks counted it.
    """
    done = files.sparkSession.sparkContext.accumulator(0)

    def each(rows):
        n = 0
        for r in rows:
            body = r[content]
            put(r[name], body if isinstance(body, (bytes, bytearray)) else str(body).encode())
            n += 1
        done.add(n)

    kept = files.select(name, content).where(F.col(name).isNotNull() & F.col(content).isNotNull())
    kept.foreachPartition(each)
    if trigger is not None:
        trigger()
    return done.value
