"""XML files of ``<record>`` elements as text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.schemas import RecordType

RECORD = "record"
START, END = f"<{RECORD}[\\s>]", f"</{RECORD}>"
# FAILFAST: a damaged file must fail its load, not turn into null rows.
OPTIONS = {"rowTag": RECORD, "mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}
# What the binaryFile source offers.
FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"
# What may follow the root element: comments and processing instructions.
AFTER = r"(\s|<!--((?!-->).)*-->|<\?((?!\?>).)*\?>)*"


def _renamed(df: DataFrame, record: RecordType) -> DataFrame:
    return df.select(
        *[F.col(f"`{element}`").alias(name) for element, name in record.elements.items()]
    )


def _chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, value``: the text between two record ends. Splits at any of them."""
    return (
        spark.read.option("lineSep", END)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )


def empty_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files without bytes; file sources skip them, so the file system is asked."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for one in [path] if isinstance(path, str) else path:
        place = hadoop.Path(one)
        fs = place.getFileSystem(conf)
        for status in (s for top in fs.globStatus(place) or [] for s in fs.listStatus(top.getPath())):
            name = status.getPath().getName()
            if status.isFile() and status.getLen() == 0 and name[0] not in "._":
                found.append(status.getPath().toString())
    return found


def has_records(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether any file has a record; reading ends at the first."""
    return not _chunks(spark, path).where(F.col("value").rlike(START)).isEmpty()


def write_no_records(spark: SparkSession, path: str, root: str) -> None:
    """A whole document without records, in place of the file ``path``."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(place, True)
    out.write(bytearray(f"<{root}>\n</{root}>\n".encode()))
    out.close()


def check_complete(spark: SparkSession, path: str | list[str]) -> None:
    """Raise when a file has no bytes or lacks the end of its root element.

    FAILFAST notices a record that is cut off, but not a file that stops
    between two records. What follows the last record of a whole file is the
    closing root tag, so each file has exactly one chunk like that.
    """
    empty = empty_files(spark, path)
    if empty:
        raise ValueError(f"XML file is empty: {empty[0]}")
    is_tail = ~F.col("value").rlike(START) & F.col("value").rlike(rf"(?s)(</[^>]+|/)>{AFTER}$")
    broken = (
        _chunks(spark, path)
        .groupBy("file")
        .agg(F.count_if(is_tail).alias("tails"))
        .where(F.col("tails") != 1)
    )
    damaged = broken.first()
    if damaged is not None:
        raise ValueError(f"XML file is cut off: {damaged['file']}")


def read_xml(
    spark: SparkSession,
    path: str | list[str],
    record: RecordType,
    split: bool = False,
) -> DataFrame:
    """Staging columns of every record; a missing child is null, an empty one ``''``.

    A damaged file raises: at once when it ends too early, else when it is
    parsed. Files of any size take the same reader, which gives one task per
    file; only a caller who knows the files to be flat asks for ``split``
    (see :func:`read_xml_split`).
    """
    check_complete(spark, path)
    if split:
        return read_xml_split(spark, path, record)
    return _renamed(
        spark.read.format("xml").options(**OPTIONS).schema(record.xml_schema).load(path), record
    )


def read_xml_split(spark: SparkSession, path: str | list[str], record: RecordType) -> DataFrame:
    """The records of files too large for one task each.

    The text source cuts a file at any record end, so its parts spread over
    all tasks and each chunk is parsed on its own. Expects flat records: no
    ``<record>`` inside another, no record end inside a comment or CDATA.
    """
    head = f"(?s)^.*?(?={START})"
    body = F.concat(F.regexp_replace("value", head, ""), F.lit(END))
    parsed = (
        _chunks(spark, path)
        .where(F.col("value").rlike(START))
        .select(F.from_xml(body, record.xml_schema, OPTIONS).alias("r"))
    )
    return _renamed(parsed.select("r.*"), record)


def stream_files(
    spark: SparkSession, folder: str, archive: str | None = None, max_files: int = 1
) -> DataFrame:
    """Paths of files arriving in ``folder``, oldest first; their content is not read.

    With ``archive`` the source moves a file there once the batch after its own
    has begun; that folder must lie outside the watched one.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("maxFilesPerTrigger", str(max_files))
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("filename")
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``filename, length, modified`` of a folder; no content is read."""
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("filename"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def move_file(spark: SparkSession, path: str, folder: str) -> None:
    """Move a processed file into ``folder``, in place of one of that name."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(path), hadoop.Path(folder, path.rsplit("/", 1)[-1])
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(folder))
    fs.delete(target, False)
    if not fs.rename(source, target):
        raise OSError(f"cannot move {path} to {folder}")
