"""N-gram tables: readers for parquet, CSV, text and SequenceFile, and a text adapter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pairlore.sources.scratch import remove, shared_folder

NGRAM_COLUMNS = ["ngram", "year", "match_count"]
FORMATS = ("parquet", "orc", "csv", "text", "sequencefile")
ON_ERROR = ("fail", "quarantine")


def read_ngrams(
    spark: SparkSession,
    path: str | list[str],
    format: str = "parquet",
    on_error: str = "fail",
    **options: str,
) -> DataFrame:
    """``(ngram, year, match_count)`` from one corpus, given by its path.

    ``text``, ``csv`` and ``sequencefile`` hold lines of three or more fields.  They are
    TAB-separated without quotes; for ``csv``, ``options`` (``sep``, ``quote``, ``escape``)
    can say otherwise, one record per line.  ``rejected_ngram_lines`` returns what
    ``on_error="quarantine"`` leaves out.
    """
    if format in ("text", "sequencefile"):
        return parse_ngram_lines(read_lines(spark, path, format), on_error)
    if format == "csv":
        return parse_ngram_lines(read_lines(spark, path), on_error, **options)
    if format in ("parquet", "orc"):
        table = spark.read.format(format).options(**options).load(path)
        return table.select(*NGRAM_COLUMNS)
    raise ValueError(f"format must be one of {FORMATS}, not {format!r}")


def read_lines(
    spark: SparkSession, path: str | list[str], format: str = "text"
) -> DataFrame:
    """Raw lines as column ``value``."""
    if format in ("text", "csv"):
        return spark.read.text(path)
    if format == "sequencefile":
        paths = path if isinstance(path, str) else ",".join(path)
        return _sequence_file_values(spark, paths)
    raise ValueError(f"lines come from 'text', 'csv' or 'sequencefile', not {format!r}")


def _hadoop_class(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.java.lang.Class.forName(f"org.apache.hadoop.{name}")


def _sequence_file_values(spark: SparkSession, paths: str) -> DataFrame:
    """Values of SequenceFiles, one row per record, as column ``value``; keys are dropped.

    Hadoop's ``SequenceFileAsTextInputFormat`` turns each record's key and value into text in
    the JVM, so a value that holds line ends (``\\n``, ``\\r``) stays one row. The pairs are
    given their schema in the JVM as well, as ``createDataFrame`` does without its row check in
    Python: no Python worker touches a record and nothing runs before an action. Splits follow
    the files' sync marks, so a large file is read by many tasks.
    """
    sc = spark.sparkContext
    pairs = sc.newAPIHadoopFile(
        paths,
        "org.apache.hadoop.mapreduce.lib.input.SequenceFileAsTextInputFormat",
        "org.apache.hadoop.io.Text",
        "org.apache.hadoop.io.Text",
    )
    schema = StructType([StructField("key", StringType()), StructField("value", StringType())])
    rows = sc._jvm.SerDeUtil.toJavaArray(pairs._to_java_object_rdd())
    frame = spark._jsparkSession.applySchemaToPythonRDD(rows.rdd(), schema.json())
    return DataFrame(frame, spark).select("value")


_BLOCKS_OF_LZ4 = {"compress": "true", "compress.type": "BLOCK", "compress.codec": "org.apache.hadoop.io.compress.Lz4Codec"}


def write_sequence_file(lines: DataFrame, path: str) -> None:
    """Lines (column ``value``) as a SequenceFile of Text, keyed by their place in the file.

    They go through text on shared storage: both steps stay inside the JVM.  Both copies are
    compressed (LZ4; the SequenceFile by blocks, which any of its readers opens) and the first
    is deleted at the end.
    """
    spark = lines.sparkSession
    folder = shared_folder(spark, "lines")
    lines.select("value").write.text(folder, compression="lz4")
    conf = spark.sparkContext._jvm.org.apache.hadoop.conf.Configuration(spark.sparkContext._jsc.hadoopConfiguration())
    for key, value in _BLOCKS_OF_LZ4.items():
        conf.set(f"mapreduce.output.fileoutputformat.{key}", value)
    key, text = (_hadoop_class(spark, f"io.{c}") for c in ("LongWritable", "Text"))
    reader = _hadoop_class(spark, "mapreduce.lib.input.TextInputFormat")
    writer = _hadoop_class(spark, "mapreduce.lib.output.SequenceFileOutputFormat")
    records = spark.sparkContext._jsc.newAPIHadoopFile(folder, reader, key, text, conf)
    records.saveAsNewAPIHadoopFile(path, key, text, writer, conf)
    remove(spark, folder)


def _checked(on_error: str) -> str:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    return on_error


#: How fields are parted unless options say otherwise.
_PLAIN = {"sep": "\t", "quote": ""}
CSV_OPTIONS = ("sep", "quote", "escape")


def _fields(options: dict[str, str]) -> Column:
    """The fields of a line as an array of three or more strings."""
    unknown = sorted(options.keys() - set(CSV_OPTIONS))
    if unknown:
        raise ValueError(f"options must be among {CSV_OPTIONS}, not {unknown}")
    if not options or _PLAIN | options == _PLAIN:
        return F.split("value", "\t")
    names = [f"f{i}" for i in range(4)]  # a longer line keeps its first fields
    schema = ", ".join(f"{n} string" for n in names)
    record = F.from_csv("value", F.lit(schema), {**_PLAIN, **options, "mode": "PERMISSIVE"})
    return F.array(*(record[n] for n in names))


def _number(fields: Column, position: int) -> Column:
    return F.get(fields, F.lit(position)).try_cast("bigint")


def _is_well_formed(fields: Column) -> Column:
    return _number(fields, 1).isNotNull() & _number(fields, 2).isNotNull()


def parse_ngram_lines(lines: DataFrame, on_error: str = "fail", **options: str) -> DataFrame:
    """Lines ``ngram TAB year TAB match_count [TAB ...]`` to typed columns.

    With ``fail`` a line without two whole numbers stops the job even when its n-gram would
    be filtered out later; with ``quarantine`` such lines are left out here and returned by
    ``rejected_ngram_lines``.  ``options`` part the fields as CSV does.
    """
    fields = _fields(options)
    keep = _is_well_formed(fields)
    if _checked(on_error) == "fail":
        stop = F.raise_error(F.concat(F.lit("not an n-gram line: "), F.col("value")))
        keep = F.when(keep, F.lit(True)).otherwise(stop.cast("boolean"))
    return lines.where(keep).select(
        F.get(fields, F.lit(0)).alias("ngram"),
        _number(fields, 1).alias("year"),
        _number(fields, 2).alias("match_count"),
    )


def rejected_ngram_lines(lines: DataFrame, **options: str) -> DataFrame:
    """The lines that ``parse_ngram_lines(..., on_error="quarantine")`` leaves out."""
    return lines.where(~_is_well_formed(_fields(options))).select("value")


def bigrams_of_text(texts: DataFrame, text: str, year: Column, *keep: str) -> DataFrame:
    """Every adjacent word pair of every text: ``(w1, w2, year, match_count = 1)``.

    Words are separated by runs of space, tab, newline and carriage return; whole texts are
    used.  The rows are not counted here: the pair count sums them, map-side first, so a
    count by year in between would only add a shuffle.
    """
    separators = " \n\t\r"
    words = F.split(F.trim(text, F.lit(separators)), f"[{separators}]+")
    following = F.size("words") - 1
    pairs = F.arrays_zip(
        F.slice("words", F.lit(1), following).alias("w1"),
        F.slice("words", F.lit(2), following).alias("w2"),
    )
    return (
        texts.select(*keep, year.alias("year"), words.alias("words"))
        .where(F.size("words") > 1)
        .select(*keep, F.inline(pairs).alias("w1", "w2"), "year")
        .withColumn("match_count", F.lit(1).cast("bigint"))
    )


def ngrams_from_text(
    texts: DataFrame, text: str, year: Column, document: str, together: Sequence[Column] = ()
) -> DataFrame:
    """Yearly bigram table of a table of texts, in the full n-gram schema.

    The texts of a document are brought together first, which moves every word once; its pairs
    are then counted where they are made, and only counts by year and n-gram are shuffled.
    Counting distinct documents per n-gram would shuffle every pair with its document as well.
    Documents without an id count for no volume, so their texts may lie anywhere.

    ``together`` are values of ``year`` and ``ngram``: the counts are then shuffled by these
    alone, and the rows of equal values lie in one partition.  Spark knows it, so that a later
    step that needs them together (``word_keys``) does not shuffle again.
    """
    spread = F.when(F.col(document).isNull(), F.xxhash64(text))
    located = texts.select(
        F.col(document).alias("document"), spread.alias("spread"), year.alias("year"), F.col(text).alias("text")
    )
    counts = F.sum("match_count").alias("match_count")
    if not together:
        return (
            _counts_by_document(located.repartition("document", "spread"))
            .groupBy("year", "ngram")
            .agg(counts, F.count("document").alias("volume_count"))
        )
    # Counts are added up by share of the documents before they move, as Spark would do for a
    # shuffle of its own: a frequent n-gram is a row per year and share, not per document.
    shares = _SHARES * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("document", "spread"), F.lit(shares)).alias("share")
    moved = (
        _counts_by_document(located.select("*", share).repartition("share"), "share")
        .groupBy("year", "ngram", "share")
        .agg(counts, F.count("document").alias("volume_count"))
        .repartition(*together)
    )
    keys = [key.alias(f"key{i}") for i, key in enumerate(together)]
    return (
        moved.groupBy("year", "ngram", *keys)
        .agg(counts, F.sum("volume_count").alias("volume_count"))
        .select("year", "ngram", "match_count", "volume_count")
    )


_SHARES = 8  # of the documents for each partition of a shuffle


def _counts_by_document(located: DataFrame, *keep: str) -> DataFrame:
    return (
        bigrams_of_text(located, "text", F.col("year"), "document", "spread", *keep)
        .groupBy("year", F.concat_ws(" ", "w1", "w2").alias("ngram"), "document", "spread", *keep)
        .agg(F.sum("match_count").alias("match_count"))
    )
