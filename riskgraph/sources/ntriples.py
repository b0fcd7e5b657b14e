"""N-Triples as distributed text, and the triple table as partitioned Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.operators.triples import TRIPLE_COLUMNS, TRIPLE_SCHEMA

WRITERS, OPEN_FILES, ROW_GROUP = "spark.sql.maxConcurrentOutputFileWriters", 64, 8 << 20
BLANK = r'_:[^\s<>"]*[^\s<>".]'
SUBJECT_PREDICATE = rf"^\s*(<[^>]*>|{BLANK})\s*<([^>]*)>\s*"
LINE_END = r'\s*\.\s*(#[^"<>]*)?$'
OBJECT = rf'^(<[^>]*>|{BLANK}|"(?s:.*)"(\^\^<[^<>"]*>|@[A-Za-z0-9-]+)?)$'
DATATYPE = r'"\^\^<([^<>"]*)>$'
LANGUAGE_TAG = r'"(@[A-Za-z0-9-]+)$'
CODE_POINT = r"(?=\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})"
ESCAPES = (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _escape(text: Column) -> Column:
    """Backslash first, then the characters a literal line cannot hold."""
    for raw, escaped in (("\\", "\\\\"), *ESCAPES):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def _unescape(text: Column) -> Column:
    """Inverse of the above: the pieces between escaped backslashes are unescaped, then joined by one backslash."""
    def point(part: Column) -> Column:
        short = F.concat(F.decode(F.unhex(F.substring(part, 3, 4)), "UTF-16BE"), F.substring(part, 7, 1 << 30))
        long = F.concat(F.decode(F.unhex(F.substring(part, 3, 8)), "UTF-32"), F.substring(part, 11, 1 << 30))
        return F.when(part.rlike(r"^\\u[0-9A-Fa-f]{4}"), short).when(part.rlike(r"^\\U[0-9A-Fa-f]{8}"), long).otherwise(part)

    def piece(part: Column) -> Column:
        for raw, escaped in (*ESCAPES, ("'", "\\'"), ("\b", "\\b"), ("\f", "\\f")):
            part = F.replace(part, F.lit(escaped), F.lit(raw))
        return F.array_join(F.transform(F.split(part, CODE_POINT, -1), point), "")

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), piece), "\\")


def _node(name: Column) -> Column:
    return F.when(name.startswith("_:"), name).otherwise(F.concat(F.lit("<"), name, F.lit(">")))


def to_lines(triples: DataFrame) -> DataFrame:
    """One line per triple. Blank nodes keep their ``_:`` name; an ``o_type`` that starts with @ is a language tag."""
    kind = F.col("o_type")
    typed = F.when(kind.startswith("@"), kind).when(kind.isNotNull(), F.concat(F.lit("^^<"), kind, F.lit(">"))).otherwise("")
    literal = F.concat(F.lit('"'), _escape(F.col("o")), F.lit('"'), typed)
    value = F.when(F.col("o_kind") == "iri", _node(F.col("o"))).otherwise(literal)
    return triples.select(F.concat(_node(F.col("s")), F.lit(" <"), F.col("p"), F.lit("> "), value, F.lit(" .")).alias("value"))


def _cells(lines: DataFrame) -> DataFrame:
    """Lines with subject, predicate and object text; those three are NULL where the line is no triple.

    Subject and predicate come from the head of the line and the datatype from its end, so that the length of a
    literal never becomes the depth of a regular expression.
    """
    head, end = F.regexp_extract("value", SUBJECT_PREDICATE, 0), F.regexp_extract("value", LINE_END, 0)
    cut_ = lines.withColumns({"_head": head, "_end": end})
    rest = F.expr("substring(value, length(_head) + 1, length(value) - length(_head) - length(_end))")
    fits = (F.col("_head") != "") & (F.col("_end") != "") & rest.rlike(OBJECT)
    subject = F.regexp_extract("value", SUBJECT_PREDICATE, 1)
    bare = F.when(subject.startswith("_:"), subject).otherwise(F.regexp_replace(subject, "^<|>$", ""))
    return cut_.select("value", F.when(fits, bare).alias("s"), F.when(fits, F.regexp_extract("value", SUBJECT_PREDICATE, 2)).alias("p"),
                       F.when(fits, rest).alias("rest"))


def from_lines(lines: DataFrame) -> DataFrame:
    """The triples of the lines. Comments and blank lines hold none; ``malformed`` has the lines that fail."""
    cells = _cells(lines).where(F.col("s").isNotNull())
    is_iri, is_blank = F.col("rest").startswith("<"), F.col("rest").startswith("_:")
    tag = F.concat(F.regexp_extract("rest", DATATYPE, 1), F.regexp_extract("rest", LANGUAGE_TAG, 1))
    typed = cells.withColumn("o_type", F.when(~is_iri & ~is_blank, F.nullif(tag, F.lit(""))))
    quoted = F.regexp_replace(F.regexp_replace("rest", DATATYPE, '"'), LANGUAGE_TAG, '"')
    node, text = F.expr("substring(rest, 2, length(rest) - 2)"), F.expr("substring(_quoted, 2, length(_quoted) - 2)")
    return typed.withColumn("_quoted", quoted).select(
        "s", "p", F.when(is_iri, node).when(is_blank, F.col("rest")).otherwise(_unescape(text)).alias("o"),
        F.when(is_iri | is_blank, "iri").otherwise("literal").alias("o_kind"), "o_type",
    )


def malformed(lines: DataFrame) -> DataFrame:
    """Lines that are neither a triple, nor a comment, nor blank: (value)."""
    return _cells(lines).where(F.col("s").isNull() & ~F.col("value").rlike(r"^\s*(#.*)?$")).select("value")


def write_ntriples(triples: DataFrame, path: str, compression: str | None = None) -> None:
    writer = to_lines(triples).write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).text(path)


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    try:
        return from_lines(spark.read.text(path))
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no graph at {path}") from failure


def write_triple_table(triples: DataFrame, path: str) -> None:
    """Parquet partitioned by predicate: a pattern reads only the predicates it names.

    The rebalance hint lets adaptive execution size the files and split the hot predicates.
    """
    triples.hint("rebalance", "p").write.mode("overwrite").partitionBy("p").parquet(path)


def write_partitioned(triples: DataFrame, path: str, *by: str) -> None:
    """Parquet in folders by a few columns, each task's rows as they come.

    A task keeps a file open for each folder it meets, up to ``OPEN_FILES`` of small row groups, so its rows are not sorted
    (and spilled) by folder first. Subjects are hashes as text, which zstd packs to half.
    """
    spark = triples.sparkSession
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(OPEN_FILES))
    try:
        triples.write.option("parquet.block.size", ROW_GROUP).partitionBy(*by).parquet(path, compression="zstd")
    finally:
        spark.conf.set(WRITERS, before)


def read_triple_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIPLE_SCHEMA).parquet(path).select(*TRIPLE_COLUMNS)
