"""Delimited text whose quoted fields may hold line breaks, read in parallel within each file.

Whether a line begins inside a quoted field depends on the quotes before it, but only on whether their number is odd.
So every block of a file counts its quotes, a prefix sum over the blocks tells each where it stands, and lines are put
together to records inside their block.  Only a record that crosses the end of a block moves.  Quotes inside quoted
fields are doubled; a field that does not begin with a quote has none.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattsift.operators.sample import BROADCAST_ROWS
from wattsift.session import materialise


def _small(facts: DataFrame) -> DataFrame:
    """Broadcast hint for facts of blocks, if they are few."""
    return F.broadcast(facts) if facts.count() <= BROADCAST_ROWS else facts


def _joined(items: Column) -> Column:
    """Texts of (place, text) structs in the order of their places, with the line breaks between them."""
    return F.array_join(F.transform(F.sort_array(items), lambda p: p["text"]), "\n")


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """(file, number, id, text): the records of all files.

    ``number`` counts from 0 within the file, whose record 0 is its header; ``id`` counts from 0 over all files in the
    order of their paths, headers left out (a header has none).  Blank lines outside quotes are no records.  A file whose
    last quoted field is not closed raises.  A task holds a block of a file and the record that begins in it.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("text"),
        (F.char_length("value") - F.char_length(F.replace("value", F.lit(quote), F.lit("")))).alias("quotes"),
    )
    lines = materialise(raw, "csv-lines")  # fixes the blocks and the order of lines
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.sum("quotes").over(Window.partitionBy("file")) % 2 == 1
    complaint = F.raise_error(F.concat(F.lit("a quoted field is not closed in "), "file"))
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    blocks = materialise(
        blocks.select("file", "block", F.when(open_end, complaint.cast("long")).otherwise(F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("start")),
        "csv-blocks",
    )

    in_block = Window.partitionBy("file", "block").orderBy("place")
    earlier = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = (F.col("start") + earlier) % 2 == 1
    marked = lines.join(_small(blocks), ["file", "block"]).withColumn("inside", inside)
    marked = marked.filter(F.col("inside") | F.col("text").rlike(r"\S"))
    begun = F.sum((~F.col("inside")).cast("long")).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    pieces = marked.withColumn("nth", begun).groupBy("file", "block", "nth").agg(_joined(F.collect_list(F.struct("place", "text"))).alias("text"))
    pieces = materialise(pieces, "csv-pieces")  # nth 0: the rest of a record of an earlier block

    facts = pieces.groupBy("file", "block").agg(F.max("nth").alias("n"), (F.min("nth") == 0).alias("headless"))
    over_all = Window.orderBy("file", "block")  # one row per block
    begins_file = (F.col("n") > 0) & (F.col("number") == 0)
    facts = facts.withColumns({
        "number": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "first": F.coalesce(F.sum("n").over(over_all.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "home": F.last(F.when(F.col("n") > 0, F.struct("block", "n")), True).over(before),
        "spills": F.coalesce(F.lead("headless").over(in_file), F.lit(False)),
    })
    headers = F.sum(begins_file.cast("long")).over(over_all.rowsBetween(Window.unboundedPreceding, 0))
    facts = materialise(facts.withColumn("headers", headers), "csv-facts")

    placed = pieces.join(_small(facts), ["file", "block"]).withColumns(
        {"number": F.col("number") + F.col("nth") - 1, "id": F.col("first") + F.col("nth") - 1 - F.col("headers")}
    )
    torn = (F.col("nth") == 0) | (F.col("spills") & (F.col("nth") == F.col("n")))
    whole = placed.filter(~torn).select("file", "number", "id", "text")
    own = F.struct("block", F.col("nth").alias("n"))
    opens = F.col("nth") > 0
    mended = (
        placed.filter(torn)
        .withColumn("home", F.when(opens, own).otherwise(F.col("home")))
        .groupBy("file", "home")
        .agg(
            F.max(F.when(opens, F.col("number"))).alias("number"),
            F.max(F.when(opens, F.col("id"))).alias("id"),
            _joined(F.collect_list(F.struct(F.col("block").alias("place"), "text"))).alias("text"),
        )
        .select("file", "number", "id", "text")
    )
    records = whole.unionByName(mended)
    return records.select("file", "number", F.when(F.col("number") > 0, F.col("id")).alias("id"), F.regexp_replace("text", r"\r\z", "").alias("text"))


def read_quoted_csv(spark: SparkSession, path: str, sep: str = ";", quote: str = '"') -> DataFrame:
    """Every column as text, and ``__id``: dense numbers from 0 in file order.

    All files have the same header, or it raises.  Records with fewer fields than it has nulls for the rest.
    """
    records = quoted_records(spark, path, quote)
    headers = [r["text"] for r in records.filter("number = 0").select("text").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError("the files have no header" if not headers else "the files have different headers")
    names = next(csv.reader(io.StringIO(headers[0]), delimiter=sep, quotechar=quote))
    if len(set(names)) < len(names):
        raise ValueError(f"a column name is repeated in the header: {names}")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true"}
    fields = F.from_csv("text", schema, options)
    rows = records.filter("number > 0").select("id", fields.alias("f"))
    return rows.select(*[F.col(f"f.c{i}").alias(n) for i, n in enumerate(names)], F.col("id").alias("__id"))
