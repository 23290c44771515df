"""What several operators of this folder need: key columns, ASCII case folding, stored tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.session import new_folder

# The white space of the text rules: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are. Pure ASCII text takes the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def document_key(id_column: Column, text: Column) -> Column:
    """16 bytes that tell documents apart by id and text; rows equal in both have one key.

    A null id and a null text have keys of their own.
    """
    name = F.coalesce(F.concat(F.lit("i"), id_column.cast("string")), F.lit("n"))
    body = F.coalesce(F.concat(F.lit("t"), text), F.lit("n"))
    return F.unhex(F.md5(F.concat(name, F.lit("\n"), body)))


def stored(df: DataFrame, label: str, *by: str) -> DataFrame:
    """The rows written to a new folder under the shared one and read again.

    Later jobs read files that every executor sees, so a lost executor costs its running tasks only.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
