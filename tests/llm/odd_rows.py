"""Rows with what an operator may not expect."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", IntegerType())])

#: Nulls in every column, empty and wordless texts, repeats, a tie of ids and one long text.
ODD = [(1, "one two three four five six seven", "en", "web", 33), (1, "one two three four five six seven", "en", "web", 33),
       (2, None, "en", "web", None), (3, "", None, None, 0), (4, " \t\n ", "de", "web", 4), (5, "é ß 字 𝄞 é", None, "x", 9),
       (None, "a row without an id", "fr", "y", 19), (6, "One  Two three FOUR five six seven", "en", "web", 34),
       (7, "word " * 60_000, "en", "long", 300_000), (8, "one two three", "en", "web", 13), (9, "12 34 -- !!", "en", "web", 11)]
