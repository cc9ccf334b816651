"""Job parameters from lenient JSON (unquoted keys), as in a properties file.

Parameters are plain function arguments everywhere in the library; this reader
only turns the text form into a one-row DataFrame / dict. Parsing runs in
Spark (``from_json`` with ``allowUnquotedFieldNames``), not in a hand parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The parameter names the jobs read (the rest are declared but unused).
CONDITION_FIELDS = [
    "startDate",
    "endDate",
    "startAge",
    "endAge",
    "professionals",
    "city",
    "gender",
    "keywords",
    "categoryIds",
    "targetPageFlow",
]

CONDITION_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in CONDITION_FIELDS])


def join_continued_lines(text: str) -> str:
    """Properties-file value with ``\\`` line continuations joined."""
    out = []
    for line in text.splitlines():
        s = line.strip()
        out.append(s[:-1] if s.endswith("\\") else s)
    return " ".join(out)


def parse_conditions(texts: DataFrame, column: str = "value") -> DataFrame:
    """Parse a column of lenient-JSON parameter objects into typed string columns."""
    opts = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
    return texts.select(F.from_json(F.col(column), CONDITION_SCHEMA, opts).alias("p")).select("p.*")


def read_properties_value(spark: SparkSession, path: str, key: str = "condition.params.json") -> DataFrame:
    """Read ``key=value`` (with continuations) from a properties file, parsed with ``parse_conditions``."""
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    joined = join_continued_lines(text)
    value = joined.split(f"{key}=", 1)[1] if f"{key}=" in joined else joined
    return parse_conditions(spark.createDataFrame([(value,)], "value string"))
