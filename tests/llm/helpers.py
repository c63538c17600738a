"""Small inputs with every awkward case, and the columns that clash with internal names."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType()),
                   # names that the operators use inside
                   StructField("uid", IntegerType()), StructField("__uid", IntegerType()), StructField("fp", StringType()),
                   StructField("shard", IntegerType()), StructField("Salts", IntegerType())])


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        r = (*r, None, None)[:4]
        full.append((r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1]), 7, 7, "x", 7, 7))
    return spark.createDataFrame(full, DOCS)
