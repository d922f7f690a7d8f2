"""Small inputs that every operator must take."""

from pyspark.sql import types as T

# Besides id and text, columns with names that operators use themselves.
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("slot", "kept", "class_id", "length", "_clash")]
)
EXTRA = ("a", None, "b", "c", "d")
PROSE = " ".join(f"word{i} stands here" for i in range(40))
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))


def rows():
    texts = [None, "", " \t\n ", "one", "one two\nthree", PROSE, PROSE, PROSE + " end", LONG, "a b  c é漢字 😀"]
    out = [(i, x, None if i % 3 else "en", None if i % 4 == 1 else f"s{i % 3}", len(x or ""), *EXTRA) for i, x in enumerate(texts)]
    out.append(out[5])  # a repeated row
    out.append((None, "no id here", None, None, None, *EXTRA))
    out.append((None, None, None, None, None, *EXTRA))
    out.append((4, "another text under one id", "en", "s1", 25, *EXTRA))
    return out


def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
