"""Row types shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

FILES = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("language", T.StringType()),
    T.StructField("text", T.StringType()),
])

CHUNKS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("start_line", T.IntegerType()),
    T.StructField("end_line", T.IntegerType()),
    T.StructField("start_column", T.IntegerType()),
    T.StructField("end_column", T.IntegerType()),
    T.StructField("language", T.StringType()),
    T.StructField("function_type", T.StringType()),
    T.StructField("arguments", T.ArrayType(T.StringType())),
    T.StructField("return_type", T.StringType()),
    T.StructField("docstring", T.StringType()),
    T.StructField("comments", T.ArrayType(T.StringType())),
    T.StructField("modifiers", T.ArrayType(T.StringType())),
    T.StructField("scope", T.StringType()),
    T.StructField("imports", T.ArrayType(T.StringType())),
    T.StructField("calls", T.ArrayType(T.StringType())),
    T.StructField("complexity", T.IntegerType()),
    T.StructField("loc", T.IntegerType()),
    T.StructField("comment_lines", T.IntegerType()),
])
