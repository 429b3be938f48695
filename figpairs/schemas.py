"""StructTypes of the data model: catalogue, member, figure, article, pair."""

from pyspark.sql import types as T

S = T.StringType()

CATALOGUE_FIELDS = ["path", "title", "pmcid", "pmid", "code"]

CATALOGUE = T.StructType(
    [T.StructField("line_no", T.LongType())] + [T.StructField(f, S) for f in CATALOGUE_FIELDS]
)

MEMBER = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("name", S),
        T.StructField("isfile", T.BooleanType()),
        T.StructField("size", T.LongType()),
    ]
)

INLINE_REF = T.StructType([T.StructField(f, S) for f in ("text", "section", "reference_id")])

FIGURE = T.StructType(
    [
        T.StructField("fig_pos", T.IntegerType()),
        T.StructField("pmid", S),
        T.StructField("pmc", S),
        T.StructField("fig_id", S),
        T.StructField("fig_label", S),
        T.StructField("fig_caption", S),
        T.StructField("graphic_ref", S),
        T.StructField("fig_refs", T.ArrayType(INLINE_REF)),
    ]
)

ARTICLE_FIGURE = T.StructType(
    [T.StructField(f, S) for f in ("fig_caption", "fig_id", "fig_label", "graphic_ref", "pair_id")]
)

ARTICLE = T.StructType(
    [
        T.StructField("pmid", S),
        T.StructField("pmc", S),
        T.StructField("location", S),
        T.StructField("figures", T.ArrayType(ARTICLE_FIGURE)),
    ]
)

PAIR_FIELDS = ["image", "caption", "pmid", "pmcid", "pair_id"]
PAIR = T.StructType([T.StructField(f, S) for f in PAIR_FIELDS])

SHARD_STATUS = T.StructType(
    [
        T.StructField("shard_idx", T.IntegerType()),
        T.StructField("shard_path", S),
        T.StructField("ok", T.BooleanType()),
        T.StructField("msg", S),
    ]
)

# binaryFile source schema, needed for streaming reads.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", S),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
