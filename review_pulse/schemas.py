"""Table schemas shared by writers and readers."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
MISSING = "_no_payload"

REVIEW = T.StructType([
    T.StructField("reviewText", T.StringType()),
    T.StructField("overall", T.StringType()),
    T.StructField("reviewTime", T.StringType()),
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField(CORRUPT, T.StringType()),
])

MESSAGE = T.StructType([
    T.StructField("reviewText", T.StringType()),
    T.StructField("overall", T.FloatType()),
    T.StructField("reviewTime", T.StringType()),
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField(CORRUPT, T.StringType()),
])

CURATED = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("review_time", T.StringType()),
    T.StructField("overall", T.DoubleType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("lemmatized_text", T.StringType()),
    T.StructField("label", T.IntegerType()),
])

# Raw review text may hold line breaks, which would force multi-line (unsplittable) CSV reads;
# it travels in the Parquet and JSON-lines forms only.
CURATED_CSV = T.StructType([f for f in CURATED.fields if f.name != "review_text"])

PREDICTIONS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("lemmatized_text", T.StringType()),
    T.StructField("predicted_label", T.IntegerType()),
    T.StructField("asin", T.StringType()),
    T.StructField("review_time", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("ingestion_time", T.TimestampType()),
])


def _columns(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_TALLIES = {name: T.LongType() for name in ("negative", "neutral", "positive")}

# Partial results that a stored batch leaves for the dashboard.
MARTS = {
    "daily": _columns(day=T.DateType(), **_TALLIES, valid=T.LongType(), stored=T.LongType(), latest=T.TimestampType()),
    "reviewers": _columns(reviewer_id=T.StringType(), **_TALLIES, total=T.LongType()),
    "products": _columns(asin=T.StringType(), **_TALLIES, total=T.LongType()),
    "recent": _columns(review_id=T.StringType(), reviewer_id=T.StringType(), predicted_label=T.IntegerType(),
                       ingestion_time=T.TimestampType(), lemmatized_text=T.StringType()),
}
