"""Explicit schemas of the two raw event tables (no inference at read time)."""

from pyspark.sql import types as T

# Control events: one row per control run on a document. The two
# ``*_documentcontrols*`` / ``*_documentfaceids`` columns hold JSON arrays.
RAW_CONTROLLED = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("data_documentcontrolsdata_documentcontrols_anonymized", T.StringType(), True),
        T.StructField("data_documentcontrolsdata_documentfaceids", T.StringType(), True),
        T.StructField("data_documentcontrolsdata_status", T.StringType(), True),
        T.StructField("data_eventdate", T.TimestampNTZType(), False),
        T.StructField("data_score", T.StringType(), True),
        T.StructField("time", T.TimestampNTZType(), False),
    ]
)

# Creation events: one row per upload; a document may be uploaded many times.
RAW_CREATED = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("data_id_id", T.StringType(), False),
        T.StructField("data_acquisitionid_organizationid", T.StringType(), True),
        T.StructField("data_acquisitionid_type", T.StringType(), True),
        T.StructField("data_documentclass_documentsubtype", T.StringType(), True),
        T.StructField("data_documentclass_documenttype", T.StringType(), True),
        T.StructField("data_eventdate", T.TimestampNTZType(), False),
        T.StructField("time", T.TimestampNTZType(), False),
    ]
)
