"""Fixed schemas of the tables the pipeline reads and writes."""

from pyspark.sql import types as T

TRAFFIC_SOURCE = T.StructType([
    T.StructField("Model", T.IntegerType()),
    T.StructField("StartTime", T.TimestampNTZType()),
    T.StructField("ID", T.IntegerType()),
    T.StructField("SearchEngineID", T.IntegerType()),
    T.StructField("AdvEngineID", T.IntegerType()),
    T.StructField("SocialSourceNetworkID", T.IntegerType()),
    T.StructField("ClickBannerID", T.LongType()),
    T.StructField("ClickTargetType", T.IntegerType()),
    T.StructField("RecommendationSystemID", T.IntegerType()),
    T.StructField("MessengerID", T.IntegerType()),
])

PURCHASE = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("Revenue", T.LongType()),      # millionths
])

GOAL = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("Price", T.LongType()),        # thousandths
])

# Raw visits: versioned and signed rows; the dotted column groups of the
# source system are normalised to arrays of structs.
RAW_VISITS = T.StructType([
    T.StructField("CounterID", T.LongType()),
    T.StructField("UserIDHash", T.LongType()),
    T.StructField("VisitID", T.LongType()),
    T.StructField("VisitVersion", T.LongType()),
    T.StructField("Sign", T.IntegerType()),
    T.StructField("StartDate", T.DateType()),
    T.StructField("UTCStartTime", T.TimestampNTZType()),
    T.StructField("Duration", T.LongType()),
    T.StructField("TrafficSource", T.ArrayType(TRAFFIC_SOURCE)),
    T.StructField("EPurchase", T.ArrayType(PURCHASE)),
    T.StructField("Goals", T.ArrayType(GOAL)),
])

# One live row per visit.
VISITS = T.StructType([
    T.StructField("CounterID", T.LongType()),
    T.StructField("UserID", T.LongType()),
    T.StructField("VisitID", T.LongType()),
    T.StructField("StartDate", T.DateType()),
    T.StructField("UTCStartTime", T.TimestampNTZType()),
    T.StructField("StartTime", T.TimestampNTZType()),
    T.StructField("Duration", T.LongType()),
    T.StructField("TraficSourceID", T.IntegerType()),
    T.StructField("SearchEngineID", T.IntegerType()),
    T.StructField("AdvEngineID", T.IntegerType()),
    T.StructField("SocialSourceNetworkID", T.IntegerType()),
    T.StructField("ClickBannerID", T.LongType()),
    T.StructField("ClickTargetType", T.IntegerType()),
    T.StructField("RecommendationSystemID", T.IntegerType()),
    T.StructField("MessengerID", T.IntegerType()),
    T.StructField("Conversions", T.LongType()),
    T.StructField("Revenue", T.DoubleType()),
])

SOURCE_NAMES = T.StructType([
    T.StructField("SourceCode", T.StringType()),
    T.StructField("SourceName", T.StringType()),
])
