"""Declared schemas of the bronze files (fixtures §1-§6)."""

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("appid", L), T.StructField("name", S), T.StructField("release_date", S),
    T.StructField("short_description", S), T.StructField("developers", T.ArrayType(S)),
    T.StructField("categories", T.ArrayType(S)), T.StructField("genre", T.ArrayType(S)),
    T.StructField("header_image", S), T.StructField("price", L), T.StructField("currency", S),
    T.StructField("windows", B), T.StructField("linux", B), T.StructField("mac", B),
    T.StructField("metacritic", L), T.StructField("recommendations", L),
])

# The metrics CSV as the warehouse reads it: numbers typed, hours as text.
METRICS_SCHEMA = T.StructType([
    T.StructField("steam_id", I), T.StructField("Month", S),
    T.StructField("AvgViewers", D), T.StructField("AvgViewersGain", D),
    T.StructField("AvgViewers%Gain", D), T.StructField("PeakViewers", D),
    T.StructField("AvgStreams", D), T.StructField("AvgStreamsGain", D),
    T.StructField("AvgStreamsùGain", D), T.StructField("PeakStreams", D),
    T.StructField("HoursWatched", S),
])

# The same file as the legacy load reads it: every cell as text.
METRICS_TEXT_SCHEMA = T.StructType([T.StructField(f.name, S) for f in METRICS_SCHEMA.fields])

PLAYERS_SCHEMA = T.StructType([
    T.StructField("Month", S), T.StructField("Peak", S), T.StructField("Gain", S),
    T.StructField("Percent_Gain", S),
])

PRICE_SCHEMA = T.StructType([
    T.StructField("DateTime", S), T.StructField("Final price", S), T.StructField("2-year low", S),
])

# Counts stay text until the load, which rejects a cell that is no number.
USERS_SCHEMA = T.StructType([
    T.StructField("DateTime", S), T.StructField("Users", S), T.StructField("Average Users", S),
    T.StructField("In-Game", S),
])

PAYLOAD_DATA = T.StructType([
    T.StructField("name", S), T.StructField("short_description", S),
    T.StructField("release_date", T.StructType([
        T.StructField("coming_soon", B), T.StructField("date", S)])),
    T.StructField("developers", T.ArrayType(S)),
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("id", L), T.StructField("description", S)]))),
    T.StructField("genres", T.ArrayType(T.StructType([
        T.StructField("id", S), T.StructField("description", S)]))),
    T.StructField("header_image", S),
    T.StructField("price_overview", T.StructType([
        T.StructField("initial", L), T.StructField("currency", S)])),
    T.StructField("platforms", T.StructType([
        T.StructField("windows", B), T.StructField("linux", B), T.StructField("mac", B)])),
    T.StructField("metacritic", T.StructType([T.StructField("score", L)])),
    T.StructField("recommendations", T.StructType([T.StructField("total", L)])),
])

PAYLOAD_SCHEMA = T.MapType(S, T.StructType([
    T.StructField("success", B), T.StructField("data", PAYLOAD_DATA)]))
