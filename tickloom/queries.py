"""The registered queries: each takes a session and a folder of tables and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.functions import signal_band, signal_or_fallback, strong_prediction
from tickloom.operators import dedup, ranking
from tickloom.operators.candle_states import candles_of
from tickloom.plans import audit, features, forest, layers, model, serving, sql
from tickloom.schemas import TABLES
from tickloom.session import fresh_path, stage
from tickloom.sources import feature_files, messages, payloads
from tickloom.sources.tables import Tables
from tickloom.sources.ticks import ticks_from_events
from tickloom.streaming.pipeline import LAYERS, LayeredPipeline
from tickloom.streaming.repeats import RepeatFilter
from tickloom.streaming.scoring import StreamScorer, append_latest

Query = Callable[[SparkSession, str], DataFrame]

CFG = TickConfig(window="1 hour")
ARRIVAL = ("ingestion_timestamp", "event_id")
# Fixed value: the symbol behind the one-symbol queries.
ONE_SYMBOL = "click"

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, with time columns as plain (zone-less) timestamps."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = build(spark, folder)
        times = {n: F.col(n).cast("timestamp_ntz") for n, kind in df.dtypes if kind == "timestamp"}
        return df.withColumns(times) if times else df

    QUERIES[build.__name__] = run
    return build


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return layers.bronze(ticks_from_events(spark, folder, CFG), CFG, ARRIVAL, stamp=False)


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return layers.silver(_bronze(spark, folder), CFG, ARRIVAL, stamp=False)


def _gold(spark: SparkSession, folder: str, cfg: TickConfig = CFG) -> DataFrame:
    return layers.gold(_silver(spark, folder), cfg, stamp=False)


def _stored_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Candles as a stored table, for queries that read them more than once."""
    return stage(_gold(spark, folder), "gold")


def _predictions(candles: DataFrame) -> DataFrame:
    """Rule-based predictions: a probability from the candle's counts, and a signal that is
    missing on some windows."""
    probability = (F.col("trade_count") * 37 + F.col("total_volume") * 11) % 101 / 100.0
    kind = F.col("total_volume") % 7
    stored = F.when(kind == 1, "WAIT").when(kind > 1, signal_band(probability))
    return candles.select(
        "symbol",
        "window_start",
        "window_end",
        probability.alias("probability"),
        stored.alias("signal"),
    )


# --- dedup -------------------------------------------------------------------------------------


@query
def bronze_dedup(spark, folder):
    return _bronze(spark, folder)


@query
def repeat_suppression(spark, folder):
    # compared with itself, so written once
    ticks = stage(ticks_from_events(spark, folder, CFG), "ticks")
    return dedup.without_repeats(ticks, ARRIVAL, CFG.tick_slice_seconds, CFG.max_slice_rows)


@query
def duplicate_audit(spark, folder):
    return dedup.duplicate_groups(ticks_from_events(spark, folder, CFG))


@query
def worst_duplicates(spark, folder):
    return dedup.worst_duplicates(ticks_from_events(spark, folder, CFG))


@query
def duplicate_summary(spark, folder):
    return dedup.duplicate_summary(ticks_from_events(spark, folder, CFG))


@query
def bronze_sample(spark, folder):
    return ranking.top(_bronze(spark, folder), 5, F.asc("symbol"), F.asc("timestamp"))


# --- layers ------------------------------------------------------------------------------------


@query
def silver_enrich(spark, folder):
    return _silver(spark, folder).withColumn("price_change_pct", F.round("price_change_pct", 10))


@query
def gold_candles_hour(spark, folder):
    return _gold(spark, folder)


@query
def gold_candles_10s(spark, folder):
    return _gold(spark, folder, replace(CFG, window="10 seconds"))


@query
def gold_candles_sliding(spark, folder):
    return _gold(spark, folder, replace(CFG, slide="30 minutes"))


@query
def candles_from_states(spark, folder):
    """Hours from stored parts of ten seconds; the ticks are read for the parts only."""
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"), window="10 seconds")
    tables = Tables(spark, cfg)
    tables.append("states", layers.gold_states(_silver(spark, folder), cfg))
    return candles_of(tables.read("states"), "1 hour")


@query
def sliding_candles_from_states(spark, folder):
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"), window="10 seconds")
    tables = Tables(spark, cfg)
    tables.append("states", layers.gold_states(_silver(spark, folder), cfg))
    return candles_of(tables.read("states"), "1 hour", "30 minutes")


@query
def layer_tables(spark, folder):
    """Batch run through the stored tables: bootstrap, append, read back by declared schema."""
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"))
    tables = Tables(spark, cfg)
    for name in ("bronze", "silver", "gold"):
        tables.bootstrap(name)
    ticks = ticks_from_events(spark, folder, cfg)
    tables.append("bronze", layers.bronze(ticks, cfg, ARRIVAL).drop("event_id"))
    tables.append("silver", layers.silver(tables.read("bronze"), cfg))
    tables.append("gold", layers.gold(tables.read("silver"), cfg))
    return tables.read("gold").drop("gold_computed_at")


@query
def silver_text_times(spark, folder):
    """Enrichment of ticks whose event time is text."""
    ticks = _bronze(spark, folder).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    return layers.enrich(ticks).withColumn("price_change_pct", F.round("price_change_pct", 10))


@query
def mixed_writes(spark, folder):
    """Candles of the earlier half of the time from a batch job, of the later half from the stream, in one
    table; and one more batch after the stream, of the candles in between."""
    cfg = _stream_config(spark)
    tables = Tables(spark, cfg)
    ticks = stage(ticks_from_events(spark, folder, cfg), "ticks")
    first, last = ticks.agg(F.min("timestamp"), F.max("timestamp")).first()
    third = (last - first) / 3
    one, two = (F.date_trunc("hour", F.lit(first + third * k)) for k in (1, 2))
    time = F.col("timestamp")

    def backfill(rows: DataFrame) -> None:
        silver = layers.silver(layers.bronze(rows, CFG, ARRIVAL, stamp=False), CFG, ARRIVAL)
        tables.append("gold", layers.gold(silver, CFG))

    backfill(ticks.where(time < one))
    later = stage(layers.bronze(ticks.where(time >= two), CFG, ARRIVAL, stamp=False), "later")
    _publish(spark, later, cfg)
    LayeredPipeline(spark, cfg).run_available()
    backfill(ticks.where((time >= one) & (time < two)))
    return tables.read("gold").drop("gold_computed_at")


@query
def sql_over_views(spark, folder):
    """A statement over the views of stored tables."""
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"))
    tables = Tables(spark, cfg)
    tables.append("gold", layers.gold(_silver(spark, folder), cfg))
    views = tables.create_views()
    try:
        text = "SELECT symbol, count(*) AS windows, max(max_price) AS high FROM gold WHERE trade_count >= :least GROUP BY symbol"
        return sql.run_sql(spark, text, args={"least": 2}).frame
    finally:
        for view in views:
            spark.catalog.dropTempView(view)


# --- serving -----------------------------------------------------------------------------------


@query
def symbol_stats(spark, folder):
    return serving.symbol_stats(_gold(spark, folder))


@query
def volatility_overview(spark, folder):
    return serving.volatility_overview(_gold(spark, folder))


@query
def default_playground(spark, folder):
    """What the SQL job shows without a statement."""
    return serving.volatility_overview(_gold(spark, folder)).withColumn("mean_price", F.round("mean_price", 6))


@query
def top_movers(spark, folder):
    return serving.top_movers(_gold(spark, folder))


@query
def volatile_windows(spark, folder):
    return serving.volatile_windows(_gold(spark, folder))


@query
def latest_n_windows(spark, folder):
    return serving.latest_windows(_gold(spark, folder), 100)


@query
def latest_windows_of_symbol(spark, folder):
    return serving.latest_windows_of(_gold(spark, folder), ONE_SYMBOL, 100)


@query
def distinct_symbols(spark, folder):
    return serving.symbols(_gold(spark, folder))


@query
def session_range(spark, folder):
    return serving.session_range(_gold(spark, folder))


@query
def price_series(spark, folder):
    return serving.price_series(_stored_gold(spark, folder), CFG)


@query
def price_series_of_symbol(spark, folder):
    return serving.price_series_of(_stored_gold(spark, folder), ONE_SYMBOL, CFG)


@query
def trend_ma5(spark, folder):
    return serving.trend(_gold(spark, folder)).withColumn("mean_price", F.round("mean_price", 6))


@query
def trend_series(spark, folder):
    """The five-window mean at every candle."""
    return serving.trend_series(_stored_gold(spark, folder), 5, CFG).withColumn("mean_price", F.round("mean_price", 6))


@query
def latest_many_ticks(spark, folder):
    """More of the newest ticks of every symbol than a task should rank."""
    ticks = stage(_silver(spark, folder), "silver").drop("price_change_pct")
    return ranking.newest(ticks, 1500, "timestamp")


@query
def risk_flags(spark, folder):
    flags = serving.risk_flags(_gold(spark, folder))
    return flags.withColumn("window_spread", F.round("window_spread", 6))


@query
def signal_bands(spark, folder):
    """Band, fallback and strength of every window's rule-based prediction."""
    rows = _predictions(_gold(spark, folder))
    return rows.select(
        "symbol",
        "window_start",
        "probability",
        signal_band(F.col("probability")).alias("band"),
        signal_or_fallback(F.col("signal"), F.col("probability")).alias("shown"),
        strong_prediction(F.col("probability")).alias("strong"),
    )


@query
def latest_prediction(spark, folder):
    return serving.latest_prediction(_predictions(_gold(spark, folder)))


@query
def kpi_board(spark, folder):
    candles = _stored_gold(spark, folder)
    board = serving.kpi_board(candles, _predictions(candles))
    return board.withColumn("window_spread", F.round("window_spread", 6))


# --- features and model ------------------------------------------------------------------------


def _rounded_logs(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 10) for c in ("log_returns", "log_volume")})


@query
def feature_rows(spark, folder):
    return _rounded_logs(features.features(_stored_gold(spark, folder), CFG))


@query
def label_rows(spark, folder):
    return _rounded_logs(features.labelled(_stored_gold(spark, folder), CFG))


@query
def time_split(spark, folder):
    return features.time_split(_stored_gold(spark, folder), CFG).select(
        "symbol", "window_start", "label", "rank", "split"
    )


@query
def split_counts(spark, folder):
    return features.split_counts(features.time_split(_stored_gold(spark, folder), CFG))


@query
def latest_per_symbol(spark, folder):
    rows = features.features(_stored_gold(spark, folder), CFG)
    return _rounded_logs(ranking.newest_with_ties(rows))


@query
def latest_per_symbol_join(spark, folder):
    rows = stage(features.features(_stored_gold(spark, folder), CFG), "features")
    return _rounded_logs(ranking.newest_by_join(rows))


@query
def feature_file_scan(spark, folder):
    path = fresh_path(spark, "feature-files")
    rows = features.labelled(_stored_gold(spark, folder), CFG)
    feature_files.write_feature_files(rows, path, ["avg_price", "volatility"])
    return feature_files.read_feature_files(spark, path).select(
        F.col("features")[0].alias("price_feature"),
        F.col("features")[1].alias("volatility_feature"),
        "target",
    )


@query
def rf_signals(spark, folder):
    """Signals of the newest feature rows against the forest scored as a table of nodes: whether the probability is that
    of the joins, and whether the signal is the band of it."""
    path = fresh_path(spark, "model")
    candles = _stored_gold(spark, folder)
    fitted, _ = model.train_and_evaluate(candles, CFG, path)
    latest = stage(model.latest_features(candles, CFG), "latest")
    scored = model.score(fitted, latest, CFG)
    joined = forest.probabilities(latest, forest.nodes(spark, path), forest.depth(fitted))
    both = scored.join(joined.withColumnRenamed("probability", "by_joins"), ["symbol", "window_start"], "left")
    return both.select(
        "symbol",
        "window_start",
        "window_end",
        (F.abs(F.col("probability") - F.col("by_joins")) < 1e-9).alias("is_probability"),
        (F.col("signal") == signal_band(F.col("by_joins"))).alias("signal_is_band"),
    )


@query
def rf_by_joins(spark, folder):
    """Every row of the test part, scored by ``spark.ml`` and by joins with the nodes."""
    path = fresh_path(spark, "model")
    candles = _stored_gold(spark, folder)
    fitted, _ = model.train_and_evaluate(candles, CFG, path)
    rows = stage(features.time_split(candles, CFG).where("split = 'test'"), "test-rows")
    scored = model.score(fitted, rows, CFG)
    joined = forest.probabilities(rows, forest.nodes(spark, path), forest.depth(fitted))
    both = scored.join(joined.withColumnRenamed("probability", "by_joins"), ["symbol", "window_start"], "left")
    agrees = F.abs(F.col("probability") - F.col("by_joins")) < 1e-9
    return both.select("symbol", "window_start", agrees.alias("agrees"))


@query
def rf_accuracy(spark, folder):
    """Row counts of the report, and whether the stored nodes, scored by joins, give its accuracy."""
    path = fresh_path(spark, "model")
    candles = _stored_gold(spark, folder)
    _, report = model.train_and_evaluate(candles, CFG, path)
    split = stage(features.time_split(candles, CFG).where("split = 'test'"), "test-rows")
    joined = forest.probabilities(split, forest.nodes(spark, path), forest.depth(model.load_model(path)))
    stored = split.join(joined, ["symbol", "window_start"], "left").select("label", "prediction")
    recomputed = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return stored.agg(
        F.lit(report.train_rows).cast("bigint").alias("train_rows"),
        F.count("*").alias("test_rows"),
        (F.abs(recomputed - F.lit(report.accuracy)) < 1e-12).alias("accuracy_is_reported"),
    )


@query
def stream_scoring(spark, folder):
    """Predictions stored by a stream over the candles and by a single run after it: one for the newest
    feature row of every symbol."""
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"), num_trees=5)
    tables = Tables(spark, cfg)
    tables.append("gold", layers.gold(_silver(spark, folder), CFG))
    fitted, _ = model.train_and_evaluate(tables.read("gold"), cfg)
    StreamScorer(tables, fitted, "forest").start(available_now=True).awaitTermination()
    append_latest(tables, fitted, "forest")
    return tables.read("predictions").select("symbol", "window_start", "window_end")


# --- messages and payloads ---------------------------------------------------------------------


@query
def json_roundtrip(spark, folder):
    sent = messages.as_messages(
        ticks_from_events(spark, folder, CFG), broker_time="ingestion_timestamp"
    )
    binary = sent.withColumn("value", F.col("value").cast("binary"))
    return layers.usable_ticks(layers.decode(binary), CFG)


@query
def rejected_messages(spark, folder):
    """Messages of which some are damaged: the reject table with the reason."""
    sent = messages.as_messages(ticks_from_events(spark, folder, CFG), broker_time="ingestion_timestamp")
    body, number = F.col("value"), F.get_json_object("value", "$.event_id").cast("bigint")
    damaged = (
        F.when(number % 10 == 0, F.concat(F.lit("~"), number.cast("string")))
        .when(number % 10 == 1, F.concat(F.lit('{"timestamp":'), number.cast("string"), F.lit("}")))
        .when(number % 10 == 2, F.concat(F.lit('{"symbol":"s'), number.cast("string"), F.lit('"}')))
        .otherwise(body)
    )
    return layers.rejected_messages(layers.decode(sent.withColumn("value", damaged)))


@query
def payload_series(spark, folder):
    """Time-series payloads of two entries each; some without a series, some with a bad number."""
    ticks = ticks_from_events(spark, folder, CFG)

    def entry(price: str) -> Column:
        fields = {
            "1. open": F.col("open").cast("string"),
            "2. high": F.col("high").cast("string"),
            "3. low": F.col("low").cast("string"),
            "4. close": F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.col(price).cast("string")),
            "5. volume": F.col("volume").cast("string"),
        }
        return F.create_map(*(part for name, value in fields.items() for part in (F.lit(name), value)))

    def minute(offset: str) -> Column:
        return F.date_format(F.col("timestamp") - F.expr(offset), payloads.SERIES_TIME)

    series = F.create_map(
        minute("INTERVAL 0 MINUTES"), entry("price"), minute("INTERVAL 1 MINUTES"), entry("open")
    )
    body = F.to_json(F.create_map(F.lit("Time Series (1min)"), series))
    note = F.lit('{"Note": "limit reached"}')
    payload = F.when(F.col("event_id") % 11 == 0, note).otherwise(body)
    return payloads.ticks_from_series(ticks.select("symbol", payload.alias("payload")))


@query
def payload_quotes(spark, folder):
    """Quote payloads with absent, NULL and zero fields."""
    ticks = ticks_from_events(spark, folder, CFG)
    number = F.col("event_id")

    def piece(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value.cast("string"))

    null = F.lit("null")
    parts = [
        F.when(number % 5 == 1, piece("currency", null)).when(
            number % 5 > 1, piece("currency", F.lit('"EUR"'))
        ),
        F.when(number % 3 > 0, piece("exchange", F.lit('"XPAR"'))),
        piece("currentPrice", F.when(number % 7 == 0, null).otherwise(F.col("price").cast("string"))),
        F.when(number % 11 > 0, piece("open", F.col("open"))),
        piece("dayHigh", F.col("high")),
        piece("dayLow", F.col("low")),
        F.when(number % 2 == 0, piece("regularMarketVolume", F.col("volume"))),
        piece("volume", F.col("volume") + 1),
        piece("regularMarketTime", F.unix_seconds("timestamp")),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return payloads.ticks_from_quotes(ticks.select("symbol", body.alias("payload")))


# --- streams -----------------------------------------------------------------------------------


@query
def stream_gold(spark, folder):
    """Messages with exact redeliveries through the three streaming layers.

    A tick far in the future moves the watermark past every real window, so all of them close.
    """
    cfg = _stream_config(spark)
    ticks = stage(_bronze(spark, folder), "bronze")
    again = ticks.where(F.col("event_id") % 3 == 0)
    _publish(spark, ticks.unionByName(again), cfg)
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    return pipeline.tables.read("gold").drop("gold_computed_at")


def _stream_config(spark: SparkSession) -> TickConfig:
    return replace(
        CFG,
        base_path=fresh_path(spark, "lake"),
        source_format="parquet",
        source_options={"path": fresh_path(spark, "topic")},
    )


def _closing_tick(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit("sentinel").alias("symbol"),
        *(F.lit(1.0).alias(c) for c in ("price", "open", "high", "low")),
        F.lit(1).cast("bigint").alias("volume"),
        F.lit("2100-01-01").cast("timestamp").alias("timestamp"),
        F.lit("2100-01-01").cast("timestamp").alias("ingestion_timestamp"),
    )


def _publish(spark: SparkSession, ticks: DataFrame, cfg: TickConfig) -> None:
    """Send ticks, and one far in the future that closes all windows."""
    rows = ticks.drop("event_id").unionByName(_closing_tick(spark))
    sent = messages.as_messages(rows, broker_time="ingestion_timestamp")
    messages.publish(sent, cfg.source_format, cfg.source_options)


@query
def stream_crash(spark, folder):
    """The streaming layers after a crash in each: the last batch with rows was written, but its checkpoint not told. The
    batches are tried again and count once."""
    cfg = _stream_config(spark)
    ticks = stage(_bronze(spark, folder), "bronze")
    _publish(spark, ticks, cfg)
    LayeredPipeline(spark, cfg).run_available()
    for layer in LAYERS:
        _take_back(Tables(spark, cfg), layer)
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    return pipeline.tables.read("gold").drop("gold_computed_at")


def _take_back(tables: Tables, layer: str) -> None:
    """Remove from a checkpoint what is written after the first batch."""
    place = tables.cfg.checkpoint(layer)
    for kind, first in (("commits", 0), ("offsets", 1)):
        for name, _ in tables.files.folder(f"{place}/{kind}"):
            number = name.strip(".").removesuffix(".crc")
            if number.isdigit() and int(number) >= first:
                tables.files.delete(f"{place}/{kind}/{name}")


@query
def stream_backlog(spark, folder):
    """A backlog of many loads, worked off by the layers a few whole loads at a time."""
    cfg = replace(_stream_config(spark), max_loads_per_batch=3)
    tables = Tables(spark, cfg)
    ticks = stage(_bronze(spark, folder).drop("event_id"), "bronze")
    first, last = ticks.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (last - first) / 9
    for k in range(9):
        later = F.col("timestamp") >= F.lit(first + step * k)
        tables.append("bronze", ticks.where(later if k == 8 else later & (F.col("timestamp") < F.lit(first + step * (k + 1)))))
    tables.append("bronze", _closing_tick(spark))
    pipeline = LayeredPipeline(spark, cfg)
    for layer in ("silver", "gold"):
        pipeline.run_layer(layer, available_now=True).awaitTermination()
    return pipeline.tables.read("gold").drop("gold_computed_at")


@query
def stream_ordered(spark, folder):
    """Conflicting redeliveries in one batch of the stream: of each key the first to arrive, as in a batch."""
    cfg = replace(_stream_config(spark), ordered_arrivals=True)
    _publish(spark, ticks_from_events(spark, folder, cfg), cfg)
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_layer("bronze", available_now=True).awaitTermination()
    return pipeline.tables.read("bronze").where("symbol <> 'sentinel'").drop("bronze_inserted_at")


@query
def stream_balance(spark, folder):
    """What became of every message: the later half of the time comes first, so the earlier half is late."""
    cfg = replace(_stream_config(spark), ordered_arrivals=True)
    ticks = stage(ticks_from_events(spark, folder, cfg), "ticks")
    later = F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp")
    damaged = ticks.where(later & (F.col("event_id") % 10 == 0)).select(
        F.concat(F.lit("~"), F.col("event_id").cast("string")).alias("value"), F.col("ingestion_timestamp").alias("timestamp")
    )
    messages.publish(damaged, cfg.source_format, cfg.source_options)
    for part in (ticks.where(later), ticks.where(~later)):
        sent = messages.as_messages(part.drop("event_id"), broker_time="ingestion_timestamp")
        messages.publish(sent, cfg.source_format, cfg.source_options)
        LayeredPipeline(spark, cfg).run_available()
    _publish(spark, ticks.limit(0), cfg)
    LayeredPipeline(spark, cfg).run_available()
    return audit.balance(Tables(spark, cfg))


@query
def compacted_candles(spark, folder):
    """Candles of one week from a table of many loads, rewritten by day while it is read."""
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"))
    tables = Tables(spark, cfg)
    candles = stage(_gold(spark, folder).withColumn("gold_computed_at", F.current_timestamp()), "candles")
    for k in range(4):
        tables.append("gold", candles.where(F.pmod(F.hour("window_start"), F.lit(4)) == k))
    tables.compact("gold")
    tables.append("gold", candles.where(F.lit(False)))
    tables.vacuum("gold", keep_hours=0)
    week = (datetime(2024, 1, d, tzinfo=timezone.utc) for d in (8, 15))
    return Tables(spark, cfg).read("gold", *week).drop("gold_computed_at")


@query
def table_columns(spark, folder):
    """Names and types of the columns of a stored table, beside the number of rows that fill them."""
    cfg = replace(CFG, base_path=fresh_path(spark, "lake"))
    tables = Tables(spark, cfg)
    tables.append("gold", layers.gold(_silver(spark, folder), cfg))
    views = tables.create_views()
    try:
        described = stage(tables.describe("gold"), "described")
        counts = tables.read("gold").agg(*(F.count(c).alias(c) for c in TABLES["gold"].names))
        filled = counts.unpivot([], list(counts.columns), "col_name", "filled")
        return described.join(filled, "col_name")
    finally:
        for view in views:
            spark.catalog.dropTempView(view)


@query
def stream_repeats(spark, folder):
    """Repeat suppression over a stream of quotes, with the state table."""
    quotes = stage(ticks_from_events(spark, folder, CFG), "quotes")
    out, state, checkpoint = (fresh_path(spark, p) for p in ("kept", "state", "checkpoint"))
    source = spark.readStream.schema(quotes.schema).parquet(quotes.inputFiles()[0].rsplit("/", 1)[0])
    RepeatFilter(spark, out, state, list(ARRIVAL), CFG).start(
        source, checkpoint, available_now=True
    ).awaitTermination()
    return spark.read.schema(quotes.schema).parquet(out).drop("batch_id")
